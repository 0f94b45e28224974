"""Label trees, label normalization and checks of labelling responses."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslab.functions.columns import literal_map, quoted
from corpuslab.functions.text import strip
from corpuslab.session import collect_bounded

# The news label tree.
NEWS_TREE: dict[str, tuple[str, ...]] = {
    "business": (
        "business", "business-food", "business-money", "cars", "economy", "energy",
        "homes", "investing", "media", "perspectives", "success", "tech",
    ),
    "entertainment": ("entertainment", "celebrities", "movies"),
    "health": ("health",),
    "news": (
        "africa", "americas", "asia", "australia", "china", "europe", "india",
        "intl_world", "living", "middleeast", "opinions", "uk", "us", "weather", "world",
    ),
    "politics": ("politics",),
    "sport": ("sport", "football", "golf", "motorsport", "tennis"),
}

# A tree is a driver-side object put into plans as a literal map, so its size
# is checked when it is built.
MAX_TREE_LABELS = 10_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


@dataclass(frozen=True)
class Taxonomy:
    """Two-level tree: every section has exactly one category."""

    tree: Mapping[str, Sequence[str]]
    parents: Mapping[str, str] = field(init=False)

    def __post_init__(self) -> None:
        parents: dict[str, str] = {}
        for category, sections in self.tree.items():
            for section in sections:
                if section in parents:
                    raise ValueError(f"section {section!r} has two categories")
                parents[section] = category
        if not parents or len(parents) + len(self.tree) > MAX_TREE_LABELS:
            raise ValueError(f"a tree needs 1 to {MAX_TREE_LABELS} labels")
        object.__setattr__(self, "parents", parents)

    @classmethod
    def news(cls) -> Taxonomy:
        return cls(NEWS_TREE)

    @classmethod
    def from_frame(cls, df: DataFrame, category: str, section: str) -> Taxonomy:
        """Tree from a table of edges, in label order."""
        edges = df.select(category, section).distinct().orderBy(category, section)
        tree: dict[str, list[str]] = {}
        for c, s in collect_bounded(edges, MAX_TREE_LABELS, "the label tree"):
            tree.setdefault(c, []).append(s)
        return cls({c: tuple(s) for c, s in tree.items()})

    @property
    def categories(self) -> list[str]:
        return list(self.tree)

    @property
    def sections(self) -> list[str]:
        return list(self.parents)

    def frame(self, spark: SparkSession) -> DataFrame:
        schema = T.StructType(
            [T.StructField("category", T.StringType()), T.StructField("section", T.StringType())]
        )
        return spark.createDataFrame([(c, s) for s, c in self.parents.items()], schema)

    def parent_of(self, section: Column | str) -> Column:
        """Category of a section; null when the section is unknown."""
        return F.element_at(literal_map(self.parents), _col(section))

    def sections_of(self, category: Column | str) -> Column:
        """Array of the sections of a category; null when it is unknown."""
        entries = [f"{quoted(c)}, array({', '.join(map(quoted, s))})" for c, s in self.tree.items()]
        return F.element_at(F.expr(f"map({', '.join(entries)})"), _col(category))

    def has_category(self, category: Column | str) -> Column:
        return _col(category).isin(self.categories)

    def has_section(self, section: Column | str) -> Column:
        return _col(section).isin(self.sections)


def parent_of(df: DataFrame, section: str, edges: DataFrame, into: str = "parent") -> DataFrame:
    """Attach the category of each section from a table of edges.

    A plain left join: Spark broadcasts the edges while they are below its
    size threshold and shuffles both sides beyond it.
    """
    lookup = edges.select(F.col("section").alias(section), F.col("category").alias(into))
    return df.join(lookup, section, "left")


def normalize_label(c: Column | str, mode: str = "hyphen") -> Column:
    """Canonical label.

    ``hyphen``: strip, lower case, blank to hyphen.  ``lower``: strip and lower
    case.  ``strip``: strip only.
    """
    value = strip(c)
    if mode == "strip":
        return value
    if mode == "lower":
        return F.lower(value)
    if mode == "hyphen":
        return F.replace(F.lower(value), F.lit(" "), F.lit("-"))
    raise ValueError(f"unknown mode: {mode}")


def label_key(c: Column | str) -> Column:
    """Missing label as ``""``, stripped, lower case."""
    return F.lower(strip(F.coalesce(_col(c), F.lit(""))))


def section_bullets(category: Column | str, taxonomy: Taxonomy) -> Column:
    """The valid sections of a category, one bullet per line."""
    return F.array_join(
        F.transform(taxonomy.sections_of(category), lambda s: F.concat(F.lit("- "), s)), "\n"
    )


# Responses ---------------------------------------------------------------
# A response must be a JSON object with exactly the expected fields, each a
# non-blank string from the tree.  The checks run in this order and the first
# that fails gives the reason.

def _structure_error(response: Column, parsed: Column, fields: Sequence[str]) -> Column:
    expected = F.array(*[F.lit(f) for f in fields])
    keys = F.json_object_keys(response)
    extra = F.array_sort(F.array_except(keys, expected))
    missing = F.array_sort(F.array_except(expected, keys))
    return (
        F.when(response.isNull() | (strip(response) == ""), "empty response")
        .when(parsed.isNull(), "invalid json")
        .when(~F.startswith(F.schema_of_variant(parsed), F.lit("OBJECT")), "not an object")
        .when(F.size(extra) > 0, F.concat(F.lit("unexpected fields: "), F.array_join(extra, ", ")))
        .when(F.size(missing) > 0, F.concat(F.lit("missing fields: "), F.array_join(missing, ", ")))
    )


def _field(parsed: Column, name: str) -> tuple[Column, Column]:
    """Normalized value of a field and the reason why it is no label."""
    raw = F.try_variant_get(parsed, f"$.{name}", "variant")
    value = normalize_label(F.try_variant_get(parsed, f"$.{name}", "string"))
    error = F.when(
        F.coalesce(F.schema_of_variant(raw), F.lit("VOID")) != "STRING",
        f"{name} is not a string",
    ).when(value == "", f"{name} is blank")
    return value, error


def _unknown(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"unknown {name}: "), value)


def _wrong_parent(category: Column, section: Column, taxonomy: Taxonomy) -> Column:
    return F.concat(
        section, F.lit(" belongs to "), taxonomy.parent_of(section), F.lit(", not "), category
    )


def pair_error(category: Column | str, section: Column | str, taxonomy: Taxonomy) -> Column:
    """Why a normalized pair is no edge of the tree; null for a valid pair."""
    category, section = _col(category), _col(section)
    c, s = F.coalesce(category, F.lit("")), F.coalesce(section, F.lit(""))
    return (
        F.when(~taxonomy.has_category(c), _unknown("category", c))
        .when(~taxonomy.has_section(s), _unknown("section", s))
        .when(taxonomy.parent_of(s) != c, _wrong_parent(c, s, taxonomy))
    )


def parse_category(response: Column | str, taxonomy: Taxonomy) -> Column:
    """Struct ``(label, error)`` from a response with one ``category`` field."""
    response = _col(response)
    parsed = F.try_parse_json(response)
    value, bad = _field(parsed, "category")
    error = F.coalesce(
        _structure_error(response, parsed, ["category"]),
        bad,
        F.when(~taxonomy.has_category(value), _unknown("category", value)),
    )
    return F.struct(F.when(error.isNull(), value).alias("label"), error.alias("error"))


def parse_section(response: Column | str, category: Column | str, taxonomy: Taxonomy) -> Column:
    """Struct ``(label, error)``; the section must belong to ``category``."""
    response = _col(response)
    parent = normalize_label(category)
    parsed = F.try_parse_json(response)
    value, bad = _field(parsed, "section")
    error = F.coalesce(
        F.when(~F.coalesce(taxonomy.has_category(parent), F.lit(False)),
               _unknown("category", F.coalesce(parent, F.lit("")))),
        _structure_error(response, parsed, ["section"]),
        bad,
        pair_error(parent, value, taxonomy),
    )
    return F.struct(F.when(error.isNull(), value).alias("label"), error.alias("error"))


def parse_pair(response: Column | str, taxonomy: Taxonomy) -> Column:
    """Struct ``(category, section, error)`` from a response with both fields."""
    response = _col(response)
    parsed = F.try_parse_json(response)
    category, bad_category = _field(parsed, "category")
    section, bad_section = _field(parsed, "section")
    error = F.coalesce(
        _structure_error(response, parsed, ["category", "section"]),
        bad_category,
        bad_section,
        pair_error(category, section, taxonomy),
    )
    good = error.isNull()
    return F.struct(
        F.when(good, category).alias("category"),
        F.when(good, section).alias("section"),
        error.alias("error"),
    )


def is_valid(result: Column | str) -> Column:
    """Whether a parse result carries no error."""
    return _col(result)["error"].isNull()


# Label indices -------------------------------------------------------------

def label_domain(df: DataFrame, label: str, limit: int = MAX_TREE_LABELS) -> list[str]:
    """Sorted distinct labels, on the driver; more than ``limit`` is an error."""
    rows = collect_bounded(
        df.select(label).filter(F.col(label).isNotNull()).distinct(), limit, f"domain of {label}"
    )
    return sorted(r[0] for r in rows)


def encode(label: Column | str, domain: Sequence[str]) -> Column:
    """Index of a label in the sorted domain; an unknown label is an error."""
    c = _col(label)
    pairs = [x for i, v in enumerate(sorted(domain)) for x in (F.lit(v), F.lit(i))]
    index = F.element_at(F.create_map(*pairs), c)
    problem = F.concat(F.lit("label outside the domain: "), c.cast("string"))
    return F.when(c.isNull() | index.isNotNull(), index).otherwise(
        F.raise_error(problem).cast("int")
    )


def decode(index: Column | str, domain: Sequence[str]) -> Column:
    """Label of an index; an index outside the domain is an error."""
    values = F.array(*[F.lit(v) for v in sorted(domain)])
    return F.element_at(values, _col(index).cast("int") + 1)
