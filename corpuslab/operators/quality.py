"""Checks that return their violations.

Every check gives a table ``(check, key, detail)``; an empty one is a pass.
``limit`` keeps the first violations for a report, where one is asked for.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslab.functions.labels import Taxonomy, normalize_label, pair_error
from corpuslab.functions.text import strip
from corpuslab.functions.vectors import is_finite, norm
from corpuslab.operators.sets import frame_diff, partition_check, row_key, union_all

VIOLATION_SCHEMA = "check string, key string, detail string"


class QualityError(ValueError):
    """A check found violations."""


def assert_ok(violations: DataFrame, show: int = 10) -> None:
    """Raise when the table of violations is not empty."""
    found = violations.limit(show).collect()
    if found:
        lines = "; ".join(f"{r['check']} [{r['key']}] {r['detail']}" for r in found)
        raise QualityError(lines)


def run_checks(checks: Sequence[DataFrame]) -> DataFrame:
    """All violations of several checks as one job."""
    return union_all(checks)


def _found(df: DataFrame, check: str, key: Column, detail: Column, limit: int | None = None) -> DataFrame:
    out = df.select(
        F.lit(check).alias("check"), key.cast("string").alias("key"), detail.cast("string").alias("detail")
    )
    return out.orderBy("key", "detail").limit(limit) if limit is not None else out


def check_schema(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Required columns present and at least one row."""
    missing = [("missing column", c, f"column {c} is required") for c in required if c not in df.columns]
    columns = df.sparkSession.createDataFrame(missing, VIOLATION_SCHEMA)
    rows = df.select(F.lit(1)).limit(1).agg(F.count(F.lit(1)).alias("n")).filter("n = 0")
    return columns.unionByName(_found(rows, "empty table", F.lit(None), F.lit("no rows")))


def extra_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Columns beyond the required ones; they pass through."""
    return [c for c in df.columns if c not in set(required)]


def check_unique_id(df: DataFrame, id: str) -> DataFrame:
    """Null ids and ids on several rows, with the number of rows."""
    groups = df.groupBy(id).agg(F.count(F.lit(1)).alias("n"))
    null = F.col(id).isNull()
    detail = F.concat(F.col("n").cast("string"), F.lit(" rows"))
    bad = groups.filter(null | (F.col("n") > 1))
    check = F.when(null, "null id").otherwise("duplicate id")
    return bad.select(check.alias("check"), F.col(id).cast("string").alias("key"), detail.alias("detail"))


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of duplicated keys and of all rows that carry one.  Hashes travel, not the keys' texts."""
    groups = df.groupBy(row_key(df, keys).alias("_key")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return groups.agg(F.count(F.lit(1)).alias("n_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))


def check_labels_present(df: DataFrame, cols: Sequence[str], id: str) -> DataFrame:
    """Labels that are null or blank."""
    problems = F.array_compact(
        F.array(
            *[
                F.when(F.col(c).isNull(), F.concat(F.lit(c), F.lit(" is null"))).when(
                    strip(F.col(c).cast("string")) == "", F.concat(F.lit(c), F.lit(" is blank"))
                )
                for c in cols
            ]
        )
    )
    bad = df.select(F.col(id).alias("_id"), F.explode(problems).alias("_p"))
    return _found(bad, "missing label", F.col("_id"), F.col("_p"))


def check_label_domain(df: DataFrame, col: str, domain: DataFrame, limit: int | None = None) -> DataFrame:
    """Label values outside the domain (first column of ``domain``)."""
    values = df.groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    allowed = domain.select(F.col(domain.columns[0]).alias("_label"))
    bad = values.join(allowed, F.col(col) == F.col("_label"), "left_anti")
    detail = F.concat(F.col("_n").cast("string"), F.lit(" rows"))
    return _found(bad, f"{col} outside domain", F.col(col), detail, limit)


def check_hierarchy(
    df: DataFrame,
    category: str,
    section: str,
    taxonomy: Taxonomy,
    id: str,
    limit: int | None = 10,
) -> DataFrame:
    """Rows whose pair is no edge of the tree, with the reason.

    The tree is a literal map, so the check needs no join and no shuffle; the
    report keeps the first ``limit`` rows by id, ``None`` keeps all.
    """
    c, s = normalize_label(category), normalize_label(section)
    bad = df.select(F.col(id).alias("_id"), pair_error(c, s, taxonomy).alias("_e")).filter(
        F.col("_e").isNotNull()
    )
    if limit is not None:
        bad = bad.orderBy("_id").limit(limit)
    return _found(bad, "invalid pair", F.col("_id"), F.col("_e"))


def _diff_violations(diff: DataFrame, check: str, id: str) -> DataFrame:
    detail = F.concat(
        F.col("n_left").cast("string"), F.lit(" left, "), F.col("n_right").cast("string"), F.lit(" right")
    )
    return _found(diff, check, F.col(id), detail)


def _row_digest(df: DataFrame, id: str, cols: Sequence[str]) -> DataFrame:
    """Id and a digest of the other columns: whole texts stay out of the shuffle."""
    record = F.to_json(F.struct(*cols))
    return df.select(F.col(id).alias("id"), F.sha2(record, 256).alias("digest"))


def check_unlabelled(original: DataFrame, unlabelled: DataFrame, labels: Sequence[str], id: str) -> DataFrame:
    """The label-free copy equals the original without its labels."""
    return check_same_except(original, unlabelled, id, labels, "unlabelled copy differs")


def check_same_except(
    a: DataFrame, b: DataFrame, id: str, except_cols: Sequence[str], check: str = "tables differ"
) -> DataFrame:
    """Both tables hold the same rows, some columns aside; order is no rule."""
    left = [c for c in a.columns if c not in except_cols]
    right = [c for c in b.columns if c not in except_cols]
    if sorted(left) != sorted(right):
        odd = sorted(set(left) ^ set(right))
        rows = [("columns differ", c, "only in one table") for c in odd]
        return a.sparkSession.createDataFrame(rows, VIOLATION_SCHEMA)
    diff = frame_diff(_row_digest(a, id, left), _row_digest(b, id, left))
    return _diff_violations(diff, check, "id")


def check_partition(whole: DataFrame, parts: Sequence[DataFrame], id: str) -> DataFrame:
    """A split places every id exactly once, and row counts add up."""
    ids = _found(partition_check(whole, parts, id), "split", F.col("id"), F.col("problem"))
    count = lambda t: t.agg(F.count(F.lit(1))).scalar()
    total = reduce(lambda x, y: x + y, [count(p) for p in parts])
    sizes = whole.agg(F.count(F.lit(1)).alias("n")).withColumn("m", total).filter("n <> m")
    detail = F.concat(F.col("m").cast("string"), F.lit(" rows in parts, "), F.col("n").cast("string"), F.lit(" in all"))
    return ids.unionByName(_found(sizes, "split row count", F.lit(None), detail))


def check_split_rows(original: DataFrame, split: DataFrame, id: str) -> DataFrame:
    """Every row of a split equals its original row."""
    cols = [c for c in split.columns if c in original.columns]
    a, b = _row_digest(original, id, cols), _row_digest(split, id, cols)
    pairs = b.alias("s").join(a.alias("o"), "id", "left")
    bad = pairs.filter(~F.col("s.digest").eqNullSafe(F.col("o.digest")))
    detail = F.when(F.col("o.digest").isNull(), "not in the original").otherwise("values differ")
    return _found(bad, "split row", F.col("id"), detail)


def check_same_ids(a: DataFrame, b: DataFrame, id: str) -> DataFrame:
    """Both tables hold the same set of ids."""
    ids = a.select(F.col(id).alias("id"), F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        b.select(F.col(id).alias("id"), F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    seen = ids.groupBy("id").agg(F.max("l").alias("l"), F.max("r").alias("r")).filter("l <> r")
    detail = F.when(F.col("l") == 1, "only in the first table").otherwise("only in the second table")
    return _found(seen, "id sets differ", F.col("id"), detail)


def check_embedding_metadata(
    metadata: DataFrame, rows: DataFrame, id: str, row: str = "embedding_row", labels: Sequence[str] = ()
) -> DataFrame:
    """Metadata of embeddings: complete, one row per id, rows numbered 0 to n - 1, labelled, with the ids of ``rows``.

    A number is compared with the number of metadata rows; numbers that all lie
    in the range and never repeat fill it, so no sort is needed.  Where ``rows``
    has the number too, each id must have the same one in both.  Lacking columns
    are the only violations reported then.  Numbers may be text.
    """
    needed = [id, row, *labels]
    if set(needed) - set(metadata.columns):
        return check_schema(metadata, needed)
    number = F.col(row).cast("string").try_cast("double")
    placed = metadata.select(F.col(id).alias("id"), F.col(row).cast("string").alias("given"), number.alias("at"))
    n = metadata.agg(F.count(F.lit(1))).scalar()
    problem = F.when(F.col("at").isNull() | F.isnan("at") | (F.col("at") != F.floor("at")), "no row number").when(
        (F.col("at") < 0) | (F.col("at") >= n), F.concat(F.lit("row "), F.col("given"), F.lit(" is outside 0 to n - 1"))
    )
    numbers = _found(placed.filter(problem.isNotNull()), "embedding row", F.col("id"), problem)
    repeated = placed.filter("at IS NOT NULL").groupBy("at").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    repeats = _found(repeated, "repeated embedding row", F.col("at").cast("long"), F.concat(F.col("n").cast("string"), F.lit(" rows")))
    checks = [
        check_schema(metadata, needed), check_unique_id(metadata, id), numbers, repeats,
        check_labels_present(metadata, labels, id), check_same_ids(rows, metadata, id),
    ]
    if row in rows.columns:
        other = rows.select(F.col(id).alias("id"), F.col(row).cast("string").try_cast("double").alias("other"))
        moved = placed.join(other, "id").filter(~F.col("at").eqNullSafe(F.col("other")))
        checks.append(_found(moved, "moved embedding row", F.col("id"), F.lit("number differs from the table's")))
    return run_checks(checks)


# Audit of a labelling run ----------------------------------------------------

AUDIT_TEXT = ("llm_model", "prompt_version", "raw_category_response", "raw_section_response", "generated_at_utc")
AUDIT_ATTEMPTS = ("category_request_attempts", "section_request_attempts")
AUDIT_TIMES = (
    "category_processing_time_seconds",
    "section_processing_time_seconds",
    "total_processing_time_seconds",
)


def check_audit_metadata(audit: DataFrame, id: str = "id") -> DataFrame:
    """Text fields not blank, attempts at least 1, times at least 0."""
    has = set(audit.columns)
    rules: list[Column] = []
    for c in AUDIT_TEXT:
        if c in has:
            rules.append(F.when(strip(F.coalesce(F.col(c).cast("string"), F.lit(""))) == "", f"{c} is blank"))
    for names, least in ((AUDIT_ATTEMPTS, 1), (AUDIT_TIMES, 0)):
        for c in names:
            if c in has:
                number = F.col(c).cast("string").try_cast("double")
                rules.append(F.when(~F.coalesce(number >= least, F.lit(False)), f"{c} is below {least} or no number"))
    bad = audit.select(F.col(id).alias("_id"), F.explode(F.array_compact(F.array(*rules))).alias("_p"))
    return _found(bad, "audit metadata", F.col("_id"), F.col("_p"))


def check_audit_status(audit: DataFrame) -> DataFrame:
    """Rows that did not succeed, as counts per status."""
    counts = audit.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    bad = counts.filter(~F.col("status").eqNullSafe(F.lit("success")))
    return _found(bad, "audit status", F.col("status"), F.col("n"))


def check_audit_agrees(
    train: DataFrame,
    labelled: DataFrame,
    audit: DataFrame,
    id: str = "id",
    category: str = "category",
    section: str = "section",
) -> DataFrame:
    """The audit has the ids and, normalized, the labels of both train tables."""
    def side(t: DataFrame, tag: str, c: str, s: str) -> DataFrame:
        return t.select(
            F.col(id).alias("id"), F.lit(tag).alias("side"),
            normalize_label(c).alias("c"), normalize_label(s).alias("s"),
        )

    rows = union_all([
        side(train, "train", category, section),
        side(labelled, "labelled", category, section),
        side(audit, "audit_original", "original_category", "original_section"),
        side(audit, "audit_label", "llm_category", "llm_section"),
    ])
    # Ids are keys here, so a group has four rows; more is a violation itself.
    def pick(tag: str) -> list[Column]:
        here = F.col("side") == tag
        return [
            F.count_if(here).alias(f"n_{tag}"),
            F.max(F.when(here, F.col("c"))).alias(f"c_{tag}"),
            F.max(F.when(here, F.col("s"))).alias(f"s_{tag}"),
        ]

    tags = ("train", "labelled", "audit_original", "audit_label")
    wide = rows.groupBy("id").agg(*[x for tag in tags for x in pick(tag)])
    problems: list[Column] = [
        F.when(F.col(f"n_{tag}") != 1, F.concat(F.col(f"n_{tag}").cast("string"), F.lit(f" rows in {name}")))
        for tag, name in (("train", "train"), ("labelled", "labelled"), ("audit_label", "audit"))
    ]
    for mine, theirs, name in (("train", "audit_original", "original"), ("labelled", "audit_label", "label")):
        both = (F.col(f"n_{mine}") > 0) & (F.col(f"n_{theirs}") > 0)
        for c, part in (("c", "category"), ("s", "section")):
            same = F.col(f"{c}_{mine}").eqNullSafe(F.col(f"{c}_{theirs}"))
            problems.append(F.when(both & ~same, f"{name} {part} differs"))
    bad = wide.select("id", F.explode(F.array_compact(F.array(*problems))).alias("_p"))
    return _found(bad, "audit agreement", F.col("id"), F.col("_p"))


def check_labelled_set(
    train: DataFrame,
    labelled: DataFrame,
    audit: DataFrame,
    taxonomy: Taxonomy,
    id: str = "id",
    category: str = "category",
    section: str = "section",
) -> DataFrame:
    """The finished label set: complete, valid pairs, other data unchanged."""
    return run_checks([
        check_audit_status(audit),
        check_same_ids(train, labelled, id),
        check_hierarchy(labelled, category, section, taxonomy, id, limit=None),
        check_same_except(train, labelled, id, [category, section], "non-label data changed"),
    ])


# Vectors, features, predictions, metrics ----------------------------------------

def check_vectors(
    df: DataFrame, vec: str, id: str, dim: int | None = None, unit: bool = True, tol: float = 1e-4
) -> DataFrame:
    """Vectors finite, of one dimension, of the expected one, of unit length."""
    size = F.size(vec)
    first_dim = F.lit(dim) if dim is not None else df.agg(F.min(size)).scalar()
    finite = is_finite(vec)
    rules = [
        F.when(F.col(vec).isNull(), "null vector"),
        F.when(~finite, "value not finite"),
        F.when(size != first_dim, F.concat(F.lit("dimension "), size.cast("string"))),
    ]
    if unit:
        rules.append(F.when(finite & (F.abs(norm(vec) - 1) > tol), "length is not 1"))
    bad = df.select(F.col(id).alias("_id"), F.explode(F.array_compact(F.array(*rules))).alias("_p"))
    return _found(bad, "vector", F.col("_id"), F.col("_p"))


def check_features(features: DataFrame, ids: DataFrame, id: str = "id", weight: str = "weight") -> DataFrame:
    """Long feature rows: weights finite and not negative, every id has one."""
    w = F.col(weight)
    bad_weight = F.coalesce(F.isnan(w) | (w < 0) | (w == F.lit(float("inf"))), F.lit(True))
    values = _found(features.filter(bad_weight), "feature value", F.col(id), w)
    per_id = features.select(F.col(id).alias("id")).distinct()
    both = check_same_ids(ids.select(F.col(id).alias("id")), per_id, "id")
    return values.unionByName(both.withColumn("check", F.lit("feature ids")))


def check_min_classes(df: DataFrame, label: str, n: int = 2) -> DataFrame:
    """The target has at least ``n`` classes."""
    count = df.agg(F.count_distinct(label).alias("n")).filter(F.col("n") < n)
    return _found(count, "too few classes", F.lit(label), F.col("n"))


def check_predictions(
    pred: DataFrame, domain: DataFrame, ids: DataFrame, id: str, predicted: str
) -> DataFrame:
    """Predictions inside the label domain and exactly one per id."""
    outside = check_label_domain(pred, predicted, domain)
    counts = (
        ids.select(F.col(id).alias("id"), F.lit(0).alias("p"))
        .unionByName(pred.select(F.col(id).alias("id"), F.lit(1).alias("p")))
        .groupBy("id")
        .agg(F.sum("p").alias("n"))
        .filter("n <> 1")
    )
    return outside.unionByName(
        _found(counts, "predictions per id", F.col("id"), F.col("n"))
    )


def check_unique_keys(df: DataFrame, keys: Sequence[str], limit: int | None = 10) -> DataFrame:
    """Experiment keys that occur on several rows."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return _found(groups, "duplicate key", F.concat_ws(" | ", *keys), F.col("_n"), limit)


def check_metric_ranges(
    df: DataFrame, metrics: Sequence[str], allowed: dict[str, Sequence[str]] | None = None
) -> DataFrame:
    """Metrics are numbers in [0, 1]; named columns hold allowed values only."""
    rules = []
    for m in metrics:
        number = F.col(m).cast("string").try_cast("double")
        rules.append(F.when(~F.coalesce(number.between(0.0, 1.0), F.lit(False)), f"{m} is not in [0, 1]"))
    for c, values in (allowed or {}).items():
        rules.append(F.when(~F.coalesce(F.col(c).isin(list(values)), F.lit(False)), f"{c} is not allowed"))
    labels = [c for c in df.columns if c not in metrics]
    bad = df.select(
        F.concat_ws(" | ", *[F.col(c).cast("string") for c in labels]).alias("_k"),
        F.explode(F.array_compact(F.array(*rules))).alias("_p"),
    )
    return _found(bad, "metric", F.col("_k"), F.col("_p"))


def check_non_blank(df: DataFrame, col: str, id: str) -> DataFrame:
    """Texts without any content."""
    bad = df.filter(strip(F.coalesce(F.col(col).cast("string"), F.lit(""))) == "")
    return _found(bad, "blank text", F.col(id), F.lit(col))
