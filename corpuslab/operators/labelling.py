"""Two-step labelling of pending documents through a caller's labeler."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslab.functions.columns import first_known
from corpuslab.functions.labels import Taxonomy, pair_error, parse_category, parse_section, section_bullets
from corpuslab.functions.text import clean_text, fill_template, truncate_text


@dataclass
class Response:
    """What a labeler says about one prompt."""

    content: str
    model: str | None = None
    prompt_tokens: int | None = None
    response_tokens: int | None = None


class Labeler(Protocol):
    """A batch of prompts in, one JSON text (or :class:`Response`) per prompt out."""

    def __call__(self, texts: list[str]) -> Sequence[str | Response]: ...


AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("original_category", T.StringType()),
        T.StructField("original_section", T.StringType()),
        T.StructField("llm_category", T.StringType()),
        T.StructField("llm_section", T.StringType()),
        T.StructField("llm_model", T.StringType()),
        T.StructField("prompt_version", T.StringType()),
        T.StructField("raw_category_response", T.StringType()),
        T.StructField("raw_section_response", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("category_validation_error", T.StringType()),
        T.StructField("section_validation_error", T.StringType()),
        T.StructField("category_request_attempts", T.IntegerType()),
        T.StructField("section_request_attempts", T.IntegerType()),
        T.StructField("category_processing_time_seconds", T.DoubleType()),
        T.StructField("section_processing_time_seconds", T.DoubleType()),
        T.StructField("total_processing_time_seconds", T.DoubleType()),
        T.StructField("category_prompt_token_count", T.IntegerType()),
        T.StructField("category_response_token_count", T.IntegerType()),
        T.StructField("section_prompt_token_count", T.IntegerType()),
        T.StructField("section_response_token_count", T.IntegerType()),
        T.StructField("generated_at_utc", T.TimestampType()),
    ]
)

_ANSWER = "content string, model string, prompt_tokens int, response_tokens int, seconds double, failure string"
_ANSWER_TYPE = pa.struct([
    ("content", pa.string()), ("model", pa.string()), ("prompt_tokens", pa.int32()), ("response_tokens", pa.int32()),
    ("seconds", pa.float64()), ("failure", pa.string()),
])
ASKED_BYTES = 1 << 20  # bytes of prompts that a labeler is asked at once, one prompt at least


def _answers(labeler: Labeler, prompts: list[str]) -> list[tuple]:
    """Ask for a batch; when the call fails, ask prompt by prompt."""
    start = time.perf_counter()
    try:
        replies = list(labeler(prompts))
        if len(replies) != len(prompts):
            raise RuntimeError(f"{len(replies)} replies to {len(prompts)} prompts")
    except Exception as error:  # the caller's code may raise anything
        if len(prompts) > 1:
            return [_answers(labeler, [p])[0] for p in prompts]
        return [(None, None, None, None, time.perf_counter() - start, str(error) or type(error).__name__)]
    seconds = (time.perf_counter() - start) / len(prompts)
    rows = []
    for reply in replies:
        r = reply if isinstance(reply, Response) else Response(reply)
        rows.append((r.content, r.model, r.prompt_tokens, r.response_tokens, seconds, None))
    return rows


def _parts(prompts: pa.Array) -> Iterator[pa.Array]:
    """Slices of about ``ASKED_BYTES``, so that a batch of long texts is never held as Python texts at once."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(prompts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts = [0, *(np.flatnonzero(np.diff(ends // ASKED_BYTES)) + 1).tolist(), len(prompts)]
    return (prompts.slice(a, b - a) for a, b in zip(cuts, cuts[1:]) if b > a)


def _ask(make_labeler: Callable[[], Labeler]):
    """Arrow function from prompt to answer; null prompts are not sent.

    Only the prompt column leaves the JVM.  A task holds its Arrow batch and the
    texts of one slice of it.  Declared nondeterministic so that
    the optimizer never evaluates a request twice.
    """

    @F.arrow_udf(_ANSWER)
    def ask(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        labeler = None
        for prompts in batches:
            parts = []
            for some in _parts(prompts):
                wanted = [p for p in some.to_pylist() if p is not None]
                if wanted and labeler is None:
                    labeler = make_labeler()  # once per worker task
                found = iter(_answers(labeler, wanted)) if wanted else iter(())
                known = some.is_valid().to_pylist()
                rows = [dict(zip(_ANSWER_TYPE.names, next(found) if k else (None,) * 6)) for k in known]
                parts.append(pa.array(rows, _ANSWER_TYPE))
            yield pa.concat_arrays(parts) if parts else pa.array([], _ANSWER_TYPE)

    return ask.asNondeterministic()


def _request(
    df: DataFrame, tag: str, prompt: str, wanted: Column, ask, parse: Callable[[Column], Column], attempts: int
) -> DataFrame:
    """Ask up to ``attempts`` times until the answer validates.

    Adds ``<tag>_answer``, ``<tag>_result``, ``<tag>_attempts`` and
    ``<tag>_seconds``.  A failed request is not repeated within a run.
    """
    if attempts < 1:
        raise ValueError("attempts must be at least 1")
    answer, result, tries, seconds = (f"{tag}_{x}" for x in ("answer", "result", "attempts", "seconds"))
    df = df.withColumn("_need", F.coalesce(wanted, F.lit(False)))
    for turn in range(attempts):
        df = df.withColumn("_new", ask(F.when(F.col("_need"), F.col(prompt))))
        parsed = parse(F.col("_new.content"))
        took = F.coalesce(F.col("_new.seconds"), F.lit(0.0))
        need = F.col("_need")
        if turn == 0:
            df = df.withColumns({
                answer: F.when(need, F.col("_new")),
                result: F.when(need & F.col("_new.failure").isNull(), parsed),
                tries: need.cast("int"),
                seconds: took,
            })
        else:
            df = df.withColumns({
                answer: F.when(need, F.col("_new")).otherwise(F.col(answer)),
                result: F.when(need & F.col("_new.failure").isNull(), parsed).when(~need, F.col(result)),
                tries: F.col(tries) + need.cast("int"),
                seconds: F.col(seconds) + took,
            })
        again = need & F.col(f"{answer}.failure").isNull() & F.col(f"{result}.error").isNotNull()
        df = df.withColumn("_need", again)
    return df.drop("_need", "_new")


def label_hierarchical(
    df: DataFrame,
    make_labeler: Callable[[], Labeler],
    taxonomy: Taxonomy,
    category_template: str,
    section_template: str,
    *,
    id: str = "id",
    title: str = "headline",
    description: str = "description",
    article: str = "body",
    category: str = "category",
    section: str = "section",
    max_article_chars: int | None = None,
    attempts: int = 3,
    model: str = "unknown",
    prompt_version: str = "1",
    examples: Mapping[str, str] | None = None,
) -> DataFrame:
    """Ask for a category, then for a section of that category.

    Templates use ``{TITLE}``, ``{DESCRIPTION}``, ``{ARTICLE}``, and for the
    section also ``{CATEGORY}``, ``{VALID_SECTIONS}`` and, if given examples,
    ``{EXAMPLES}``.  Returns one audit record per row; write it before use, a
    plan read twice asks twice.
    """
    ask = _ask(make_labeler)
    values = {
        "TITLE": clean_text(title),
        "DESCRIPTION": clean_text(description),
        "ARTICLE": truncate_text(clean_text(article), max_article_chars),
    }
    rows = df.withColumn("_cp", fill_template(category_template, **values))
    rows = _request(rows, "_c", "_cp", F.lit(True), ask, lambda r: parse_category(r, taxonomy), attempts)
    rows = rows.drop("_cp").withColumn("_label", F.col("_c_result.label"))
    found = F.col("_label")
    extra = {"CATEGORY": found, "VALID_SECTIONS": section_bullets(found, taxonomy)}
    if examples is not None:
        pairs = [F.lit(x) for kv in examples.items() for x in kv]
        default = F.lit("Choose the most fitting section of the category.")
        known = F.element_at(F.create_map(*pairs), found) if pairs else F.lit(None)
        extra["EXAMPLES"] = F.coalesce(known, default)
    rows = rows.withColumn("_sp", fill_template(section_template, **extra, **values))
    rows = _request(
        rows, "_s", "_sp", found.isNotNull(), ask, lambda r: parse_section(r, F.col("_label"), taxonomy), attempts
    )
    return audit_records(rows.drop("_sp"), taxonomy, id, category, section, model, prompt_version)


def audit_records(
    rows: DataFrame, taxonomy: Taxonomy, id: str, category: str, section: str, model: str, prompt_version: str
) -> DataFrame:
    """The audit record of every labelled row."""
    c_fail, s_fail = F.col("_c_answer.failure"), F.col("_s_answer.failure")
    c_error, s_error = F.col("_c_result.error"), F.col("_s_result.error")
    c_label, s_label = F.col("_c_result.label"), F.col("_s_result.label")
    pair = F.when(c_label.isNotNull() & s_label.isNotNull(), pair_error(c_label, s_label, taxonomy))
    status = (
        F.when(c_fail.isNotNull() | s_fail.isNotNull(), "request_failed")
        .when(c_error.isNotNull(), "category_validation_failed")
        .when(s_error.isNotNull(), "section_validation_failed")
        .when(pair.isNotNull(), "pair_validation_failed")
        .otherwise("success")
    )
    text = lambda c: F.coalesce(c, F.lit(""))
    good = status == "success"
    seconds = F.col("_c_seconds") + F.col("_s_seconds")
    columns = {
        "id": F.col(id),
        "original_category": F.col(category),
        "original_section": F.col(section),
        "llm_category": F.when(good, c_label).otherwise(""),
        "llm_section": F.when(good, s_label).otherwise(""),
        "llm_model": first_known(F.col("_s_answer.model"), F.col("_c_answer.model"), F.lit(model)),
        "prompt_version": F.lit(prompt_version),
        "raw_category_response": text(F.col("_c_answer.content")),
        "raw_section_response": text(F.col("_s_answer.content")),
        "status": status,
        "category_validation_error": text(F.coalesce(c_fail, c_error)),
        "section_validation_error": text(F.coalesce(s_fail, s_error, pair)),
        "category_request_attempts": F.col("_c_attempts"),
        "section_request_attempts": F.col("_s_attempts"),
        "category_processing_time_seconds": F.round("_c_seconds", 4),
        "section_processing_time_seconds": F.round("_s_seconds", 4),
        "total_processing_time_seconds": F.round(seconds, 4),
        "category_prompt_token_count": F.col("_c_answer.prompt_tokens"),
        "category_response_token_count": F.col("_c_answer.response_tokens"),
        "section_prompt_token_count": F.col("_s_answer.prompt_tokens"),
        "section_response_token_count": F.col("_s_answer.response_tokens"),
        "generated_at_utc": F.current_timestamp(),
    }
    types = {f.name: f.dataType for f in AUDIT_SCHEMA.fields if f.name != "id"}
    return rows.select(
        *[(c.cast(types[name]) if name in types else c).alias(name) for name, c in columns.items()]
    )


# Around the labelling step ---------------------------------------------------------

def successful(audit: DataFrame) -> DataFrame:
    return audit.filter(F.col("status") == "success")


def pending(df: DataFrame, audit: DataFrame, id: str, audit_id: str = "id") -> DataFrame:
    """Rows without a successful audit record."""
    done = successful(audit).select(F.col(audit_id).alias(id))
    return df.join(done, id, "left_anti")


def apply_labels(
    df: DataFrame, audit: DataFrame, id: str, category: str = "category", section: str = "section",
    audit_id: str = "id",
) -> DataFrame:
    """Rows with both labels replaced by those of the audit; others are left out."""
    labels = successful(audit).select(
        F.col(audit_id).alias(id), F.col("llm_category").alias("_c"), F.col("llm_section").alias("_s")
    ).filter(F.col("_c").isNotNull() & F.col("_s").isNotNull())
    out = df.join(labels, id)
    new = {category: F.col("_c"), section: F.col("_s")}
    return out.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])


def labelling_time(audit: DataFrame) -> DataFrame:
    """Seconds per step over all rows; what is no number counts nothing."""
    steps = ("category", "section", "total")
    return audit.agg(
        *[
            F.coalesce(
                F.sum(F.col(f"{s}_processing_time_seconds").cast("string").try_cast("double")), F.lit(0.0)
            ).alias(f"{s}_seconds")
            for s in steps
        ]
    )


def status_counts(audit: DataFrame) -> DataFrame:
    return audit.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
