"""Documents to packed sequences: select, deduplicate three ways, pack."""

from __future__ import annotations

import public_tokenizers
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpuslab
from corpuslab.llm.exact_dedup import drop_exact_copies
from corpuslab.llm.packing import packed_documents
from corpuslab.llm.quality import select_documents
from corpuslab.llm.simhash import keep_one_per_similar
from corpuslab.llm.substring_dedup import without_repeats
from corpuslab.session import materialize

cloudpickle.register_pickle_by_value(corpuslab)  # functions travel inside the tasks


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject: the tail probability of the good grade reaches its bound."""
    return select_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_exact_copies(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest identifier of each group of texts that share 0.8 of their five-word shingles."""
    return keep_one_per_similar(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that occur before; n_chars follows the text."""
    cleaned = without_repeats(docs)
    return cleaned.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else cleaned


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 1024 tokens."""
    path = public_tokenizers.path
    return packed_documents(docs, path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality", quality_stage), ("exact", exact_stage), ("simhash", simhash_stage), ("substring", substring_stage),
    ("packing", packing_stage),
]

#: The quality classifier, the chunking and the tokenizer have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
