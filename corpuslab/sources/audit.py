"""The audit of a labelling run: an append-only table, latest row wins."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslab.operators.labelling import AUDIT_SCHEMA, apply_labels, pending
from corpuslab.operators.quality import assert_ok, check_schema, check_unique_id
from corpuslab.operators.sets import latest
from corpuslab.session import materialize


PARTS = 16  # folders of a log, by a hash of the id; more for a log of billions of records


class AuditLog:
    """Records by id, in folders by a hash of the id.

    A checkpoint appends the new records and rewrites nothing, so its cost
    grows with the batch and not with the audit.  A job that is repeated after
    a failure only adds newer rows of the same ids.  What is pending of a batch
    is found in the folders of its ids, from id, status and time alone.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType = AUDIT_SCHEMA, parts: int = PARTS):
        self.spark, self.path, self.schema, self.parts = spark, path, schema, parts

    def _part(self, id: str = "id") -> Column:
        return F.pmod(F.xxhash64(F.col(id).cast(self.schema["id"].dataType)), F.lit(self.parts)).cast("int")

    def _rows(self) -> DataFrame:
        """All records with their folder ``part``."""
        try:
            found = self.spark.read.parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            found = self.spark.createDataFrame([], self.schema)
        lacking = sorted(set(self.schema.names) - set(found.columns))
        if lacking:
            raise ValueError(f"the audit lacks columns: {', '.join(lacking)}")
        part = F.col("part") if "part" in found.columns else self._part()  # a log written without folders
        return found.select(*self.schema.names, part.alias("part"))

    def _latest(self, rows: DataFrame, columns: Sequence[str]) -> DataFrame:
        order = ["generated_at_utc", "status"]
        needed = list(dict.fromkeys(["id", *columns, *order]))
        return latest(rows.select(*needed), "id", order).select(*columns)

    def current(self, columns: Sequence[str] | None = None) -> DataFrame:
        """The last record of every id, with all columns or the named ones."""
        return self._latest(self._rows(), list(columns or self.schema.names))

    def states(self, ids: DataFrame, id: str = "id") -> DataFrame:
        """id and last status of the records in the folders of ``ids``; other folders and columns are not read."""
        touched = [r[0] for r in ids.select(self._part(id).alias("part")).distinct().collect()]  # ``parts`` at most
        return self._latest(self._rows().filter(F.col("part").isin(touched)), ["id", "status"])

    def pending(self, batch: DataFrame, id: str = "id") -> DataFrame:
        """Rows of a batch without a successful last record."""
        return pending(batch, self.states(batch, id), id)

    def append(self, records: DataFrame) -> None:
        self._write(records, "append")

    def _write(self, records: DataFrame, mode: str) -> None:
        # Rebalancing gives few files to a small batch and many tasks to a large one.
        rows = records.select(*self.schema.names, self._part().alias("part")).hint("rebalance", "part").sortWithinPartitions("part", "id")
        rows.write.mode(mode).partitionBy("part").parquet(self.path)

    def compact(self, path: str) -> AuditLog:
        """Write the current records, sorted by id in each folder, as a new log."""
        log = AuditLog(self.spark, path, self.schema, self.parts)
        log._write(self.current(), "errorifexists")
        return log


def load_audit(spark: SparkSession, path: str, schema: T.StructType = AUDIT_SCHEMA) -> DataFrame:
    """The audit, or an empty one; columns and ids are checked."""
    audit = AuditLog(spark, path, schema).current()
    assert_ok(check_unique_id(audit, "id"))
    return audit


def run_labelling(
    train: DataFrame,
    log: AuditLog,
    label: Callable[[DataFrame], DataFrame],
    id: str = "id",
    batches: int = 1,
) -> DataFrame:
    """Label what is pending, in ``batches`` checkpoints; give the labelled set.

    ``label`` maps pending rows to audit records.  Failed rows stay pending and
    are tried again by the next run; a run without pending rows asks nothing.
    """
    assert_ok(check_schema(train, [id]))
    todo = log.pending(train, id)
    if batches > 1:
        part = F.pmod(F.xxhash64(F.col(id)), F.lit(batches)).cast("int")
        todo = materialize(todo.withColumn("_batch", part), "pending")
        for i in range(batches):
            log.append(label(todo.filter(F.col("_batch") == i).drop("_batch")))
    else:
        log.append(label(todo))
    return apply_labels(train, log.current(["id", "status", "llm_category", "llm_section"]), id)
