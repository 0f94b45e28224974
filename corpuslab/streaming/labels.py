"""Label documents as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpuslab.sources.audit import AuditLog


def label_stream(
    stream: DataFrame,
    label: Callable[[DataFrame], DataFrame],
    log: AuditLog,
    checkpoint: str,
    *,
    id: str = "id",
    remember: str = "1 day",
) -> StreamingQuery:
    """Append audit records for the documents of a stream, then stop.

    A document delivered again within ``remember`` is dropped by state; one
    that was labelled before is dropped by the audit.  The watermark follows
    the time of arrival, so no document is ever late and lost.  A micro-batch
    that is repeated after a failure asks only for what it did not write.  Of
    the audit a batch reads id, status and time, in the folders of its ids.
    """
    columns = stream.columns
    arrived = stream.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", remember)
    fresh = arrived.dropDuplicatesWithinWatermark([id]).select(*columns)

    def write(batch: DataFrame, _: int) -> None:
        if batch.isEmpty():  # a batch that only advances the watermark
            return
        log.append(label(log.pending(batch, id)))

    return (
        fresh.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
