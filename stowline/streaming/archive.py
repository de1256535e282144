"""Archiving and measuring a stream of records."""

from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from stowline.functions.codec import SEGMENT_CAPACITY
from stowline.operators.records import dedupe_records
from stowline.plans.archive import archive_records
from stowline.sinks.latency import latency_lines
from stowline.streaming.dedupe import first_deliveries


def _start(writer, trigger: dict | None) -> StreamingQuery:
    return writer.trigger(**(trigger or {"processingTime": "60 seconds"})).start()


def write_segments_stream(
    records: DataFrame,
    path: str,
    checkpoint: str,
    prefix: str = "",
    cap: int = SEGMENT_CAPACITY,
    trigger: dict | None = None,
    dedupe: bool = False,
) -> StreamingQuery:
    """Archive a stream; every micro-batch is one flush.

    Offsets are committed after a batch is written. A batch that is run again has the
    same records, so the same keys and bytes, and overwrites itself. ``dedupe`` drops
    records delivered twice: within a batch, which would otherwise fail it, and in later
    batches, also after a restart. A batch is kept on the executors while it is packed, as
    packing reads it twice.
    """

    def flush(batch: DataFrame, _epoch: int) -> None:
        batch = dedupe_records(batch) if dedupe else batch
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            archive_records(batch, path, prefix, cap)
        finally:
            batch.unpersist()

    records = first_deliveries(records) if dedupe else records
    return _start(
        records.writeStream.foreachBatch(flush).option("checkpointLocation", checkpoint), trigger
    )


def append_latencies_stream(
    records: DataFrame,
    directory: str,
    checkpoint: str,
    now: Column | datetime | None = None,
    drop_null: bool = False,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append the latency of every record of a stream; one clock reading per micro-batch."""
    return _start(
        latency_lines(records, now, drop_null)
        .writeStream.format("text")
        .option("path", directory)
        .option("checkpointLocation", checkpoint),
        trigger,
    )
