"""Record tables: topic records (D1) and records made from files (D2)."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stowline.functions.codec import HEADERS_TYPE
from stowline.operators.running import BLOCK_WIDTH, running_total

RECORD_COLUMNS = ["topic", "partition", "offset", "timestamp", "key", "value", "headers"]


def events_as_records(events: DataFrame, width: int = BLOCK_WIDTH) -> DataFrame:
    """Topic records from an event table: topic per event type, four partitions by user.

    Offsets count the events of a topic-partition in ``event_id`` order, from 0.
    """
    keyed = events.select(
        F.col("event_type").alias("topic"),
        F.expr("cast(user_id % 4 as int)").alias("partition"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.encode(F.col("user_id").cast("string"), "UTF-8").alias("key"),
        F.encode("props", "UTF-8").alias("value"),
        F.array(
            F.struct(
                F.lit("event_id").alias("key"),
                F.encode(F.col("event_id").cast("string"), "UTF-8").alias("value"),
            )
        )
        .cast(HEADERS_TYPE)
        .alias("headers"),
        "event_id",
    )
    counted = running_total(
        keyed, ["topic", "partition"], "event_id", F.lit(1).cast("long"), "_count", width
    )
    return counted.withColumn("offset", F.col("_count") - 1).select(*RECORD_COLUMNS, "event_id")


def to_source_records(
    rows: DataFrame,
    topic: str,
    value: str | Column = "line",
    position: str | Column | None = "position",
    progress: str | Column | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Envelope of file rows: where each came from, its topic and value, the reading time.

    Text rows carry the byte position of the next record, Parquet rows a progress
    fraction; the other of the two is null. Partition and key are always null.
    """

    def column(c, to: str) -> Column:
        if c is None:
            return F.lit(None).cast(to)
        return (c if isinstance(c, Column) else F.col(c)).cast(to)

    return rows.select(
        "filename",
        column(position, "long").alias("position"),
        column(progress, "double").alias("progress"),
        F.lit(topic).alias("topic"),
        F.lit(None).cast("int").alias("partition"),
        F.lit(None).cast("binary").alias("key"),
        (value if isinstance(value, Column) else F.col(value)).alias("value"),
        (F.current_timestamp() if now is None else now).alias("timestamp"),
    )


def to_kafka_rows(source_records: DataFrame) -> DataFrame:
    """Rows in the shape Spark's Kafka sink takes; struct values become JSON."""
    value_type = source_records.schema["value"].dataType.typeName()
    value = F.col("value")
    if value_type in ("struct", "array", "map"):
        value = F.to_json(value)
    return source_records.select(
        "topic",
        F.col("partition").cast("int").alias("partition"),
        F.col("key").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.array().cast(HEADERS_TYPE).alias("headers"),
    )


def dedupe_records(records: DataFrame) -> DataFrame:
    """One row per topic, partition, offset: undoes redelivery.

    Of copies that differ, the least stays, by the other columns in their order, so a second
    run keeps the same. ``streaming.dedupe.first_deliveries`` does this across batches.
    """
    key = ["topic", "partition", "offset"]
    others = [c for c in records.columns if c not in key]
    if not others:
        return records.distinct()
    row = F.struct(*others)
    # maps have no order of their own
    order = F.to_json(row) if "map<" in records.select(*others).schema.simpleString() else row
    least = records.groupBy(*key).agg(F.min_by(row, order).alias("_least"))
    return least.select(*[c if c in key else F.col("_least")[c].alias(c) for c in records.columns])
