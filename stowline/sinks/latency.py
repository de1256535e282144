"""Latency log: one number per line."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stowline.functions.latency import latency_ms


def latency_lines(
    records: DataFrame, now: Column | datetime | None = None, drop_null: bool = False
) -> DataFrame:
    """The lines of the log: the latency of each record in milliseconds, as text.

    A record without timestamp fails the query unless ``drop_null`` leaves it out.
    """
    latency = latency_ms("timestamp", now)
    if drop_null:
        records = records.where(F.col("timestamp").isNotNull())
    else:
        latency = F.coalesce(latency, F.raise_error(F.lit("record has no timestamp")).cast("long"))
    return records.select(latency.cast("string").alias("value"))


def append_latencies(
    records: DataFrame, directory: str, now: Column | datetime | None = None, drop_null: bool = False
) -> None:
    """Append the latencies of a batch to a directory of text files."""
    latency_lines(records, now, drop_null).write.mode("append").text(directory)
