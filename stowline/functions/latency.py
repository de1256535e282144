"""Delivery latency."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def latency_ms(timestamp="timestamp", now=None) -> Column:
    """Milliseconds from the record timestamp to ``now``.

    ``now`` defaults to the query's clock, which Spark reads once per batch. A
    null timestamp gives null.
    """
    timestamp = timestamp if isinstance(timestamp, Column) else F.col(timestamp)
    if now is None:
        now = F.current_timestamp()
    elif not isinstance(now, Column):
        now = F.lit(now)
    return F.unix_millis(now.cast("timestamp")) - F.unix_millis(timestamp)
