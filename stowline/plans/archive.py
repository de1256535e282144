"""Archive and restore as whole jobs."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stowline.functions.codec import SEGMENT_CAPACITY
from stowline.operators.segments import BLOCK_ROWS, attach_segments, segment_starts
from stowline.scratch import new_folder
from stowline.sinks.segments import write_assigned
from stowline.sources.storage import drop_folder, qualify


# most memory the table of segment starts may take on every executor
BROADCAST_BYTES = 128 << 20
_ROW_BYTES, _START_BYTES = 128, 8


def _fits_broadcast(starts: DataFrame, limit: int) -> bool:
    rows, inside = starts.agg(F.count("*"), F.sum(F.size("_starts"))).first()
    return rows * _ROW_BYTES + (inside or 0) * _START_BYTES <= limit


def archive_records(
    records: DataFrame,
    path: str,
    prefix: str = "",
    cap: int = SEGMENT_CAPACITY,
    epoch_col: str | None = None,
    block_rows: int = BLOCK_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> None:
    """Pack records into segments and write each under its key.

    The segment starts, some bytes per few thousand records, are first written as
    a table in the shared folder and measured. Up to ``broadcast_bytes`` the table is
    broadcast and the payload shuffled once; above that the lookup is a shuffle join.
    ``records`` is evaluated twice, so it must give the same rows each time.
    """
    spark = records.sparkSession
    starts, bucket_rows = segment_starts(records, cap, epoch_col, block_rows)
    table = qualify(spark, new_folder(spark, "starts"))
    try:
        starts.write.parquet(table)
        starts = spark.read.parquet(table)
        if _fits_broadcast(starts, broadcast_bytes):
            starts = F.broadcast(starts)
        assigned = attach_segments(records, starts, bucket_rows, epoch_col)
        write_assigned(assigned, path, prefix, epoch_col)
    finally:
        drop_folder(table)
