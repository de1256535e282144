"""Order-dependent columns of line tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stowline.functions.text import text_byte_length
from stowline.operators.running import BLOCK_WIDTH, running_total

BATCH_SIZE = 2000


def line_position(
    lines: DataFrame,
    file_keys: list[str],
    order_col: str,
    line: str = "line",
    terminator: int | str = 1,
    charset: str = "UTF-8",
    first: int = 0,
    width: int = BLOCK_WIDTH,
) -> DataFrame:
    """Add ``position``: the byte at which the next line of the file starts.

    ``terminator`` is the length of the line end in bytes, or a column with it;
    ``first`` the bytes before the first line (2 for a UTF-16 mark).
    """
    ending = F.col(terminator) if isinstance(terminator, str) else F.lit(terminator)
    size = text_byte_length(line, charset) + ending.cast("long")
    return running_total(lines, file_keys, order_col, size, "position", width).withColumn(
        "position", F.col("position") + first
    )


def batch_number(
    rows: DataFrame,
    file_keys: list[str],
    order_col: str,
    batch_size: int = BATCH_SIZE,
    width: int = BLOCK_WIDTH,
) -> DataFrame:
    """Add ``batch``: 0 for the first ``batch_size`` rows of each file, then 1, and so on."""
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    counted = running_total(rows, file_keys, order_col, F.lit(1).cast("long"), "_count", width)
    return counted.withColumn("batch", F.expr(f"(_count - 1) div {batch_size}")).drop("_count")
