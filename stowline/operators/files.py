"""File tables against offset state, and byte ranges of files."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXTENT_STRIDE = 1 << 20
MIN_EXTENT_STRIDE = 8
_EXTENTS_PER_SPAN = 1024


def plan_extents(
    files: DataFrame, stride: int = EXTENT_STRIDE, start_col: str | None = None
) -> DataFrame:
    """Byte ranges of each file: all columns of ``files`` plus ``start`` and ``size``.

    Ranges are ``stride`` long but for the last, and begin at ``start_col`` (0 by
    default). Empty files and starts at or past the end give none.
    """
    if stride < MIN_EXTENT_STRIDE:
        raise ValueError(f"stride must be at least {MIN_EXTENT_STRIDE}")
    span = stride * _EXTENTS_PER_SPAN
    begin = F.col(start_col).cast("long") if start_col else F.lit(0).cast("long")
    last = F.col("length") - 1

    def steps(first: Column, final: Column, step: int) -> Column:
        return F.explode(
            F.when(first <= final, F.sequence(first, final, F.lit(step).cast("long")))
        )

    # in two steps, so that one very large file does not become one very large row
    return (
        files.select("*", steps(begin, last, span).alias("_span"))
        .select(
            "*",
            steps(F.col("_span"), F.least(F.col("_span") + (span - 1), last), stride).alias("start"),
        )
        .drop("_span")
        .withColumn("size", F.least(F.lit(stride).cast("long"), F.col("length") - F.col("start")))
    )


def files_with_offsets(files: DataFrame, offsets: DataFrame) -> DataFrame:
    """Each file with its last ``position`` and ``progress``, null when never read."""
    state = offsets.select(F.col("filename").alias("path"), "position", "progress")
    return files.join(state, "path", "left")


def unfinished_files(files: DataFrame) -> DataFrame:
    """Files not read to their end, of a table with ``length``, ``position``, ``progress``.

    A position at or past the length is the end, so a truncated file is finished.
    """
    done = (F.col("position") >= F.col("length")) | (F.col("progress") >= 1.0)
    return files.where(~F.coalesce(done, F.lit(False)))


def new_files(current: DataFrame, known: DataFrame) -> DataFrame:
    """Files of ``current`` whose path is not in ``known``."""
    return current.join(known.select("path"), "path", "left_anti")


def latest_offsets(source_records: DataFrame) -> DataFrame:
    """Last position and progress per file."""
    return source_records.groupBy("filename").agg(
        F.max("position").alias("position"), F.max("progress").alias("progress")
    )


def invalid_offsets(offsets: DataFrame) -> DataFrame:
    """Offset rows that may not be stored, with the reason in ``error``.

    ``partition`` and ``offset`` are string maps. A null offset resets a file and is
    allowed; any other needs a whole, non-negative ``position`` and a partition
    with a ``filename``.
    """
    position = F.try_element_at("offset", F.lit("position"))
    error = (
        F.when(F.col("offset").isNull(), F.lit(None).cast("string"))
        .when(~F.map_contains_key("offset", F.lit("position")), "position is missing")
        .when(position.isNull() | ~position.rlike(r"\A-?[0-9]+\z"), "position is not a long")
        .when(position.try_cast("long").isNull(), "position is not a long")
        .when(position.try_cast("long") < 0, "position is negative")
        .when(F.col("partition").isNull(), "partition is null")
        .when(~F.map_contains_key("partition", F.lit("filename")), "filename is missing")
    )
    return offsets.withColumn("error", error).where(F.col("error").isNotNull())
