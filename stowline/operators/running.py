"""Running totals and predecessors that stay parallel inside one large group.

A window over a whole group runs in one task. Here the group is cut into blocks
of ``width`` consecutive values of the order column; windows run per block and
one small row per block carries the state of the blocks before it.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_WIDTH = 1 << 20


def block_of(order_col: str, width: int) -> Column:
    return F.expr(f"`{order_col}` div {width}")


def _beside(rows: DataFrame, carried: DataFrame, cells: list[str]) -> DataFrame:
    """Rows with the one row of their cell; null keys are a group like any other."""
    named = carried.withColumnsRenamed({c: f"_of_{c}" for c in cells})
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in cells]
    return rows.join(named, same, "left")


def running_total(
    df: DataFrame,
    keys: list[str],
    order_col: str,
    value: Column,
    name: str,
    width: int = BLOCK_WIDTH,
) -> DataFrame:
    """Add ``name``: sum of ``value`` over the rows of the group up to this one.

    ``order_col`` is a whole number, unique in its group; a null key is a group of its own.
    """
    blocked = df.withColumn("_block", block_of(order_col, width)).withColumn("_value", value)
    cells = keys + ["_block"]
    before = (
        blocked.groupBy(*cells)
        .agg(F.sum("_value").alias("_total"))
        .withColumn(
            "_before",
            F.coalesce(
                F.sum("_total").over(
                    Window.partitionBy(*keys)
                    .orderBy("_block")
                    .rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ),
        )
        .drop("_total")
    )
    inside = F.sum("_value").over(
        Window.partitionBy(*cells)
        .orderBy(order_col)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        blocked.withColumn(name, inside)
        .transform(lambda found: _beside(found, before, cells))
        .withColumn(name, F.col(name) + F.col("_before"))
        .select(*df.columns, name)
    )


def previous_value(
    df: DataFrame,
    keys: list[str],
    order_col: str,
    value_col: str,
    name: str,
    width: int = BLOCK_WIDTH,
) -> DataFrame:
    """Add ``name``: ``value_col`` of the row before this one in the group, or null."""
    blocked = df.withColumn("_block", block_of(order_col, width))
    cells = keys + ["_block"]
    edges = (
        blocked.groupBy(*cells)
        .agg(F.max_by(value_col, order_col).alias("_last"))
        .withColumn("_edge", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_block")))
        .drop("_last")
    )
    in_block = Window.partitionBy(*cells).orderBy(order_col)
    return (
        blocked.withColumn(name, F.lag(value_col).over(in_block))
        .withColumn("_first", F.row_number().over(in_block) == 1)
        .transform(lambda found: _beside(found, edges, cells))
        .withColumn(name, F.when(F.col("_first"), F.col("_edge")).otherwise(F.col(name)))
        .select(*df.columns, name)
    )
