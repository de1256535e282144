"""Shards by k-d tree: splits at weighted medians along the widest dimension."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from stowline.llm.storage import saved

#: Bits of a place along a dimension, and of the tie-breaking hash below it.
PLACE_BITS, TIE_BITS = 30, 32
#: Bits that one round of counting settles.
ROUND_BITS = 12
#: A split within this share of its node's weight is close enough.
CLOSE = 2e-4
BLOCK_ROWS = 50_000


def kd_shards(points, dims, shards, weight="weight", id="id"):
    """``points`` with a column shard more: leaves of near equal weight.

    ``dims`` are numeric columns; a null counts as the smallest value. A node is split along
    the dimension in which its points spread most (as a share of the spread of all points,
    the first of equals), at the weighted median, or at the fraction of leaves on either
    side when their number is odd; leaves get numbers from left to right. All nodes of a
    level are split together. A median is found by counting weights by 12 bits of the
    position at a time, so a round brings one row per node to the driver, and the tree is at
    most ``shards`` - 1 splits. Points that tie in a dimension are ordered by a hash of their
    id, so even equal points part evenly; rows of one id share a shard. Without points, the
    result is empty.
    """
    shards, spark = int(shards), points.sparkSession
    lowest = F.lit(float("-inf"))
    values = [F.coalesce(F.col(d).cast("double"), lowest) for d in dims]
    bounds = points.agg(*[f(F.when(v > lowest, v)) for v in values for f in (F.min, F.max)]).first()
    spans = [(bounds[2 * i] or 0.0, bounds[2 * i + 1] or 0.0) for i in range(len(dims))]

    def key(i):
        low, high = spans[i]
        share = (F.greatest(values[i], F.lit(low)) - low) / ((high - low) or 1.0)
        place = F.floor(share * ((1 << PLACE_BITS) - 1)).cast("long")
        tie = F.xxhash64(F.lit("tie"), F.lit(i), F.col(id)).bitwiseAND((1 << TIE_BITS) - 1)
        return F.shiftleft(place, TIE_BITS).bitwiseOR(tie)

    ways = [f"_k{i}" for i in range(len(dims))]
    along = F.array(*ways)
    state = saved(points.withColumns({w: key(i) for i, w in enumerate(ways)}).withColumn("_node", F.lit(0)), "tree")
    nodes = [(0, shards)]
    while nodes := [(a, n) for a, n in nodes if n > 1]:
        at = {w: F.shiftright(w, TIE_BITS) for w in ways}
        spread = [(F.max(at[w]) - F.min(at[w])).alias(w) for w in ways]
        found = {r["_node"]: r for r in state.groupBy("_node").agg(F.sum(weight).alias("all"), *spread).collect()}
        # A node without points needs no split: its leaves stay empty.
        open_ = {}
        for first, count in nodes:
            if first in found:
                row = found[first]
                dim = max(range(len(dims)), key=lambda i: (row[ways[i]], -i))
                share = float(row["all"]) * (count // 2) / count
                open_[first] = {"count": count, "dim": dim, "goal": share, "all": float(row["all"]), "low": 0, "bits": PLACE_BITS + TIE_BITS}
        splits = []
        while open_:
            wanted = [(n, s["dim"], s["low"], max(0, s["bits"] - ROUND_BITS), s["goal"]) for n, s in open_.items()]
            wanted = spark.createDataFrame(wanted, "_node int, dim int, low long, shift int, goal double")
            counted = (
                state.join(F.broadcast(wanted), "_node")
                .select("_node", "goal", weight, F.expr(f"shiftright(array({','.join(ways)})[dim] - low, shift)").alias("bin"))
                .where(F.col("bin").between(0, (1 << ROUND_BITS) - 1))
                .groupBy("_node", "bin", "goal").agg(F.sum(weight).cast("double").alias("w"))
            )
            upto = counted.withColumn("upto", F.sum("w").over(Window.partitionBy("_node").orderBy("bin")))
            reached = upto.where("upto >= goal").groupBy("_node").agg(F.min(F.struct("bin", "w", "upto")).alias("hit"))
            for row in reached.collect():
                s, hit = open_[row["_node"]], row["hit"]
                left = max(0, s["bits"] - ROUND_BITS)
                start = s["low"] + (hit["bin"] << left)
                over, under = hit["upto"] - s["goal"], s["goal"] - (hit["upto"] - hit["w"])
                if left == 0 or min(over, under) <= CLOSE * s["all"]:
                    cut = start + (1 << left) - 1 if over <= under else start - 1
                    splits.append((row["_node"], s["dim"], cut, row["_node"] + s["count"] // 2))
                    del open_[row["_node"]]
                else:
                    s |= {"low": start, "bits": left, "goal": under}
        cuts = F.broadcast(spark.createDataFrame(splits, "_node int, dim int, cut long, right int"))
        moved = F.when(F.element_at(along, F.col("dim") + 1) > F.col("cut"), F.col("right")).otherwise(F.col("_node"))
        state = saved(state.join(cuts, "_node", "left").withColumn("_node", moved).drop("dim", "cut", "right"), "tree")
        nodes = [x for a, n in nodes for x in ((a, n // 2), (a + n // 2, n - n // 2))]
    return state.withColumn("shard", F.col("_node").cast("int")).drop("_node", *ways)


def with_slots(sharded, id="id"):
    """``sharded`` (rows with a shard) with slot more: 0, 1, 2, ... within each shard.

    Rows are numbered in blocks by hash of the id, which hold some 50,000 rows together over
    all shards; a block starts where the counts of those before it end.
    """
    rows = sharded.count()
    blocks = rows // BLOCK_ROWS + 1
    split = sharded.withColumn("block", F.pmod(F.xxhash64(F.lit("slot"), id), F.lit(blocks)))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = split.groupBy("shard", "block").agg(F.count("*").alias("n"))
    starts = starts.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "block").orderBy(id)
    numbered = split.withColumn("rank", F.row_number().over(inside))
    return numbered.join(starts, ["shard", "block"]).withColumn("slot", F.col("start") + F.col("rank") - 1).drop("block", "rank", "start")
