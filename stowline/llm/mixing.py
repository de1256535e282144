"""Mixing sources to target weights by entropy balancing."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from stowline.llm.storage import SMALL_ROWS, forget, saved

#: Words are runs of other characters than space and the control characters 9 to 13.
WORD = "[^\\x20\\x09-\\x0D]+"
MOST_COPIES = 3
#: Rows that one ranking by hash may hold; larger cells are cut by hash.
CELL_ROWS = 512
ROUNDS = 60
REPAIRS = 2
CLOSE = 1e-7


def word_count(text):
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes, weights=(5.0, 2.0, 1.0), most=MOST_COPIES):
    """Rows (source, source_size, target) from rows (source, size).

    Sources in code point order, null last, take the weights in turn and share all sizes in
    proportion; no target exceeds ``most`` times its source's size, the excess goes to the
    others by weight. One row per source, ranked in one task: the list of sources is short
    against the rows. Level t, at which every source gets the smaller of t times its weight
    and its limit, is the largest over k of what is left for a weight of 1 once the k
    sources of the lowest limit per weight are at their limits.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = totals.withColumn(
        "rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    )
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("limit", most * F.col("source_size"))
    order = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0))
    ranked = ranked.withColumn("level", left / F.sum("weight").over(after))
    level = F.max("level").over(everything)
    target = F.least(F.col("limit").cast("double"), level * F.col("weight"))
    return ranked.select("source", "source_size", target.alias("target"))


def balanced_tilts(cells, targets, most=MOST_COPIES):
    """Rows (source, tilt, mean) whose rates meet the targets.

    Entropy balancing chooses rates r, at most ``most``, that are closest to one in relative
    entropy while the words of a source come to its target: r = min(most, exp(tilt * x)) with
    x the size over the source's mean size. The tilt is the root of the convex dual's
    derivative, the words taken less the target. Each round sums derivative and second
    derivative over the executors for all sources at once and takes a Newton step, halving
    the bracket where the step leaves it.

    ``cells``: rows (source, size, n), n documents of one size. A source whose target is its
    limit takes every document ``most`` times; without words, its tilt is 0.
    """
    means = cells.groupBy("source").agg(
        F.sum("n").alias("docs"), F.sum(F.col("n") * F.col("size")).alias("words")
    )
    same = F.col("c.source").eqNullSafe(F.col("s.source"))
    mean = F.greatest(F.col("words") / F.col("docs"), F.lit(1e-9))
    full = F.col("target") >= most * F.col("words") * (1 - 1e-12)
    state = saved(
        means.alias("c").join(targets.alias("s"), same).select(
            "s.source", "s.target", mean.alias("mean"), F.lit(0.0).alias("tilt"),
            F.lit(-1e6).alias("low"), F.lit(1e6).alias("high"), (full | (F.col("words") == 0)).alias("done"), full.alias("full"),
        ),
        "tilts",
    )
    small = state.count() <= SMALL_ROWS
    x = F.col("size") / F.col("mean")
    rate = F.least(F.lit(float(most)), F.exp(F.least(F.col("tilt") * x, F.lit(50.0))))
    words = F.col("n") * F.col("size") * rate
    for _ in range(ROUNDS):
        if not state.where("not done").head(1):
            break
        part = F.broadcast(state) if small else state
        sums = cells.alias("c").join(part.where("not done").alias("s"), same).groupBy("s.source").agg(
            F.sum(words).alias("got"), F.sum(F.when(rate < most, words * x).otherwise(0.0)).alias("slope")
        )
        gap = F.col("got") - F.col("target")
        low, high = (F.when(gap < 0, F.col("tilt")).otherwise(F.col("low")), F.when(gap > 0, F.col("tilt")).otherwise(F.col("high")))
        step = F.col("tilt") - gap / F.col("slope")
        inside = (F.col("slope") > 0) & (step > low) & (step < high)
        close = F.abs(gap) <= CLOSE * F.greatest(F.col("target"), F.lit(1.0))
        # Without a slope, every word is at its limit: search by halving, at first near zero.
        half = F.when((low > -1e6) & (high < 1e6), (low + high) / 2).when(high < 1e6, F.least(F.lit(-1.0), 2 * F.col("tilt"))).otherwise(F.greatest(F.lit(1.0), 2 * F.col("tilt")))
        moved = state.alias("c").join(sums.alias("s"), same, "left").select(
            "c.source", "c.target", "c.mean",
            F.when(F.col("done") | close, F.col("tilt")).when(inside, step).otherwise(half).alias("tilt"),
            F.when(F.col("done"), F.col("low")).otherwise(low).alias("low"), F.when(F.col("done"), F.col("high")).otherwise(high).alias("high"),
            (F.col("done") | F.coalesce(close, F.lit(True))).alias("done"), "c.full",
        )
        old, state = state, saved(moved, "tilts")
        forget(old)
    return state.select("source", F.when(F.col("full"), F.lit(1e9)).otherwise(F.col("tilt")).alias("tilt"), "mean")


def mix_sources(sizes, weights=(5.0, 2.0, 1.0), most=MOST_COPIES):
    """Rows (id, source, size) with source_size, target, rate and copies more.

    Rates come from ``balanced_tilts`` and are rounded to copies without chance: documents of
    a source stand in order of size (largest first) and of a hash of their id; the fractions
    of the rates add up along this order, and a document gets one copy more where the sum
    passes a half. So the words of a source miss its target by less than its largest document;
    then twice one document per source is rounded the other way if that lessens the gap.
    Reruns agree. Ranks come from counts of (source, size) cells, cut by hash
    to about 512 rows, so a source or size that holds most rows is ranked in parts.

    A row without words (null or blank text) has rate and copies as its rank says, and takes
    no words. Repeated ids count as rows of their own, whatever their sizes and sources. ``sizes`` is read several times:
    store it first if it is dear to compute.
    """
    cells = saved(sizes.groupBy("source", "size").agg(F.count("*").alias("n")), "cells")
    targets = saved(source_targets(sizes, weights, most), "targets")
    tilts = balanced_tilts(cells, targets, most)
    same = lambda a, b: F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))
    few = targets.count() <= SMALL_ROWS
    one_row = (lambda df: F.broadcast(df)) if few else (lambda df: df)
    x = F.col("tilt") * F.col("size") / F.col("mean")
    rate = F.when(F.col("tilt") >= 1e9, F.lit(float(most))).otherwise(F.least(F.lit(float(most)), F.exp(F.least(x, F.lit(50.0)))))
    plan = one_row(targets.alias("a").join(tilts.alias("b"), same("a", "b")).select("a.*", "b.tilt", "b.mean"))
    rated = cells.alias("c").join(plan.alias("p"), same("c", "p")).select(
        "c.source", "c.size", "n", F.round(rate, 9).alias("rate"), F.ceil(F.col("n") / CELL_ROWS).alias("parts")
    )
    many = rated.where("parts > 1").select("source", "size", "parts")
    many = F.broadcast(many) if many.count() <= SMALL_ROWS else many
    both = F.col("d.source").eqNullSafe(F.col("m.source")) & (F.col("d.size") == F.col("m.size"))
    part = F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64(F.lit("part"), "d.id"), F.col("parts")))
    placed = sizes.alias("d").join(many.alias("m"), both, "left").select("d.*", part.cast("long").alias("part"))
    counts = placed.groupBy("source", "size", "part").agg(F.count("*").alias("rows"))
    rates = rated.select("source", "size", "rate")
    both = F.col("d.source").eqNullSafe(F.col("r.source")) & (F.col("d.size") == F.col("r.size"))
    counts = counts.alias("d").join(rates.alias("r"), both).select("d.*", "rate")
    along = Window.partitionBy("source").orderBy(F.desc("size"), "part").rowsBetween(Window.unboundedPreceding, -1)
    extra = (F.col("rate") - F.floor("rate")).cast("decimal(12,9)")
    starts = counts.withColumn("start", F.coalesce(F.sum(F.col("rows") * extra).over(along), F.lit(0).cast("decimal(38,9)")))
    inside = Window.partitionBy("source", "size", "part").orderBy(F.xxhash64(F.lit("rank"), "id"), "id")
    ranked = placed.withColumn("rank", F.row_number().over(inside))
    both = both & (F.col("d.part") == F.col("r.part"))
    upto = lambda rank: F.floor(F.col("start") + rank * extra + F.lit(0.5).cast("decimal(2,1)"))
    copies = F.floor("rate") + upto(F.col("rank")) - upto(F.col("rank") - 1)
    done = ranked.alias("d").join(starts.alias("r"), both).select(
        "d.id", "d.source", "d.size", "d.part", "d.rank", "rate", copies.cast("long").alias("copies")
    )
    done = saved(done, "copies")
    for _ in range(REPAIRS):
        old, done = done, saved(_repaired(done, one_row(targets), one_row), "copies")
        forget(old)
    return done.alias("d").join(one_row(targets).alias("t"), same("d", "t")).select(
        "d.id", "d.source", "d.size", "t.source_size", "t.target", "rate", "copies"
    )


def _repaired(done, targets, one_row):
    """Round one document per source the other way, that whose size is nearest the gap left.

    A row is known by its source, size, part and rank, as its id may be repeated.
    """
    same = F.col("d.source").eqNullSafe(F.col("t.source"))
    sums = done.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("got"))
    gaps = sums.alias("d").join(targets.alias("t"), same).select("d.source", (F.col("target") - F.col("got")).alias("gap"))
    gaps = one_row(gaps)
    up = (F.col("gap") > 0) & (F.col("copies") == F.floor("rate")) & (F.col("rate") > F.col("copies"))
    down = (F.col("gap") < 0) & (F.col("copies") > F.col("rate"))
    far = F.abs(F.col("size") - F.abs("gap"))
    picked = (
        done.alias("d").join(gaps.alias("t"), same).where((up | down) & (far < F.abs("gap")))
        .groupBy("d.source").agg(F.min(F.struct(far.alias("far"), F.xxhash64(F.lit("repair"), "id"), "id", "size", "part", "rank")).alias("best"), F.first(F.signum("gap")).cast("long").alias("step"))
        .select("source", "best.size", "best.part", "best.rank", "step")
    )
    for column in ("size", "part", "rank"):
        same = same & (F.col(f"d.{column}") == F.col(f"t.{column}"))
    return done.alias("d").join(one_row(picked).alias("t"), same, "left").select(
        "d.id", "d.source", "d.size", "d.part", "d.rank", "rate", (F.col("copies") + F.coalesce("step", F.lit(0))).alias("copies")
    )
