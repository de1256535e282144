"""Exact top k by inner product, with a three-phase uniform threshold."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from stowline.llm.storage import saved
from stowline.llm.tiles import longs, matrix, packed, usable, with_tiles

TILE_ROWS = 8192
QUERY_ROWS = 512
#: Score lists per query and tile: the inner products over as many stretches of dimensions.
LISTS = 4
QUERIES_AT_ONCE = 64
EXACT = 1 << 53


def _lists(queries, rows, lists):
    """For each query its scores of all rows, one array of exact whole numbers per list."""
    dim = queries.shape[1]
    edges = np.linspace(0, dim, lists + 1).astype(int)
    top = float(np.abs(queries.astype(np.float64)).max(initial=0)) * float(np.abs(rows.astype(np.float64)).max(initial=0))
    kind = np.float64 if top * max(dim, 1) < EXACT else np.int64
    columns = [np.ascontiguousarray(rows[:, a:b].astype(kind).T) for a, b in zip(edges[:-1], edges[1:])]
    for begin in range(0, len(queries), QUERIES_AT_ONCE):
        some = queries[begin : begin + QUERIES_AT_ONCE].astype(kind)
        parts = [some[:, a:b] @ c for a, b, c in zip(edges[:-1], edges[1:], columns)]
        for n in range(len(some)):
            yield [p[n] for p in parts]


def _best(score, ids, k):
    """Places of the k highest scores, ties by smaller id, highest first."""
    if len(score) > 8 * k:
        limit = np.partition(score, len(score) - k)[len(score) - k]
        places = np.flatnonzero(score >= limit)
    else:
        places = np.arange(len(score))
    return places[np.lexsort((ids[places], -score[places]))][:k]


def top_scores(vectors, queries, k=10, id="vec_id", vector="vector", lists=LISTS):
    """Rows (query_id, rank, id, score): each query's k highest inner products among all rows.

    Both tables have a long id and a vector of whole numbers (array of long). A row is no
    candidate of a query with its own id; ties go to the smaller id; fewer than k candidates
    are all returned. Vectors that are null or hold nulls, and those without an id, take no
    part; vectors of different lengths have no score.

    Rows of equal id and vector are one row, in either table: a repeated query is answered
    once, a repeated candidate takes one rank. Rows of one id with different vectors are
    rows of their own: such an id has a whole list, ranked from 1, for each of its vectors
    as a query, and as a candidate may take a rank with each of them.

    Rows are in tiles, and per query a tile has a score list for each of ``lists`` stretches
    of dimensions; an entry's score is the sum over the lists. (1) Each tile takes the k best
    of each list, adds these entries up, and sends its k best sums, with each list's lowest
    value f. (2) The k-th best sum of a query over all tiles is a cutoff t that its answer
    reaches. An entry with a sum of at least t exceeds f by at least (t - sum of f) / lists in
    some list, so tiles collect the entries that do, in any list. (3) These are added up
    exactly, and those below t are dropped; each tile sends its k best, which are ranked.
    """

    def distinct(df, name):
        """Usable rows, equal ones once, each with a key of its own (fixed once written)."""
        rows = df.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("vector"))
        rows = rows.where(usable(F.col("vector")) & F.col("id").isNotNull()).dropDuplicates(["id", "vector"])
        return saved(rows.withColumn("key", F.monotonically_increasing_id()), name)

    tiled, tiles = with_tiles(distinct(vectors, "rows"), "key", "vector", TILE_ROWS)
    stored = saved(packed(tiled, ["id"], "vector", np.int64), "tiles")
    asked, blocks = with_tiles(distinct(queries, "queries"), "key", "vector", QUERY_ROWS)
    asked = asked.withColumnRenamed("tile", "block")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    floors = [f"f{i}" for i in range(lists)]

    def met(questions, columns):
        """Each block of queries with each tile, as rows of one group."""
        blocked = packed(questions.withColumn("tile", F.col("block")), ["id", *columns], "vector", np.int64)
        left = blocked.select("dim", every(tiles).alias("t"), F.col("tile").alias("q"), F.lit(True).alias("asks"), "vector", "id", *columns)
        right = stored.select(
            "dim", F.col("tile").alias("t"), every(blocks).alias("q"), F.lit(False).alias("asks"), "vector", "id",
            *[F.lit(None).cast("binary").alias(c) for c in columns],
        )
        return left.union(right).groupBy("dim", "t", "q")

    def sides(key, table):
        rows = {r["asks"]: r for r in table.to_pylist()}
        if len(rows) < 2:
            return None
        dim = key[0].as_py()
        a, b = rows[True], rows[False]
        return a, longs(a["id"]), matrix(a["vector"], dim, np.int64), longs(b["id"]), matrix(b["vector"], dim, np.int64)

    def result(rows, names):
        columns = list(zip(*rows)) or [()] * len(names)
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)

    first_names = ["query", "id", "score", *floors]

    def first(key, table):
        found, rows = sides(key, table), []
        if found:
            block, asks, left, ids, right = found
            for query, ask, own in zip(longs(block["key"]).tolist(), asks.tolist(), _lists(left, right, lists)):
                places = np.unique(np.concatenate([_best(p, ids, k + 1) for p in own]))
                places = places[ids[places] != ask]
                sums = sum(p[places] for p in own)
                low = [int(p.min()) for p in own]
                best = _best(sums, ids[places], k)
                rows += [(query, int(ids[places[i]]), int(sums[i]), *low) for i in best] or [(query, None, None, *low)]
        return result(rows, first_names)

    sent = saved(met(asked, ["key"]).applyInArrow(first, ", ".join(f"{n} long" for n in first_names)), "first")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    kth = sent.where("score is not null").withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k)
    lows = sent.groupBy("query").agg(*[F.min(f).alias(f) for f in floors])
    cutoffs = lows.join(kth.select("query", F.col("score").alias("cutoff")), "query", "left").withColumn(
        "full", F.col("cutoff").isNotNull().cast("long")
    )
    told = asked.join(cutoffs.withColumnRenamed("query", "key"), "key").withColumn("cutoff", F.coalesce("cutoff", F.lit(0).cast("long")))

    def second(key, table):
        found, rows = sides(key, table), []
        if found:
            block, asks, left, ids, right = found
            query, cutoff, full = longs(block["key"]), longs(block["cutoff"]), longs(block["full"])
            low = [longs(block[f]) for f in floors]
            for n, (ask, own) in enumerate(zip(asks.tolist(), _lists(left, right, lists))):
                enough = ids != ask
                if full[n]:
                    # Whole numbers: lists * (value - f) against the cutoff less all f.
                    gap = int(cutoff[n]) - sum(int(f[n]) for f in low)
                    reach = -(-gap // lists)
                    some = np.zeros(len(ids), bool)
                    for p, f in zip(own, low):
                        some |= p >= int(f[n]) + reach
                    enough &= some
                places = np.flatnonzero(enough)
                sums = sum(p[places] for p in own)
                if full[n]:
                    reached = sums >= int(cutoff[n])
                    places, sums = places[reached], sums[reached]
                rows += [(int(query[n]), ask, int(ids[places[i]]), int(sums[i])) for i in _best(sums, ids[places], k)]
        return result(rows, ["query", "query_id", "id", "score"])

    final = met(told, ["key", *floors, "cutoff", "full"]).applyInArrow(second, "query long, query_id long, id long, score long")
    ranked = final.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id), "score")
