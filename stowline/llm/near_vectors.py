"""Near-duplicate vectors by int8 tile products with bounds on what rounding hides."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from stowline.llm.components import components, joined
from stowline.llm.storage import forget, saved
from stowline.llm.tiles import longs, matrix, packed, usable, with_tiles

TILE_ROWS = 4096
BLOCK_ROWS = 512
PAIRS_AT_ONCE = 1 << 15
#: Covers rounding of norms and sums in double precision.
SLACK = 1e-9
#: Up to this many dimensions, sums of int8 products are exact in single precision.
EXACT_DIM = 1024


def quantised(vectors):
    """(codes, scales, errors, norms): unit vectors as int8 codes times a scale, and the length of the rest."""
    wide = vectors.astype(np.float64)
    # Vectors of huge or tiny components are scaled first, so that squares stay finite.
    top = np.abs(wide).max(axis=1)
    wide /= top[:, None]
    norms = np.sqrt((wide * wide).sum(axis=1))
    unit = wide / norms[:, None]
    scales = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scales[:, None])
    rest = unit - codes * scales[:, None]
    return codes.astype(np.int8), scales, np.sqrt((rest * rest).sum(axis=1)), unit


def linked_pairs(left, right, threshold, same=False):
    """Yield (i, j) arrays of all pairs with cosine >= threshold; with ``same``, only i < j.

    A product of codes differs from the cosine by no more than e_i + e_j + e_i * e_j, the
    lengths of what rounding took from either unit vector. Pairs that this leaves possible
    are computed again in double precision.
    """
    codes_a, scale_a, error_a, unit_a = left
    codes_b, scale_b, error_b, unit_b = right
    kind = np.float32 if codes_a.shape[1] <= EXACT_DIM else np.float64
    columns = codes_b.astype(kind).T
    top_scale, top_error = scale_b.max(), error_b.max()
    for begin in range(0, len(codes_a), BLOCK_ROWS):
        end = min(begin + BLOCK_ROWS, len(codes_a))
        product = codes_a[begin:end].astype(kind) @ columns
        error, scale = error_a[begin:end], scale_a[begin:end]
        # The lowest product at which any pair of the row can reach the threshold.
        need = (threshold - error - top_error - error * top_error - SLACK) / (scale * top_scale)
        need = np.where(need > 0, need, -np.inf).astype(kind) * kind(1 - 1e-6)
        i, j = np.nonzero(product >= need[:, None])
        value = product[i, j].astype(np.float64)
        bound = value * scale[i] * scale_b[j] + error[i] + error_b[j] + error[i] * error_b[j] + SLACK
        likely = bound >= threshold
        if same:
            likely &= i + begin < j
        i, j = i[likely] + begin, j[likely]
        for at in range(0, len(i), PAIRS_AT_ONCE):
            a, b = i[at : at + PAIRS_AT_ONCE], j[at : at + PAIRS_AT_ONCE]
            exact = np.einsum("ij,ij->i", unit_a[a], unit_b[b]) >= threshold
            if exact.any():
                yield a[exact], b[exact]


def near_vectors(vectors, id="vec_id", vector="embedding", threshold=0.9):
    """Rows (id, n_links, component_id, kept): links of cosine >= threshold among all vectors.

    n_links counts other vectors linked directly, component_id is the smallest id reached,
    kept tells that it is the row's own. Vectors that are null, zero, or hold null or
    non-finite components link with nothing, nor do vectors of different lengths. Equal
    vectors (by a 128-bit fingerprint) are compared once and stand for all their rows. The
    others go into tiles of some 4,096 by hash, and each pair of tiles is one task's work of
    bounded memory: counts and a forest of links leave it, not pairs. All pairs of tiles are
    needed for exact links, so work grows with the square of different vectors.
    Rows of a repeated id count as vectors of their own, with links of their own; a null id is
    left out of links.
    """
    good = usable(F.col(vector)) & F.exists(vector, lambda x: x != 0) & F.col(id).isNotNull()
    rows = vectors.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("vector"), good.alias("good"))
    keys_of = {"k1": F.xxhash64("vector"), "k2": F.xxhash64(F.lit("second"), "vector")}
    keys = rows.where("good").select("id", *[column.alias(name) for name, column in keys_of.items()])
    classes = saved(keys.groupBy("k1", "k2").agg(F.min("id").alias("rep"), F.count("*").alias("n")), "classes")
    members = saved(keys.join(classes, ["k1", "k2"]), "members")
    # A class is known by its smallest id and its fingerprint, as ids may be repeated.
    own = classes.select(F.col("rep").alias("id"), "k1", "k2", "n")
    picked = rows.where("good").select("id", "vector", *[keys_of[c].alias(c) for c in ("k1", "k2")])
    picked = picked.join(own, ["id", "k1", "k2"]).dropDuplicates(["id", "k1", "k2"])
    tiled, tiles = with_tiles(picked, "id", "vector", TILE_ROWS)
    kind = np.float32 if vectors.schema[vector].dataType.elementType.typeName() == "float" else np.float64
    stored = saved(packed(tiled, ["id", "k1", "k2", "n"], "vector", kind), "tiles")
    other = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))
    met = stored.withColumn("other", other).select(
        "*", F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b")
    )

    def meet(key, table):
        dim = key[0].as_py()
        sides = []
        for row in table.sort_by("tile").to_pylist():
            names = np.stack([longs(row[c]) for c in ("id", "k1", "k2")])
            sides.append((names, longs(row["n"]), quantised(matrix(row["vector"], dim, kind))))
        alone = key[1].as_py() == key[2].as_py()
        if len(sides) < 2 and not alone:
            sides = []
        ids, counts = np.zeros((3, 0), np.int64), np.zeros(0, np.int64)
        parent = np.zeros(0, np.int64)
        if sides:
            (ids_a, n_a, left), (ids_b, n_b, right) = sides[0], sides[-1]
            ids = ids_a if alone else np.concatenate([ids_a, ids_b], axis=1)
            shift = 0 if alone else len(n_a)
            parent, counts = np.arange(ids.shape[1]), np.zeros(ids.shape[1], np.int64)
            for i, j in linked_pairs(left, right, threshold, same=alone):
                np.add.at(counts, i, n_b[j])
                np.add.at(counts, j + shift, n_a[i])
                parent = joined(parent, i, j + shift)
        linked = np.flatnonzero(counts)
        columns = [*ids[:, linked], counts[linked], *ids[:, parent[linked]]]
        return pa.table([pa.array(c) for c in columns], names=["rep", "k1", "k2", "links", "rep2", "k12", "k22"])

    found = saved(
        met.groupBy("dim", "a", "b").applyInArrow(meet, "rep long, k1 long, k2 long, links long, rep2 long, k12 long, k22 long"),
        "links",
    )
    sums = found.groupBy("rep", "k1", "k2").agg(F.sum("links").alias("links"))
    # Nodes are structs that begin with the smallest id, so the smallest node names the component.
    node = F.struct("rep", "k1", "k2")
    near = F.struct(F.col("rep2").alias("rep"), F.col("k12").alias("k1"), F.col("k22").alias("k2"))
    comps = components(found.select(node.alias("a"), near.alias("b")))
    forget(stored)
    forget(classes)
    comps = comps.select("node.*", F.col("component.rep").alias("component"))
    linked = members.join(sums, ["rep", "k1", "k2"], "left").join(comps, ["rep", "k1", "k2"], "left").select(
        "id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    rest = rows.where("not good").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.union(rest).select(
        F.col("id").alias(id), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept")
    )
