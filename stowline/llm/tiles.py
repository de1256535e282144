"""Vectors in tiles of bounded size, and every pair of tiles once."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F


def usable(vector):
    """Whether a vector is there and all of its components are finite numbers."""
    return F.coalesce(
        vector.isNotNull()
        & F.forall(vector, lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False))),
        F.lit(False),
    )


def with_tiles(vectors, id, vector, rows):
    """``vectors`` with dim and tile more, and the number of tiles.

    A tile holds some ``rows`` vectors, fewer where the longest has above 256 components.
    """
    count, longest = vectors.agg(F.count("*"), F.max(F.size(vector))).first()
    tiles = count // max(1, min(rows, (rows << 8) // max(longest or 1, 1))) + 1
    return vectors.withColumn("dim", F.size(vector)).withColumn(
        "tile", F.pmod(F.xxhash64(F.lit("tile"), id), F.lit(tiles)).cast("int")
    ), tiles


def packed(tiled, columns, vector, dtype):
    """One row per (dim, tile): its vectors as one binary, and long columns as one binary each."""

    def pack(key, table):
        flat = pa.chunked_array(table.column(vector).chunks).combine_chunks().flatten()
        parts = [np.ascontiguousarray(flat.to_numpy(zero_copy_only=False), dtype).tobytes()]
        parts += [table.column(c).to_numpy().astype(np.int64).tobytes() for c in columns]
        place = [pa.array([k.as_py()], pa.int32()) for k in key]
        return pa.table([*place, *[pa.array([p], pa.binary()) for p in parts]], names=["dim", "tile", vector, *columns])

    binary = ", ".join(f"`{c}` binary" for c in (vector, *columns))
    return (
        tiled.select("dim", "tile", vector, *columns)
        .groupBy("dim", "tile")
        .applyInArrow(pack, f"dim int, tile int, {binary}")
    )


def longs(value):
    return np.frombuffer(value, np.int64)


def matrix(value, dim, dtype):
    return np.frombuffer(value, dtype).reshape(-1, dim) if dim else np.zeros((0, 0), dtype)
