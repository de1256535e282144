"""Product quantisation of integer vectors, with nearest entries found by LAESA pivots."""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from stowline.llm.storage import SMALL_ROWS, saved
from stowline.llm.texts import give_back
from stowline.llm.tiles import usable

PARTS, ENTRIES, ROUNDS = 4, 256, 4
#: Entries whose distances to every part are kept: they don't move, unlike the codebook.
PIVOTS = 4
BLOCK_ROWS = 4096
#: Squared distances stay below this.
LARGEST = 1 << 62


def squares(a, b):
    """Exact squared distances of rows of whole numbers."""
    difference = a - b
    return np.einsum("...i,...i->...", difference, difference)


def farthest_first(entries, count=PIVOTS):
    """Places of ``count`` entries, each the farthest from those before it; starts at the first."""
    chosen = [0] if len(entries) else []
    while chosen and len(chosen) < min(count, len(entries)):
        nearest = np.min([squares(entries, entries[c]) for c in chosen], axis=0)
        if nearest.max() == 0:
            break
        chosen.append(int(nearest.argmax()))
    return chosen


def nearest_entries(vectors, to_pivots, entries, pivots):
    """(index, squared distance, evaluations) of each row's nearest entry, ties to the lower index.

    ``to_pivots`` are the rows' squared distances to the pivots. By the triangle inequality no
    entry is nearer than the difference of its and the row's distance to any pivot; this lower
    bound orders a row's entries, and the row ends at the first entry whose bound is above
    the best exact distance so far. All that end a row at once leave the next step.
    """
    rows, count = len(vectors), len(entries)
    best, index = np.full(rows, np.iinfo(np.int64).max), np.full(rows, count)
    done = 0
    for begin in range(0, rows, BLOCK_ROWS):
        here = slice(begin, min(begin + BLOCK_ROWS, rows))
        bound = np.zeros((here.stop - begin, count))
        for k, pivot in enumerate(pivots):
            own, other = np.sqrt(to_pivots[here, k].astype(np.float64)), np.sqrt(squares(entries, pivot).astype(np.float64))
            # Square roots are off by their last digit: keep bounds below the true ones.
            np.maximum(bound, np.abs(own[:, None] - other) - 1e-9 * (own[:, None] + other), out=bound)
        order = np.argsort(bound, axis=1, kind="stable")
        bound = np.square(np.maximum(np.take_along_axis(bound, order, axis=1), 0)) * (1 - 1e-9)
        active = np.arange(len(bound))
        for step in range(count):
            active = active[bound[active, step] <= best[here][active]]
            if not len(active):
                break
            place, entry = active + begin, order[active, step]
            exact = squares(vectors[place], entries[entry])
            done += len(active)
            better = (exact < best[place]) | ((exact == best[place]) & (entry < index[place]))
            best[place[better]], index[place[better]] = exact[better], entry[better]
    return index, best, done


def _matrix(column, width, kind=np.int64):
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), width)


def _assigned(batch, books, pivots, width):
    """Per part (vectors, index, squared distance) of a batch of (vector, squared pivot distances)."""
    vectors = _matrix(batch.column("vector"), len(books) * width)
    kept = [len(p) for p in pivots]
    far = _matrix(batch.column("far"), sum(kept)) if sum(kept) else np.zeros((len(vectors), 0), np.int64)
    edges = np.cumsum([0, *kept])
    for part, book in enumerate(books):
        own = vectors[:, part * width : (part + 1) * width]
        index, best, _ = nearest_entries(own, far[:, edges[part] : edges[part + 1]], book, pivots[part])
        yield own, index, best


def whole_vectors(vectors, id, vector, label=None):
    """Rows (id, label, vector) of usable vectors with components floor(1024 * x)."""
    scaled = F.transform(vector, lambda x: F.floor(F.lit(1024.0) * x.cast("double")))
    group = F.col(label) if label else F.lit(None).cast("int")
    return vectors.where(usable(F.col(vector))).select(
        F.col(id).alias("id"), group.alias("label"), scaled.alias("vector")
    )


def vector_codes(vectors, id="vec_id", vector="embedding", label="label", parts=PARTS, entries=ENTRIES, rounds=ROUNDS):
    """(rows, codebooks): rows (id, code, error, label_error), and per part an array of whole entries.

    Components become floor(1024 * x), vectors are cut into ``parts`` equal stretches. A
    stretch's codebook begins as that of the ``entries`` smallest ids (nulls last, then by
    the vector), in order. Each round every stretch goes to its nearest entry by squared distance, ties to the
    lower index, and an entry becomes the floor of its stretches' mean; unused ones stay.
    ``code`` has the last indices in hexadecimal, two digits each; ``error`` sums the squared
    distances over the stretches, ``label_error`` sums errors over rows of an equal label,
    nulls together.

    Distances to a few fixed pivots, taken from the first codebook, are computed once and
    stored beside the vectors; see ``nearest_entries`` for their use. A round is one map over
    the stored rows: a task sends one sum and count for each entry, which Spark adds up, so
    the driver only sees codebooks.

    Vectors that are null or hold null or non-finite components are left out; with fewer
    vectors than ``entries`` the codebooks are shorter, and an empty table gives no rows and
    no codebooks. Repeated ids and rows are vectors of their own. Vectors of different lengths,
    of a length that ``parts`` doesn't divide, or with components so large that squared
    distances could pass 64 bits (beyond some 500,000 in 16 places) raise an error. Other columns are left aside.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hexadecimal digits: 1 to 256 entries")
    spark = vectors.sparkSession
    rows = whole_vectors(vectors, id, vector, label)
    size, most = F.size("vector"), F.aggregate("vector", F.lit(0).cast("long"), lambda a, x: F.greatest(a, F.abs(x)))
    shape = rows.agg(F.min(size), F.max(size), F.max(most)).first()
    if shape[0] != shape[1] or (shape[0] or 0) % parts:
        raise ValueError(f"vectors have {shape[0]} to {shape[1]} components, not one multiple of {parts}")
    width = (shape[0] or 0) // parts
    if 4 * (shape[2] or 0) ** 2 * width >= LARGEST:
        raise ValueError(f"a scaled component of {shape[2]} takes squared distances beyond 64 bits")
    first = rows.orderBy(F.col("id").asc_nulls_last(), "vector").select("vector").limit(entries).collect()
    start = np.array([r[0] for r in first], np.int64).reshape(len(first), parts * width)
    books = [start[:, p * width : (p + 1) * width].copy() for p in range(parts)]
    pivots = [book[farthest_first(book)] for book in books]

    def with_pivots(batches):
        for batch in batches:
            own = _matrix(batch.column("vector"), parts * width)
            far = [squares(own[:, p * width : (p + 1) * width], pivot) for p in range(parts) for pivot in pivots[p]]
            far = np.stack(far, axis=1).reshape(-1) if far else np.zeros(0, np.int64)
            step = sum(map(len, pivots))
            offsets = pa.array(np.arange(batch.num_rows + 1) * step, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(far, pa.int64()))], ["id", "label", "vector", "far"]
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    stored = saved(rows.mapInArrow(with_pivots, f"{kinds}, far array<bigint>"), "code-vectors")
    for _ in range(rounds if len(first) else 0):
        books = _moved(stored, books, pivots, width)
    shared = spark.sparkContext.broadcast((books, pivots))

    def encode(batches):
        books, pivots = shared.value
        for batch in batches:
            codes, error = np.zeros((batch.num_rows, parts), np.uint8), np.zeros(batch.num_rows, np.int64)
            for part, (_, index, best) in enumerate(_assigned(batch, books, pivots, width)):
                codes[:, part] = index
                error += best
            code = pa.array([row.tobytes() for row in codes], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), code, pa.array(error)], ["id", "label", "code", "error"])
        give_back()

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "vector")
    coded = saved(stored.mapInArrow(encode, f"{kinds}, code binary, error long"), "codes")
    sums = saved(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    sums = F.broadcast(sums) if sums.count() <= SMALL_ROWS else sums
    out = coded.alias("c").join(sums.alias("s"), F.col("c.label").eqNullSafe(F.col("s.label"))).select(
        F.col("c.id").alias(id), F.lower(F.hex("code")).alias("code"), "error", "label_error"
    )
    return out, books


def _moved(stored, books, pivots, width):
    """Codebooks after one round: floors of the means of the stretches assigned to each entry."""
    shared = stored.sparkSession.sparkContext.broadcast((books, pivots))

    def add_up(batches):
        books, pivots = shared.value
        totals = [np.zeros((len(book), width + 1), np.int64) for book in books]
        for batch in batches:
            for total, (own, index, _) in zip(totals, _assigned(batch, books, pivots, width)):
                np.add.at(total[:, :width], index, own)
                total[:, width] += np.bincount(index, minlength=len(total))
        for part, total in enumerate(totals):
            used = np.flatnonzero(total[:, width])
            if not len(used):
                continue
            # One row per entry and component; component ``width`` is the count.
            place = np.tile(np.arange(width + 1), len(used))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(place), part), pa.int32()), pa.array(np.repeat(used, width + 1), pa.int32()),
                 pa.array(place, pa.int32()), pa.array(total[used].reshape(-1))],
                ["part", "entry", "place", "total"],
            )
        give_back()

    sums = stored.select("vector", "far").mapInArrow(add_up, "part int, entry int, place int, total long")
    sums = sums.groupBy("part", "entry", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    moved = [book.copy() for book in books]
    found = {(r.part, r.entry, r.place): int(r.total) for r in sums.collect()}
    for (part, entry, place), total in found.items():
        if place < width:
            moved[part][entry, place] = total // found[part, entry, width]
    return moved


def codebooks_digest(books):
    """SHA-256 of all components in decimals with commas, by part, entry and place."""
    told = ",".join(str(x) for book in books for x in book.reshape(-1).tolist())
    return hashlib.sha256(told.encode()).hexdigest()
