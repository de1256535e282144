"""Packing of records into size-capped segments, exact also inside one huge group.

Packing is greedy in offset order: a segment takes records until the next one
would push it over the cap, and everything restarts at each epoch (flush). That
is a chain through the whole group, but only through record sizes. So:

1. Sizes (no payload) are grouped into blocks of ``block_rows`` offsets. A block's
   effect depends on nothing but how full the segment entering it is, and that
   effect is a step function of the fill. Each block is reduced to it, in parallel.
2. Step functions of a run of blocks compose into one of the same kind. The few of a
   group are applied in order, which gives the state entering each run, and from
   there, run by run in parallel, the state entering each block.
3. Each block is then cut on its own, in parallel, and its cuts are joined to the
   records; a summary of the segments adds up what each block gives to them instead.
"""

from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stowline.functions.codec import (
    SEGMENT_CAPACITY,
    SEGMENT_OVERHEAD,
    SEGMENT_VERSION,
    encode_record,
    record_size,
)
from stowline.functions.keys import object_key
from stowline.operators.running import BLOCK_WIDTH, previous_value

BLOCK_ROWS = 1 << 18
RUN_BLOCKS = 256


def group_keys(epoch_col: str | None) -> list[str]:
    return ["topic", "partition"] + ([epoch_col] if epoch_col else [])


def oversized_records(records: DataFrame, cap: int = SEGMENT_CAPACITY) -> DataFrame:
    """Records that do not fit an empty segment, with their ``size``."""
    return records.withColumn("size", record_size()).where(
        F.col("size") + SEGMENT_OVERHEAD > cap
    )


def out_of_order(
    records: DataFrame,
    order_col: str,
    epoch_col: str | None = None,
    strict: bool = False,
    width: int = BLOCK_WIDTH,
) -> DataFrame:
    """Records whose offset does not exceed that of the record arriving before them.

    ``order_col`` is the arrival order, a whole number unique in its group. The
    check restarts at every epoch. With ``strict`` all records come back and the
    first offender fails the query.
    """
    checked = previous_value(
        records, group_keys(epoch_col), order_col, "offset", "previous_offset", width
    )
    wrong = F.col("previous_offset") >= F.col("offset")
    if not strict:
        return checked.where(wrong)
    message = F.format_string(
        "record offset %d of %s/%d is not larger than %d",
        "offset", "topic", "partition", "previous_offset",
    )
    return checked.withColumn(
        "offset", F.when(wrong, F.raise_error(message).cast("long")).otherwise(F.col("offset"))
    ).drop("previous_offset")


REFUSED = "record without topic, partition, offset or epoch"


def _sizes(
    records: DataFrame, keys: list[str], cap: int, block_rows: int, refuse: bool = False
) -> DataFrame:
    """Key columns, block, offset and size; an oversized record fails here.

    Records that lack a key are left out, or with ``refuse`` fail too.
    """
    too_large = F.format_string(
        f"record %s/%d offset %d takes %d bytes, more than a segment of {cap} can hold",
        "topic", "partition", "offset", "_size",
    )
    size = record_size()
    if refuse:
        missing = reduce(or_, (F.col(c).isNull() for c in (*keys, "offset")))
        size = F.when(missing, F.raise_error(F.lit(REFUSED)).cast("long")).otherwise(size)
    # else they are left to attach_segments, which refuses them
    complete = records.select(*keys, "offset", size.alias("_size"))
    if not refuse:
        complete = complete.dropna(subset=keys + ["offset"])
    return complete.select(
        *keys,
        F.expr(f"offset div {block_rows}").alias("_block"),
        "offset",
        F.when(
            F.col("_size") + SEGMENT_OVERHEAD > cap, F.raise_error(too_large).cast("long")
        ).otherwise(F.col("_size")).alias("_size"),
    )


def _block_arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and running sizes of a block, in offset order."""
    offsets = table.column("offset").to_numpy()
    sizes = table.column("_size").to_numpy()
    order = np.argsort(offsets, kind="stable")
    offsets, sizes = offsets[order], sizes[order]
    repeated = np.flatnonzero(offsets[1:] == offsets[:-1])
    if len(repeated):
        raise ValueError(
            f"offset {offsets[repeated[0]]} occurs more than once in "
            f"{table.column('topic')[0]}/{table.column('partition')[0]}"
        )
    return offsets, np.cumsum(sizes)


def _next_starts(ends: np.ndarray, cap: int) -> np.ndarray:
    """For a segment starting at each record, the index of the record starting the next."""
    starts = np.concatenate(([0], ends[:-1]))
    return np.searchsorted(ends, starts + (cap - SEGMENT_OVERHEAD), side="right")


def _key_columns(table: pa.Table, keys: list[str], n: int) -> list[pa.Array]:
    return [pa.repeat(table.column(k)[0], n) for k in keys]


def _packed_steps(limit, fill, start) -> np.ndarray:
    """A step function as pieces (limit, its step, fill, its step, start, its step, count).

    Where all records have one size the three advance evenly, so thousands of steps are two
    pieces; where sizes vary there are few steps.
    """
    values = np.stack([limit, fill, start])
    steps = np.diff(values, axis=1)
    heads = np.flatnonzero(np.append(True, (steps[:, 1:] != steps[:, :-1]).any(axis=0))) if steps.shape[1] else []
    # the first entry alone, then each stretch of equal steps
    heads = np.concatenate(([0], np.asarray(heads, np.int64) + 1))
    counts = np.diff(np.append(heads, values.shape[1]))
    pieces = np.zeros((len(heads), 7), np.int64)
    pieces[:, 0:6:2] = values[:, heads].T
    pieces[1:, 1:6:2] = steps[:, heads[1:] - 1].T
    pieces[:, 6] = counts
    return pieces.reshape(-1)


def _unpacked_steps(pieces: np.ndarray):
    """(limit, fill, start) of ``_packed_steps``."""
    pieces = pieces.reshape(-1, 7)
    counts = pieces[:, 6]
    piece = np.repeat(np.arange(len(pieces)), counts)
    place = np.arange(len(piece)) - np.repeat(np.cumsum(counts) - counts, counts)
    return tuple(pieces[piece, c] + place * pieces[piece, c + 1] for c in (0, 2, 4))


def _summarizer(keys: list[str], cap: int):
    def summarize(table: pa.Table) -> pa.Table:
        offsets, ends = _block_arrays(table)
        n = len(offsets)
        following = _next_starts(ends, cap)
        # last segment start of the block, when a segment starts at each record
        last = np.where(following < n, following, np.arange(n))
        while True:
            further = last[last]
            if np.array_equal(further, last):
                break
            last = further
        # only records within a cap of the block's start can be its first start
        room = cap - SEGMENT_OVERHEAD
        begins = np.concatenate(([0], ends[:-1]))
        m = int(np.searchsorted(begins, room, side="right"))
        step = np.append(np.flatnonzero(last[: m - 1] != last[1:m]), m - 1)
        final = last[step]
        return pa.table(
            _key_columns(table, keys + ["_block"], 1)
            + [
                pa.array([int(ends[-1])], pa.int64()),
                pa.array(
                    [_packed_steps(ends[step], SEGMENT_OVERHEAD + ends[-1] - begins[final], offsets[final])],
                    pa.list_(pa.int64()),
                ),
            ],
            names=keys + ["_block", "_bytes", "_pieces"],
        )

    return summarize


def _leave(fill, start, total, limit, fills, starts, cap):
    """Fills and segment starts behind a block, for arrays of those before it."""
    at = np.minimum(np.searchsorted(limit, cap - fill, side="right"), len(limit) - 1)
    inside = fill + total <= cap
    return np.where(inside, fill + total, fills[at]), np.where(inside, start, starts[at])


def _steps(table: pa.Table):
    """(block, bytes, limit, fill, start) of each summary, in block order, one at a time."""
    blocks, totals = (table.column(c).to_numpy() for c in ("_block", "_bytes"))
    pieces = table.column("_pieces").combine_chunks()
    for i in np.argsort(blocks):
        yield int(blocks[i]), int(totals[i]), *_unpacked_steps(pieces[i].values.to_numpy())


def _composer(keys: list[str], cap: int):
    def compose(table: pa.Table) -> pa.Table:
        """One summary for a run of blocks, as if they were one block."""
        steps = _steps(table)
        _, size, limit, fill, start = next(steps)
        for _, total, next_limit, next_fill, next_start in steps:
            fill, start = _leave(fill, start, total, next_limit, next_fill, next_start, cap)
            if size <= cap - SEGMENT_OVERHEAD:
                # the segment open at the beginning may reach into this block
                limit = np.concatenate((limit, next_limit + size))
                fill = np.concatenate((fill, next_fill))
                start = np.concatenate((start, next_start))
            size += total
            kept = np.append(np.flatnonzero(start[:-1] != start[1:]), len(start) - 1)
            limit, fill, start = limit[kept], fill[kept], start[kept]
        return pa.table(
            _key_columns(table, keys + ["_run"], 1)
            + [pa.array([size], pa.int64()), pa.array([_packed_steps(limit, fill, start)], pa.list_(pa.int64()))],
            names=keys + ["_block", "_bytes", "_pieces"],
        )

    return compose


def _walk(steps, fill: int, start: int | None, cap: int):
    """Block, and fill and open segment entering it, for each block, from those entering the first."""
    entries = []
    for block, total, limit, fills, starts in steps:
        entries.append((block, fill, start))
        if fill + total <= cap:
            fill += total
        else:
            at = int(np.searchsorted(limit, cap - fill, side="right"))
            fill, start = int(fills[at]), int(starts[at])
    return entries


def _entry_table(table: pa.Table, keys: list[str], entries) -> pa.Table:
    return pa.table(
        _key_columns(table, keys, len(entries)) + [pa.array(c, pa.int64()) for c in zip(*entries)],
        names=keys + ["_block", "_fill", "_start"],
    )


def _run_walker(keys: list[str], cap: int):
    def walk(runs: pa.Table) -> pa.Table:
        # nothing open: a full segment makes the first record start one
        return _entry_table(runs, keys, _walk(_steps(runs), cap, None, cap))

    return walk


def _block_walker(keys: list[str], cap: int):
    def walk(blocks: pa.Table, entry: pa.Table) -> pa.Table:
        fill, start = (entry.column(c)[0].as_py() for c in ("_fill", "_start"))
        return _entry_table(blocks, keys, _walk(_steps(blocks), fill, start, cap))

    return walk


def _cuts(ends: np.ndarray, fill: int, cap: int) -> list[int]:
    """Indexes of the records of a block that start a segment."""
    following = _next_starts(ends, cap)
    at = int(np.searchsorted(ends, cap - fill, side="right"))
    cuts = []
    while at < len(ends):
        cuts.append(at)
        at = int(following[at])
    return cuts


def _piece_maker(keys: list[str], cap: int):
    def cut(sizes: pa.Table, entry: pa.Table) -> pa.Table:
        """What a block adds to each segment it touches; the first may have begun before it."""
        offsets, ends = _block_arrays(sizes)
        cuts = _cuts(ends, entry.column("_fill")[0].as_py(), cap)
        edges = np.array(cuts if cuts[:1] == [0] else [0, *cuts], np.int64)
        starts = [int(offsets[at]) for at in edges]
        if cuts[:1] != [0]:
            starts[0] = entry.column("_start")[0].as_py()
        last = np.append(edges[1:], len(offsets)) - 1
        before = np.concatenate(([0], ends))[edges]
        return pa.table(
            _key_columns(sizes, keys, len(edges))
            + [pa.array(c, pa.int64()) for c in (starts, offsets[last], last - edges + 1, ends[last] - before)],
            names=keys + ["segment_start", "_end", "_count", "_size"],
        )

    return cut


def _cutter(keys: list[str], cap: int, bucket_rows: int):
    def cut(sizes: pa.Table, entry: pa.Table) -> pa.Table:
        offsets, ends = _block_arrays(sizes)
        cuts = _cuts(ends, entry.column("_fill")[0].as_py(), cap)
        starts = offsets[cuts] if cuts else offsets[:0]
        buckets = np.unique(offsets // bucket_rows)
        edges = np.searchsorted(starts, np.append(buckets * bucket_rows, offsets[-1] + 1))
        carried = entry.column("_start")[0].as_py()
        open_at = [int(starts[e - 1]) if e else carried for e in edges[:-1]]
        return pa.table(
            _key_columns(sizes, keys, len(buckets))
            + [
                pa.array(buckets, pa.int64()),
                pa.array(open_at, pa.int64()),
                pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(starts, pa.int64())),
            ],
            names=keys + ["_bucket", "_open", "_starts"],
        )

    return cut


def _entered_blocks(
    records: DataFrame, cap: int, epoch_col: str | None, block_rows: int, run_blocks: int, refuse: bool = False
):
    """Sizes by block, cogrouped with the fill and open segment that enter it."""
    keys = group_keys(epoch_col)
    sizes = _sizes(records, keys, cap, block_rows, refuse)
    block = [records.schema[k] for k in keys] + [T.StructField("_block", T.LongType())]
    summary_type = T.StructType(
        block + [T.StructField("_bytes", T.LongType()), T.StructField("_pieces", T.ArrayType(T.LongType()))]
    )
    entry_type = T.StructType(
        block + [T.StructField(c, T.LongType()) for c in ("_fill", "_start")]
    )
    summaries = (
        sizes.groupBy(*keys, "_block")
        .applyInArrow(_summarizer(keys, cap), summary_type)
        .withColumn("_run", F.expr(f"_block div {run_blocks}"))
        .groupBy(*keys, "_run")
    )
    runs = summaries.applyInArrow(_composer(keys, cap), summary_type)
    run_entries = runs.groupBy(*keys).applyInArrow(_run_walker(keys, cap), entry_type)
    entries = summaries.cogroup(
        run_entries.withColumnRenamed("_block", "_run").groupBy(*keys, "_run")
    ).applyInArrow(_block_walker(keys, cap), entry_type)
    return sizes.groupBy(*keys, "_block").cogroup(entries.groupBy(*keys, "_block"))


def segment_starts(
    records: DataFrame,
    cap: int = SEGMENT_CAPACITY,
    epoch_col: str | None = None,
    block_rows: int = BLOCK_ROWS,
    run_blocks: int = RUN_BLOCKS,
) -> tuple[DataFrame, int]:
    """Where segments start: one row per bucket of offsets, and the bucket width.

    ``_open`` is the segment open at the bucket's start, ``_starts`` those starting in it.
    """
    keys = group_keys(epoch_col)
    # a bucket spans few segments whatever the record size, so looking a record
    # up among its bucket's starts costs a fixed time per byte
    bucket_rows = min(max(cap // 64, 256), 1 << 16, block_rows)
    block_rows -= block_rows % bucket_rows
    found = [T.StructField("_bucket", T.LongType()), T.StructField("_open", T.LongType())]
    found.append(T.StructField("_starts", T.ArrayType(T.LongType())))
    starts = _entered_blocks(records, cap, epoch_col, block_rows, run_blocks).applyInArrow(
        _cutter(keys, cap, bucket_rows), T.StructType([records.schema[k] for k in keys] + found)
    )
    return starts, bucket_rows


def attach_segments(
    records: DataFrame, starts: DataFrame, bucket_rows: int, epoch_col: str | None = None
) -> DataFrame:
    """Records with ``segment_start`` looked up in a table made by ``segment_starts``."""
    keys = group_keys(epoch_col)
    refused = F.raise_error(F.lit(REFUSED))
    found = F.array_max(F.filter("_starts", lambda s: s <= F.col("offset")))
    return (
        records.withColumn("_bucket", F.expr(f"offset div {bucket_rows}"))
        .join(starts, keys + ["_bucket"], "left")
        .select(
            *records.columns,
            F.coalesce(found, "_open", refused.cast("long")).alias("segment_start"),
        )
    )


def assign_segments(
    records: DataFrame,
    cap: int = SEGMENT_CAPACITY,
    epoch_col: str | None = None,
    block_rows: int = BLOCK_ROWS,
    run_blocks: int = RUN_BLOCKS,
) -> DataFrame:
    """Records with ``segment_start``, the offset of the first record of their segment.

    Offsets must be unique within topic, partition and epoch; a repeated or
    oversized record fails the query before anything is written.
    """
    starts, bucket_rows = segment_starts(records, cap, epoch_col, block_rows, run_blocks)
    return attach_segments(records, starts, bucket_rows, epoch_col)


def summarize_segments(
    records: DataFrame,
    cap: int = SEGMENT_CAPACITY,
    prefix: str = "",
    epoch_col: str | None = None,
    block_rows: int = BLOCK_ROWS,
    run_blocks: int = RUN_BLOCKS,
) -> DataFrame:
    """``segment_summary`` of records not packed yet.

    Sizes are all that is taken of the records. Each block tells what it adds to the segments
    it touches, and the parts of a segment add up: records are not joined to their segments.
    """
    keys = group_keys(epoch_col)
    parts = [T.StructField(c, T.LongType()) for c in ("segment_start", "_end", "_count", "_size")]
    pieces = _entered_blocks(records, cap, epoch_col, block_rows, run_blocks, refuse=True).applyInArrow(
        _piece_maker(keys, cap), T.StructType([records.schema[k] for k in keys] + parts)
    )
    return _summary(pieces, keys, prefix, F.max("_end"), F.sum("_count"), F.sum("_size"))


def segment_summary(
    assigned: DataFrame, prefix: str = "", epoch_col: str | None = None, size: Column | None = None
) -> DataFrame:
    """One row per segment: key, first and last offset, records and bytes; no payload.

    ``size`` is the size of a record, by default taken from its columns.
    """
    size = record_size() if size is None else size
    return _summary(assigned, group_keys(epoch_col), prefix, F.max("offset"), F.count("*"), F.sum(size))


def _summary(rows: DataFrame, keys: list[str], prefix: str, end: Column, count: Column, size: Column) -> DataFrame:
    return (
        rows.groupBy(*keys, "segment_start")
        .agg(
            end.alias("end_offset"),
            count.alias("record_count"),
            (size + SEGMENT_OVERHEAD).alias("byte_length"),
        )
        .select(
            object_key(
                F.lit(prefix), F.col("topic"), F.col("partition"),
                F.col("segment_start"), F.col("end_offset"),
            ).alias("object_key"),
            *keys,
            F.col("segment_start").alias("start_offset"),
            "end_offset",
            "record_count",
            "byte_length",
        )
    )


def assembler(keys: list[str]):
    """Arrow function from the rows of ``encoded_by_segment`` to segments with payload."""
    version = SEGMENT_VERSION.to_bytes(SEGMENT_OVERHEAD, "big")
    batch_bytes = 4 << 20

    def table(rows, key_types):
        columns = list(zip(*rows))
        types = key_types + [pa.int64()] * 4 + [pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)],
            names=keys
            + ["start_offset", "end_offset", "record_count", "byte_length", "payload"],
        )

    def assemble(batches):
        key_types = []
        done, size = [], 0
        group, parts, count, end = None, [], 0, None

        def close():
            payload = b"".join([version, *parts])
            done.append((*group, end, count, len(payload), payload))
            return len(payload)

        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            key_types = [batch.schema.field(k).type for k in keys]
            starts = batch.column("segment_start").to_numpy()
            changed = starts[1:] != starts[:-1]
            for k in keys:
                codes = batch.column(k).dictionary_encode().indices.to_numpy()
                changed |= codes[1:] != codes[:-1]
            edges = [0, *(np.flatnonzero(changed) + 1).tolist(), n]
            offsets = batch.column("offset").to_numpy()
            # encoded records of a run lie next to each other in the batch
            records = batch.column("_record").cast(pa.large_binary())
            places = np.frombuffer(records.buffers()[1], np.int64)[
                records.offset : records.offset + n + 1
            ]
            data = memoryview(records.buffers()[2])
            for lo, hi in zip(edges, edges[1:]):
                key = tuple(batch.column(k)[lo].as_py() for k in keys) + (int(starts[lo]),)
                if key != group:
                    if group is not None:
                        size += close()
                        if size >= batch_bytes:
                            yield table(done, key_types)
                            done, size = [], 0
                    group, parts, count = key, [], 0
                parts.append(bytes(data[places[lo] : places[hi]]))
                count += hi - lo
                end = int(offsets[hi - 1])
        if group is not None:
            close()
            yield table(done, key_types)

    return assemble


def encoded_by_segment(assigned: DataFrame, epoch_col: str | None = None) -> DataFrame:
    """Encoded records, each segment whole in one partition and in offset order."""
    keys = group_keys(epoch_col) + ["segment_start"]
    return (
        assigned.select(*keys, "offset", encode_record().alias("_record"))
        .repartition(*keys)
        .sortWithinPartitions(*keys, "offset")
    )


def assemble_segments(
    assigned: DataFrame, prefix: str = "", epoch_col: str | None = None
) -> DataFrame:
    """Segments with their bytes: the version, then the records in offset order."""
    keys = group_keys(epoch_col)
    fields = [assigned.schema[k] for k in keys]
    for name in ("start_offset", "end_offset", "record_count", "byte_length"):
        fields.append(T.StructField(name, T.LongType()))
    fields.append(T.StructField("payload", T.BinaryType()))
    packed = encoded_by_segment(assigned, epoch_col).mapInArrow(
        assembler(keys), T.StructType(fields)
    )
    return packed.select(
        object_key(
            F.lit(prefix), F.col("topic"), F.col("partition"),
            F.col("start_offset"), F.col("end_offset"),
        ).alias("object_key"),
        "*",
    )


def restore_order(segments: DataFrame) -> DataFrame:
    """Segments in offset order per topic-partition: the order of their keys as text."""
    return segments.orderBy("topic", "partition", "object_key")
