"""Reading archived segments back to records."""

import logging

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stowline.functions.codec import (
    HEADER_OVERHEAD,
    HEADERS_TYPE,
    RECORD_OVERHEAD,
    SEGMENT_OVERHEAD,
    SEGMENT_VERSION,
)
from stowline.functions.keys import parse_object_key
from stowline.operators.records import RECORD_COLUMNS, dedupe_records
from stowline.sources.listing import list_files
from stowline.sources.storage import join_path, locate

log = logging.getLogger(__name__)

_ROWS_PER_BATCH = 10_000
_BYTES_PER_BATCH = 32 << 20
# tasks per core that objects are dealt out to; a task holds one object at a time
OBJECT_TASKS = 4
# stretches longer than this on average are copied one by one, shorter ones by an index per byte
_LONG_PIECE = 64
_DECODED = (
    "object_key string, topic string, partition int, offset long, timestamp timestamp, "
    f"key binary, value binary, headers {HEADERS_TYPE}, error string"
)
_ARROW = pa.schema(
    [
        ("object_key", pa.string()),
        ("topic", pa.string()),
        ("partition", pa.int32()),
        ("offset", pa.int64()),
        ("timestamp", pa.timestamp("us", "UTC")),
        ("key", pa.binary()),
        ("value", pa.binary()),
        ("headers", pa.list_(pa.struct([("key", pa.string()), ("value", pa.binary())]))),
        ("error", pa.string()),
    ]
)


class SegmentError(ValueError):
    """Bytes that are not a whole segment of a known version."""


def _possible(raw: np.ndarray) -> np.ndarray:
    """Bytes where the lengths of a record could stand, by the high bytes of its three counts."""
    size, first, behind = len(raw), SEGMENT_OVERHEAD, len(raw) - RECORD_OVERHEAD + 1
    if behind <= first:
        return np.zeros(0, np.int64)
    key, value, count = (raw[first + at : behind + at] for at in (16, 20, 24))
    high = size >> 24
    fits = ((key <= high) | (key == 255)) & ((value <= high) | (value == 255)) & (count <= high)
    return np.flatnonzero(fits) + first


def _records(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, int | None]:
    """Places of the records and of their headers, and of a record that breaks off.

    A record's end follows from its lengths. So every byte at which a whole record could
    begin points to the byte behind it, and the records are what the segment's first byte
    reaches. Jumps are doubled: after n rounds the first 2^n records are known.
    """
    size = len(raw)
    places = _possible(raw)
    key, value, count = (_numbers(raw, places + at, ">i4") for at in (16, 20, 24))
    ends = places + RECORD_OVERHEAD + np.maximum(key, 0) + np.maximum(value, 0)
    whole = (key >= -1) & (value >= -1) & (count >= 0) & (ends + HEADER_OVERHEAD * count <= size)
    places, ends, count = places[whole], ends[whole], count[whole]

    # headers of one rank at a time, over all places that have so many
    left = np.flatnonzero(count)
    owners, headers, rank = [], [], 0
    while len(left):
        at = ends[left]
        name = _numbers(raw, at, ">i4")
        content = at + 4 + np.where((name < 0) | (name > size), size, name)
        good = content + 4 <= size
        left, at, content = left[good], at[good], content[good]
        behind = content + 4 + np.maximum(_numbers(raw, content, ">i4"), 0)
        owners.append(left)
        headers.append(at)
        ends[left] = behind
        rank += 1
        # 4 bytes for each length of the headers still to come
        left = left[(count[left] > rank) & (behind + HEADER_OVERHEAD * (count[left] - rank) <= size)]
    if owners:
        done = np.bincount(np.concatenate(owners), minlength=len(places))
        whole = (done == count) & (ends <= size)
    else:
        whole = ends <= size

    number = np.cumsum(whole) - 1
    kept, behind = places[whole], ends[whole]
    follow = np.searchsorted(kept, behind)
    stop = len(kept)
    follow[(follow < stop) & (kept[np.minimum(follow, stop - 1)] != behind)] = stop
    jump = np.append(follow, stop)
    reached = np.zeros(stop + 1, bool)
    reached[0 if stop and kept[0] == SEGMENT_OVERHEAD else stop] = True
    while not reached[stop]:
        reached[jump[reached]] = True
        jump = jump[jump]
    chosen = reached[:stop]
    edge = int(behind[chosen][-1]) if chosen.any() else SEGMENT_OVERHEAD
    heads = np.zeros(0, np.int64)
    if owners:
        owner, head = np.concatenate(owners), np.concatenate(headers)
        mine = whole[owner]
        mine[mine] = chosen[number[owner[mine]]]
        heads = np.sort(head[mine])
    return kept[chosen], heads, edge if edge < size else None


def _numbers(raw: np.ndarray, places: np.ndarray, kind: str) -> np.ndarray:
    """Big-endian numbers that begin at the given bytes."""
    if not len(places):
        return np.zeros(0, np.int64)
    everywhere = np.ndarray(len(raw) - np.dtype(kind).itemsize + 1, kind, raw, strides=(1,))
    return everywhere[places].astype(np.int64)


def _pieces(raw: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Stretches of bytes as a column; a negative length is null."""
    held = np.maximum(lengths, 0)
    bounds = np.concatenate(([0], np.cumsum(held)))
    if bounds[-1] > _LONG_PIECE * len(held):
        view = memoryview(raw)
        data = b"".join([view[a : a + n] for a, n in zip(begins.tolist(), held.tolist())])
    else:
        data = raw[np.repeat(begins - bounds[:-1], held) + np.arange(bounds[-1])]
    valid = pa.py_buffer(np.packbits(lengths >= 0, bitorder="little"))
    return pa.Array.from_buffers(
        pa.binary(), len(held), [valid, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)]
    )


def _batch(segment: tuple, raw: np.ndarray, records: np.ndarray, headers: np.ndarray) -> pa.RecordBatch:
    """Records at the given places of one segment, and all of their headers."""
    key, value, count = (_numbers(raw, records + at, ">i4") for at in (16, 20, 24))
    name = _numbers(raw, headers, ">i4")
    content = _numbers(raw, headers + 4 + name, ">i4")
    of_headers = pa.ListArray.from_arrays(
        pa.array(np.concatenate(([0], np.cumsum(count))), pa.int32()),
        pa.StructArray.from_arrays(
            [_pieces(raw, headers + 4, name).cast(pa.string()), _pieces(raw, headers + 8 + name, content)],
            fields=list(_ARROW.field("headers").type.value_type),
        ),
    )
    micros = pc.multiply_checked(pa.array(_numbers(raw, records + 8, ">i8")), 1000)
    return pa.RecordBatch.from_arrays(
        [
            *(pa.repeat(pa.scalar(part, kind), len(records)) for part, kind in zip(segment, _ARROW.types)),
            pa.array(_numbers(raw, records, ">i8")),
            micros.cast(pa.timestamp("us", "UTC")),
            _pieces(raw, records + RECORD_OVERHEAD, key),
            _pieces(raw, records + RECORD_OVERHEAD + np.maximum(key, 0), value),
            of_headers,
            pa.nulls(len(records), pa.string()),
        ],
        schema=_ARROW,
    )


def _failed(segment: tuple, message: str) -> pa.RecordBatch:
    row = [*segment, *[None] * 5, message]
    return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _ARROW)], schema=_ARROW)


def decoded_batches(segment: tuple, payload):
    """Record batches of one segment; raises ``SegmentError`` behind the last whole record."""
    size = len(payload)
    raw = np.frombuffer(payload, np.uint8)
    version = bytes(raw[:SEGMENT_OVERHEAD])
    if version != SEGMENT_VERSION.to_bytes(SEGMENT_OVERHEAD, "big"):
        raise SegmentError(f"unknown segment version {version.hex()}")
    records, headers, broken = _records(raw)
    first = 0
    while first < len(records):
        last = min(first + _ROWS_PER_BATCH, len(records))
        last = max(first + 1, min(last, int(np.searchsorted(records, records[first] + _BYTES_PER_BATCH))))
        edges = records[first], records[last] if last < len(records) else size
        inside = slice(*np.searchsorted(headers, edges))
        yield _batch(segment, raw, records[first:last], headers[inside])
        first = last
    if broken is not None:
        raise SegmentError(f"segment of {size} bytes breaks off in the record at byte {broken}")


def joined_batches(batches):
    """The same rows in fewer batches, where segments are small."""
    held, rows, filled = [], 0, 0
    for batch in batches:
        if held and (rows + batch.num_rows > _ROWS_PER_BATCH or filled + batch.nbytes > _BYTES_PER_BATCH):
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, rows, filled = [], 0, 0
        held.append(batch)
        rows, filled = rows + batch.num_rows, filled + batch.nbytes
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _decoder(read_payload, on_error: str):
    def segments(batches):
        for part in batches:
            for i in range(part.num_rows):
                segment = tuple(
                    part.column(c)[i].as_py() for c in ("object_key", "topic", "partition")
                )
                try:
                    yield from decoded_batches(segment, read_payload(part, i))
                except (SegmentError, OSError) as error:
                    if on_error == "fail":
                        raise SegmentError(f"{segment[0]}: {error}") from error
                    log.warning("segment %s: %s", segment[0], error)
                    yield _failed(segment, str(error))

    return lambda batches: joined_batches(segments(batches))


def read_object(uri: str) -> bytes:
    system, name = locate(uri)
    with system.open_input_stream(name) as stream:
        return stream.read()


def _check(on_error: str) -> None:
    if on_error not in ("fail", "report"):
        raise ValueError("on_error must be 'fail' or 'report'")


def decode_segments(segments: DataFrame, on_error: str = "fail") -> DataFrame:
    """Records of segments that carry their ``payload``.

    A segment of unknown version or with a short tail fails the query, or with
    ``on_error="report"`` gives a row with its ``object_key`` and ``error``.
    """
    _check(on_error)

    def payload(batch, i):
        return batch.column("payload")[i].as_buffer()

    decoded = segments.select("object_key", "topic", "partition", "payload").mapInArrow(
        _decoder(payload, on_error), _DECODED
    )
    return decoded.select(*RECORD_COLUMNS, *(["object_key", "error"] if on_error == "report" else []))


def scan_segments(
    spark: SparkSession,
    path: str,
    prefix: str = "",
    topics: list[str] | None = None,
    offsets: tuple[int, int] | None = None,
    dedupe: bool = False,
    on_error: str = "fail",
) -> DataFrame:
    """Records archived under ``path``, optionally of some topics and an offset range.

    ``offsets`` is a closed range. Only folders of the wanted topics are listed, by tasks, and
    only objects whose key overlaps the range are opened, dealt out evenly to all tasks. Files whose name is no
    object key are ignored. ``dedupe`` drops records delivered twice.
    """
    _check(on_error)
    root = join_path(path, prefix.strip("/")) if prefix.strip("/") else path
    folders = [join_path(root, t) for t in topics] if topics else root
    found = list_files(spark, folders, recursive=True, levels=1 if topics else 2)
    wanted = (
        found.select("path", parse_object_key("path").alias("k"))
        .select(F.col("path").alias("object_key"), "k.*")
        .where(F.col("start_offset").isNotNull() & F.col("end_offset").isNotNull())
    )
    if offsets:
        wanted = wanted.where(
            (F.col("end_offset") >= offsets[0]) & (F.col("start_offset") <= offsets[1])
        )

    def payload(batch, i):
        return read_object(batch.column("object_key")[i].as_py())

    tasks = OBJECT_TASKS * spark.sparkContext.defaultParallelism
    chosen = wanted.select("object_key", "topic", "partition").repartition(tasks, "object_key")
    records = chosen.mapInArrow(
        _decoder(payload, on_error), _DECODED
    )
    if offsets:
        inside = F.col("offset").between(*offsets)
        records = records.where(inside | F.col("error").isNotNull())
    records = records.select(
        *RECORD_COLUMNS, *(["object_key", "error"] if on_error == "report" else [])
    )
    return dedupe_records(records) if dedupe else records
