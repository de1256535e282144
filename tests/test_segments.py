import os
import random
import re
import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stowline.functions.codec import encode_headers, encode_record, record_size
from stowline.operators.records import dedupe_records
from stowline.operators import segments
from stowline.operators.segments import (
    assemble_segments,
    assign_segments,
    attach_segments,
    encoded_by_segment,
    out_of_order,
    oversized_records,
    restore_order,
    segment_starts,
    segment_summary,
)
from stowline.plans.archive import archive_records
from stowline.sinks.segments import write_assigned, write_segments
from stowline.sources.segment_reader import read_segments
from stowline.sources.segments import SegmentError, decode_segments, decoded_batches, scan_segments
from stowline.sources.storage import qualify


def hexed(df):
    return [bytes(r[0]).hex().upper() for r in df.select(encode_record()).collect()]


def rows_of(df):
    return sorted(
        (
            r.topic, r.partition, r.offset, r.timestamp,
            r.key and bytes(r.key), r.value and bytes(r.value),
            [(h.key, None if h.value is None else bytes(h.value)) for h in r.headers or []],
        )
        for r in df.collect()
    )


def test_golden_bytes(make_records):
    df = make_records([("t", 0, 5, 17, b"\x01\x02\x03", b"\x04\x05\x06\x07", [])])
    assert hexed(df) == [
        "0000000000000005" "0000000000000011" "00000003" "00000004" "00000000" "010203" "04050607"
    ]
    assert df.select(record_size()).first()[0] == 35
    df = make_records([("t", 0, 5, 17, b"", b"", [])])
    assert hexed(df) == ["0000000000000005" "0000000000000011" + "00000000" * 3]
    df = make_records([("t", 0, 4, 16, None, None, None)])
    assert hexed(df) == ["0000000000000004" "0000000000000010" "FFFFFFFF" "FFFFFFFF" "00000000"]


def test_typed_headers(spark, make_records):
    source = spark.createDataFrame(
        [(bytearray(b"\x01\x01"), True, None, "x", 1.5)],
        "header binary, bool boolean, gone string, s string, d double",
    )
    headers = source.select(encode_headers(source, "header", "bool", "gone", "s", "d").alias("h"))
    got = [(h.key, h.value and bytes(h.value)) for h in headers.first().h]
    assert got == [
        ("header", b"AQE="), ("bool", b"true"), ("gone", None), ("s", b"x"), ("d", b"1.5"),
    ]
    df = make_records(
        [("t", 0, 2, 64, b"\x01\x02\x03", b"\0\0\0", [("header", b"AQE="), ("bool", b"true")])]
    )
    assert hexed(df) == [
        "0000000000000002" "0000000000000040" "00000003" "00000003" "00000002" "010203" "000000"
        "00000006" "686561646572" "00000004" "4151453D" "00000004" "626F6F6C" "00000004" "74727565"
    ]


def test_timestamp_before_the_epoch_and_missing(make_records):
    assert hexed(make_records([("t", 0, 1, -1, None, None, None)]))[0][16:32] == "F" * 16
    with pytest.raises(Exception, match="no timestamp"):
        hexed(make_records([("t", 0, 1, None, None, None, None)]))


def three(make_records):
    return make_records(
        [("t", 0, o, 56 + 4 * o, b"key", b"value", []) for o in (2, 3, 4)]
    )


def test_capacity_limits(make_records):
    one = three(make_records).where("offset = 2")
    segment = assemble_segments(assign_segments(one, cap=40)).first()
    assert segment.byte_length == 40 and bytes(segment.payload)[:4] == b"\0\0\0\0"
    assert oversized_records(one, 36).count() == 1 and oversized_records(one, 40).count() == 0
    with pytest.raises(Exception, match="offset 2 takes 36 bytes"):
        assign_segments(one, cap=36).collect()


def test_third_record_opens_a_segment(make_records):
    segments = segment_summary(assign_segments(three(make_records), cap=76)).orderBy("start_offset")
    got = [(r.start_offset, r.end_offset, r.record_count, r.byte_length) for r in segments.collect()]
    assert got == [(2, 3, 2, 76), (4, 4, 1, 40)]


def random_records(seed, n, topics=3):
    rng = random.Random(seed)
    rows = []
    for topic in range(topics):
        offset = 0
        for _ in range(n if topic == 0 else n // 5):
            offset += rng.choice([1, 1, 1, 2, 50])
            blob = lambda top: rng.choice([None, bytes(rng.randrange(256) for _ in range(rng.randint(0, top)))])
            rows.append(
                (
                    f"t{topic}", 0, offset, rng.randint(-10**12, 10**13), blob(20), blob(90),
                    [("h", blob(9)), ("é", b"")][: rng.randint(0, 2)],
                )
            )
    rng.shuffle(rows)
    return rows


def greedy(rows, cap):
    """The same packing by one walk over the sorted records."""
    found, last = {}, None
    for r in sorted(rows, key=lambda r: r[:3]):
        size = 28 + len(r[4] or b"") + len(r[5] or b"")
        size += sum(8 + len(k.encode()) + len(v or b"") for k, v in r[6])
        if last != r[:2] or fill + size > cap:
            last, fill, start = r[:2], 4, r[2]
        fill += size
        found[(*r[:2], r[2])] = start
    return found


@pytest.mark.parametrize(
    "cap,block_rows,run_blocks",
    [(300, 16, 4), (300, 1, 7), (450, 7, 1), (1000, 64, 256), (100_000, 32, 3), (4000, 1 << 20, 9),
     (2500, 1, 3)],
)
def test_packing_is_greedy_whatever_the_blocks(make_records, cap, block_rows, run_blocks):
    rows = random_records(cap, 400)
    got = {
        (r.topic, r.partition, r.offset): r.segment_start
        for r in assign_segments(
            make_records(rows), cap, block_rows=block_rows, run_blocks=run_blocks
        ).collect()
    }
    assert got == greedy(rows, cap)


def test_sizes_are_shuffled_once(make_records):
    assigned = assign_segments(make_records(random_records(3, 50)), 400, block_rows=16)
    assigned.collect()
    plan = assigned._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert plan.count("summarize(") == 1 and "ReusedExchange" in plan


def test_payload_is_shuffled_once_with_broadcast_starts(spark, make_records):
    df = make_records(random_records(4, 50))
    starts, bucket_rows = segment_starts(df, 400)
    starts = spark.createDataFrame(starts.collect(), starts.schema)
    rows = encoded_by_segment(attach_segments(df, F.broadcast(starts), bucket_rows))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("BroadcastExchange") == 1


def test_equal_sizes_never_settle_but_pack_alike(make_records):
    rows = [("t", 0, o, 0, b"", b"x" * 4, []) for o in range(500)]
    got = assign_segments(make_records(rows), 4 + 7 * 32, block_rows=10, run_blocks=4).collect()
    assert all(r.segment_start == r.offset // 7 * 7 for r in got)


def test_epochs_restart_segments(make_records):
    df = three(make_records).withColumn("epoch", (F.col("offset") > 2).cast("int"))
    assigned = assign_segments(df, epoch_col="epoch")
    got = segment_summary(assigned, epoch_col="epoch").select("start_offset", "end_offset")
    assert sorted(map(tuple, got.collect())) == [(2, 2), (3, 4)]
    packed = assemble_segments(assigned, epoch_col="epoch")
    assert sorted(r.record_count for r in packed.collect()) == [1, 2]


def test_repeated_offset_and_missing_topic_fail(make_records):
    twice = three(make_records).union(three(make_records))
    with pytest.raises(Exception, match="more than once"):
        assign_segments(twice).collect()
    assert assign_segments(dedupe_records(twice)).count() == 3
    with pytest.raises(Exception, match="without topic"):
        assign_segments(three(make_records).withColumn("topic", F.lit(None).cast("string"))).collect()


@pytest.mark.parametrize("width", [1, 3, 1 << 20])
def test_out_of_order(make_records, width):
    offsets = [1, 2, 2, 5, 4, 6, 9]
    df = make_records([("t", 0, o, i, b"", b"", []) for i, o in enumerate(offsets)])
    df = df.withColumn("seen", F.unix_millis("timestamp"))
    got = out_of_order(df, "seen", width=width).select("offset", "previous_offset")
    assert sorted(map(tuple, got.collect())) == [(2, 2), (4, 5)]
    with pytest.raises(Exception, match="not larger"):
        out_of_order(df, "seen", strict=True, width=width).collect()
    assert out_of_order(df.where("offset in (1, 5, 6)"), "seen", strict=True).count() == 3


def test_encode_then_decode(make_records):
    df = make_records(random_records(7, 200))
    packed = assemble_segments(assign_segments(df, 500, block_rows=50))
    assert rows_of(decode_segments(packed)) == rows_of(df)


def test_archive_then_restore(spark, make_records, tmp_path):
    df = make_records(random_records(8, 300))
    path = str(tmp_path / "store")
    for limit in (0, 1 << 20):  # the second run overwrites the first
        archive_records(df, path, "pre/fix", cap=600, block_rows=64, broadcast_bytes=limit)
    assert rows_of(scan_segments(spark, path, "pre/fix")) == rows_of(df)
    names = [f for _, _, files in os.walk(path) for f in files if not f.endswith(".crc")]
    assert names and all(len(n) == 39 for n in names)
    only = scan_segments(spark, path, "pre/fix", topics=["t1"], offsets=(10, 60))
    assert rows_of(only) == rows_of(df.where("topic = 't1' and offset between 10 and 60"))


def test_both_ways_of_writing_agree(spark, make_records, tmp_path):
    df = make_records(random_records(9, 100)).withColumn("epoch", F.col("offset") % 3)
    assigned = assign_segments(df, 600, "epoch")
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    write_segments(assemble_segments(assigned, " a/b ", "epoch"), one)
    write_assigned(assigned, two, " a/b ", "epoch")

    def objects(root):
        found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        return sorted((r.path.split(root)[1], bytes(r.content)) for r in found.collect())

    assert objects(one) == objects(two) != []


def test_overlapping_segments_are_deduped(spark, make_records, tmp_path):
    df = three(make_records)
    archive_records(df, str(tmp_path / "s"))
    archive_records(df.where("offset < 4"), str(tmp_path / "s"))
    assert scan_segments(spark, str(tmp_path / "s")).count() == 5
    assert rows_of(scan_segments(spark, str(tmp_path / "s"), dedupe=True)) == rows_of(df)


def test_broken_segments_fail_or_are_reported(spark, make_records):
    good = assemble_segments(assign_segments(three(make_records)))
    cut = good.withColumn("payload", F.expr("substring(payload, 1, 50)"))
    other = good.withColumn("payload", F.expr("concat(X'00000001', substring(payload, 5))"))
    for bad, message in ((cut, "breaks off"), (other, "unknown segment version")):
        with pytest.raises(Exception, match=message):
            decode_segments(bad).collect()
        reported = decode_segments(bad, on_error="report").where("error is not null").collect()
        assert len(reported) == 1 and message in reported[0].error


def _written(tmp_path, make_records):
    rows = [(t, p, o, o, b"k%d" % o, b"v" * (o % 9), [("h", None), ("i", b"x")][: o % 3]) for t in ("a", "b", "c_d") for p in (0, 1) for o in range(60)]
    df = make_records(rows)
    archive_records(df, str(tmp_path / "s"), "pre/fix", cap=200)
    return df


def _pushed(spark, tmp_path):
    return read_segments(spark, str(tmp_path / "s"), "pre/fix").option("splitBytes", 500).load()


@pytest.mark.parametrize(
    "condition",
    ["offset between 20 and 31", "topic = 'b' and offset > 50", "topic in ('a', 'zz') and partition = 1", "offset = 7", "offset in (3, 59)",
     "20 >= offset and partition < 1", "topic = 'zz'", "offset <=> 5", "offset > 9 and offset < 9", "topic like 'c%'", "offset is null"],
)
def test_pushed_filters_open_only_what_overlaps(spark, make_records, tmp_path, condition):
    df = _written(tmp_path, make_records)
    wanted = rows_of(df.where(condition))
    assert rows_of(_pushed(spark, tmp_path).where(condition)) == wanted
    held = {(r.topic, r.partition, r.offset) for r in df.where(condition).collect()}
    broken = 0
    for folder, _, names in os.walk(tmp_path / "s"):
        for name in names:
            topic, partition = folder.split("/")[-2:]
            first, last = map(int, name.split("-")) if name[0].isdigit() else (0, -1)
            if not any((topic, int(partition), o) in held for o in range(first, last + 1)):
                with open(f"{folder}/{name}", "wb") as file:
                    file.write(b"not a segment")
                broken += 1
    assert broken
    if "like" not in condition and "null" not in condition:  # these reach no key
        assert rows_of(_pushed(spark, tmp_path).where(condition)) == wanted


def test_pushed_partitions_are_balanced(spark, make_records, tmp_path):
    from stowline.sources.segment_reader import SegmentReader

    df = _written(tmp_path, make_records)
    sizes = {str(p): p.stat().st_size for p in (tmp_path / "s").rglob("*-*") if p.is_file()}
    reader = SegmentReader({"path": str(tmp_path / "s"), "prefix": "pre/fix", "splitbytes": "500"})
    dealt = [[sizes[path] for path in task.paths] for task in reader.partitions()]
    assert sum(map(len, dealt)) == len(sizes) and all(sum(d) <= 500 or len(d) == 1 for d in dealt)
    assert _pushed(spark, tmp_path).count() == df.count()
    assert read_segments(spark, str(tmp_path / "s"), "none/here").load().where("topic = 'a'").count() == 0


def _decoded_plainly(payload):
    """Records of a payload read one after the other, and where it breaks off."""
    at, rows = 4, []
    while at < len(payload):
        begin = at
        try:
            offset, millis, key, value, count = struct.unpack_from(">qqiii", payload, at)
            if key < -1 or value < -1 or count < 0:
                return rows, begin
            at += 28 + max(key, 0) + max(value, 0)
            for _ in range(count):
                (n,) = struct.unpack_from(">i", payload, at)
                if n < 0:
                    return rows, begin
                (m,) = struct.unpack_from(">i", payload, at + 4 + n)
                at += 8 + n + max(m, 0)
        except struct.error:
            return rows, begin
        if at > len(payload):
            return rows, begin
        rows.append((offset, key, value, count))
    return rows, None


@pytest.mark.parametrize("seed", range(25))
def test_decode_any_bytes_like_a_plain_walk(seed):
    """Payloads that look like records themselves, zeros, cuts and flipped bytes."""
    rng = random.Random(seed)
    payload = b"\0\0\0\0"
    for n in range(rng.choice([0, 1, 40, 300])):
        key, value = rng.choice([None, b"", b"k" * 5]), rng.choice([None, b"", b"\0" * rng.randint(0, 90), payload[-60:], bytes(rng.randrange(256) for _ in range(20))])
        headers = [(b"h" * rng.randint(0, 4), rng.choice([None, b"", b"\0" * 9])) for _ in range(rng.choice([0, 0, 1, 3]))]
        payload += struct.pack(">qqiii", n, 7, -1 if key is None else len(key), -1 if value is None else len(value), len(headers)) + (key or b"") + (value or b"")
        for name, content in headers:
            payload += struct.pack(">i", len(name)) + name + struct.pack(">i", -1 if content is None else len(content)) + (content or b"")
    damaged = bytearray(payload)
    if seed % 3 == 1:
        del damaged[rng.randint(4, len(damaged)) :]
    elif seed % 3 == 2 and len(damaged) > 5:
        for _ in range(3):
            damaged[rng.randrange(4, len(damaged))] = rng.randrange(256)
    rows, broken = _decoded_plainly(bytes(damaged))
    found, message = [], ""
    try:
        for batch in decoded_batches(("k", "t", 0), bytes(damaged)):
            for r in batch.to_pylist():
                found.append((r["offset"], -1 if r["key"] is None else len(r["key"]), -1 if r["value"] is None else len(r["value"]), len(r["headers"])))
    except SegmentError as error:
        message = str(error)
    except pa.ArrowInvalid:
        return  # a damaged time or header name, refused by either way
    assert found == rows
    assert (f"record at byte {broken}" in message) if broken is not None else not message


def test_relative_paths_on_another_file_system(spark):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    assert qualify(spark, "a/b").startswith("file:/") and qualify(spark, "a/b").endswith("/a/b")
    conf.set("fs.defaultFS", "viewfs://nn")
    conf.set("fs.viewfs.mounttable.nn.link./user", "file:///tmp")
    try:
        assert qualify(spark, "/a/b") == "viewfs://nn/a/b"
        assert re.fullmatch("viewfs://nn/user/[^/]+/a/b", qualify(spark, "a/b"))
    finally:
        conf.set("fs.defaultFS", before)


def test_restore_order(make_records):
    rows = [("t", 0, o, 0, b"", b"", []) for o in (5, 50, 500, 9)]
    packed = segment_summary(assign_segments(make_records(rows), cap=32))
    assert [r.start_offset for r in restore_order(packed).collect()] == [5, 9, 50, 500]


@pytest.mark.parametrize("cap,block_rows,run_blocks", [(400, 1 << 18, 256), (300, 16, 4), (450, 7, 1), (4000, 1, 3), (100_000, 32, 3)])
def test_summary_adds_up_blocks(make_records, cap, block_rows, run_blocks):
    records = make_records(random_records(cap, 300))
    made = segments.summarize_segments(records, cap, "p", block_rows=block_rows, run_blocks=run_blocks)
    wanted = segment_summary(assign_segments(records, cap), "p")
    assert sorted(map(tuple, made.collect())) == sorted(map(tuple, wanted.collect()))
    plan = made._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert "Join" not in plan and plan.count("summarize(") == 1
    below = re.findall(r"Exchange[^\n]*\n[^\n]*", plan)
    assert below and not [e for e in below if re.search(r"[\[,] ?(value|headers)#\d+[,\]]", e)]


def test_summary_refuses_records_without_a_key(make_records):
    rows = [("t", 0, 1, 1, b"", b"", []), (None, 0, 2, 2, b"", b"", [])]
    with pytest.raises(Exception, match="record without topic"):
        segments.summarize_segments(make_records(rows)).collect()
    with pytest.raises(Exception, match="more than once"):
        segments.summarize_segments(make_records(rows[:1] * 2)).collect()


@pytest.mark.parametrize("seed", range(20))
def test_step_functions_as_pieces(seed):
    rng = np.random.default_rng(seed)
    parts = [np.cumsum(rng.integers(1, 4, (3, rng.integers(1, 6))), axis=1) if rng.random() < 0.5 else np.outer([3, 61, 1], np.arange(rng.integers(1, 50))) for _ in range(seed % 5 + 1)]
    whole = np.concatenate(parts, axis=1)
    pieces = segments._packed_steps(*whole)
    assert (np.stack(segments._unpacked_steps(pieces)) == whole).all()
    assert len(segments._packed_steps(*np.outer([3, 61, 1], np.arange(5000)))) == 14


def test_runs_of_equal_records_stay_small():
    """256 blocks of 61-byte records, composed as one run, against their plain packing."""
    import tracemalloc

    cap, rows, blocks, keys = 5 << 20, 1 << 16, 256, ["topic", "partition"]
    summarize = segments._summarizer(keys, cap)
    made = [
        summarize(pa.table({"topic": ["t"] * rows, "partition": [0] * rows, "_block": [b] * rows, "offset": np.arange(rows) + b * rows, "_size": np.full(rows, 61)}))
        for b in range(3)
    ]
    table = pa.concat_tables(made)
    # further blocks are the third one, moved on: only the starts differ
    for b in range(3, blocks):
        pieces = np.array(made[2].column("_pieces")[0].as_py()).reshape(-1, 7)
        pieces[:, 4] += (b - 2) * rows
        moved = made[2].set_column(2, "_block", [[b]]).set_column(4, "_pieces", pa.array([pieces.reshape(-1)], pa.list_(pa.int64())))
        table = pa.concat_tables([table, moved])
    table = table.append_column("_run", pa.array([0] * blocks))
    tracemalloc.start()
    whole = segments._composer(keys, cap)(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert table.nbytes + peak < 64e6
    per_segment = (cap - 4) // 61
    (_, total, limit, fill, start), = segments._steps(whole.rename_columns(keys + ["_block", "_bytes", "_pieces"]))
    assert total == 61 * rows * blocks
    for before in (cap, 4, 4 + 61 * 1000, cap - 61):
        at = min(int(np.searchsorted(limit, cap - before, side="right")), len(limit) - 1)
        first = (cap - before) // 61  # records that still fit the segment before
        last = first + (rows * blocks - first - 1) // per_segment * per_segment
        assert (start[at], fill[at]) == (last, 4 + 61 * (rows * blocks - last))
