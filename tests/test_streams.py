import datetime as dt

import pytest
from pyspark.sql import functions as F

from stowline.functions.latency import latency_ms
from stowline.operators.records import events_as_records
from stowline.sinks.latency import append_latencies
from stowline.sources.segments import scan_segments
from stowline.streaming.archive import append_latencies_stream, write_segments_stream

NOW = dt.datetime(1970, 1, 1, 0, 0, 1, tzinfo=dt.timezone.utc)


def numbers(spark, path):
    return sorted(int(r.value) for r in spark.read.text(path).collect())


def test_latency(spark, make_records, tmp_path):
    df = make_records(
        [("t", 0, i, t, None, None, None) for i, t in enumerate([0, 400, 1500, None])]
    )
    got = [r[0] for r in df.orderBy("offset").select(latency_ms(now=NOW)).collect()]
    assert got == [1000, 600, -500, None]
    log = str(tmp_path / "log")
    append_latencies(df, log, NOW, drop_null=True)
    append_latencies(df.where("offset = 1"), log, NOW)
    assert numbers(spark, log) == [-500, 600, 600, 1000]
    with pytest.raises(Exception, match="no timestamp"):
        append_latencies(df, str(tmp_path / "other"), NOW)


def test_clock_is_read_once(spark, make_records):
    df = make_records([("t", 0, i, 0, None, None, None) for i in range(50)])
    assert df.repartition(4).select(latency_ms()).distinct().count() == 1


def stream_of(spark, folder, df):
    schema = df.schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_streams_flush_at_every_batch(spark, make_records, tmp_path):
    source, out, log, marks = (str(tmp_path / n) for n in ("in", "out", "log", "marks"))
    rows = [("t", 0, o, o, b"key", b"value", []) for o in range(10)]

    def put(some):
        make_records(some).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = stream_of(spark, source, make_records(rows))
        once = {"availableNow": True}
        write_segments_stream(stream, out, marks + "/a", cap=76, trigger=once).awaitTermination()
        append_latencies_stream(stream, log, marks + "/b", NOW, trigger=once).awaitTermination()

    put(rows[:3])
    put(rows[3:6])
    run()
    put(rows[6:])
    run()
    back = scan_segments(spark, out)
    assert sorted(r.offset for r in back.collect()) == list(range(10))
    assert numbers(spark, log) == [1000 - o for o in range(9, -1, -1)]
    # two records fit a segment; an odd one out is flushed with its batch
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(out)
    assert sorted(r.length for r in found.select("length").collect()) == [40, 40, 76, 76, 76, 76]


def test_a_repeated_batch_overwrites_itself(spark, make_records, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = make_records([("t", 0, o, o, b"key", b"value", []) for o in range(5)])
    df.coalesce(1).write.parquet(source)
    for mark in ("m1", "m2"):  # a lost checkpoint means redelivery
        write_segments_stream(
            stream_of(spark, source, df), out, str(tmp_path / mark), cap=76,
            trigger={"availableNow": True},
        ).awaitTermination()
    assert scan_segments(spark, out).count() == 5


@pytest.mark.parametrize("width", [3, 1 << 20])
def test_events_become_records(spark, width):
    events = spark.createDataFrame(
        [(i, i % 6, "ab"[i % 2]) for i in range(40)], "event_id long, user_id long, event_type string"
    ).select("*", F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"), F.lit("{}").alias("props"))
    seen, expected = {}, []
    for i in range(40):
        group = ("ab"[i % 2], i % 6 % 4)
        expected.append((i, *group, seen.get(group, 0)))
        seen[group] = seen.get(group, 0) + 1
    rows = events_as_records(events, width).orderBy("event_id")
    got = rows.select("event_id", "topic", "partition", "offset").collect()
    assert [tuple(r) for r in got] == expected
    first = rows.first()
    assert bytes(first.key) == b"0" and bytes(first.headers[0].value) == b"0"


def test_intervals():
    import random

    import numpy as np

    from stowline.streaming.dedupe import inside, with_offsets

    rng, seen = random.Random(1), set()
    starts, ends = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for _ in range(200):
        some = np.array(sorted({rng.randrange(300) for _ in range(rng.randint(0, 6))}), np.int64)
        assert inside(starts, ends, some).tolist() == [o in seen for o in some.tolist()]
        starts, ends = with_offsets(starts, ends, some)
        seen |= set(some.tolist())
        assert {o for a, b in zip(starts.tolist(), ends.tolist()) for o in range(a, b + 1)} == seen
        assert (starts[1:] > ends[:-1] + 1).all()


def test_redelivery_over_batches_and_restarts(spark, make_records, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    row = lambda t, o: (t, 0, o, o, b"key", b"v%d" % o, [("h", b"x")])

    def run(rows):
        make_records(rows).coalesce(1).write.mode("append").parquet(source)
        stream = stream_of(spark, source, make_records(rows))
        write_segments_stream(stream, out, mark, cap=300, trigger={"availableNow": True}, dedupe=True).awaitTermination()

    run([row("t", o) for o in range(10)] + [row("t", 3)])
    run([row("t", o) for o in range(5, 15)] + [row("u", 2)])
    run([row("u", 2), row("u", 2), row("t", 14), row("t", 70_000)])
    found = sorted((r.topic, r.offset) for r in scan_segments(spark, out).collect())
    assert found == [("t", o) for o in [*range(15), 70_000]] + [("u", 2)]
    state = spark.read.format("statestore").load(mark).select("key.*", "value.*").collect()
    intervals = {(r.topic, r._block): list(zip(r.groupState.starts, r.groupState.ends)) for r in state}
    assert intervals == {("t", 0): [(0, 14)], ("t", 1): [(70_000, 70_000)], ("u", 0): [(2, 2)]}


def test_the_same_copy_stays(spark, make_records):
    from stowline.operators.records import dedupe_records

    rows = [("t", 0, 1, 5, b"k", b"b", []), ("t", 0, 1, 5, b"k", b"a", []), ("t", 0, 1, 5, None, b"z", []), (None, None, 1, 5, b"k", b"c", None)]
    for n in (1, 3):
        table = make_records(rows).repartition(n)
        for df in (table, table.withColumn("more", F.create_map(F.lit("a"), F.lit(1)))):
            found = dedupe_records(df).collect()
            assert sorted((str(r.topic), bytes(r.value)) for r in found)[0] == ("None", b"c") and len(found) == 2
        found = dedupe_records(table).where("topic = 't'").collect()
        assert [bytes(r.value) for r in found] == [b"z"]
