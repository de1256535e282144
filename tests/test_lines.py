import os
import random

import pytest
from pyspark.sql import functions as F

from stowline.functions.text import text_byte_length
from stowline.operators.lines import batch_number, line_position
from stowline.operators.records import to_kafka_rows, to_source_records
from stowline.sources.lines import scan_lines
from stowline.streaming.line_source import tail_lines


def got(df):
    return sorted((r.position, r.line) for r in df.select("position", "line").collect())


def scan(spark, tmp_path, data, name="f.txt", **options):
    path = tmp_path / name
    path.write_bytes(data)
    return got(scan_lines(spark, files=[str(path)], **options))


def sequential(data, codec="utf-8", mark=b""):
    """Lines by one walk over the text."""
    text, found, line, at = data.decode(codec), [], "", len(mark)
    i = 0
    while i < len(text):
        c = text[i]
        if c == "\r" and i + 1 == len(text):
            break
        at += len(c.encode(codec))
        if c == "\r" and text[i + 1] == "\n":
            i += 1
            at += len("\n".encode(codec))
        if c in "\r\n":
            found.append((at, line))
            line = ""
        else:
            line += c
        i += 1
    return found


def test_lines_and_positions(spark, tmp_path):
    assert scan(spark, tmp_path, b"\nfoo\n") == [(1, ""), (5, "foo")]
    assert scan(spark, tmp_path, b"foo") == []
    assert scan(spark, tmp_path, b"foo", emit_partial=True) == [(3, "foo")]
    assert scan(spark, tmp_path, b"") == []
    life = b"partial line finished\nline1\rline2\r\nline3\nline4\n\r"
    expected = [
        (22, "partial line finished"), (28, "line1"), (35, "line2"), (41, "line3"), (47, "line4"),
    ]
    assert scan(spark, tmp_path, life) == expected
    assert scan(spark, tmp_path, life + b"subsequent text\n") == [*expected, (48, ""), (64, "subsequent text")]


@pytest.mark.parametrize("mark,codec", [(b"\xff\xfe", "utf-16-le"), (b"\xfe\xff", "utf-16-be")])
def test_utf16(spark, tmp_path, mark, codec):
    data = mark + "foo\nbar\n".encode(codec)
    assert scan(spark, tmp_path, data, charset="UTF-16") == [(10, "foo"), (18, "bar")]
    assert scan(spark, tmp_path, data, charset="utf-16", stride=9) == [(10, "foo"), (18, "bar")]


def resume(spark, path, position, **options):
    state = spark.createDataFrame(
        [("file:" + str(path), position, None)], "filename string, position long, progress double"
    )
    return got(scan_lines(spark, files=[str(path)], offsets=state, **options))


def test_resume_at_a_stored_position(spark, tmp_path):
    path = tmp_path / "a b+%41.txt"
    path.write_bytes(b"first line\n")
    assert resume(spark, path, 1) == [(11, "irst line")]
    assert resume(spark, path, 11) == [] and resume(spark, path, 99) == []
    path.write_bytes(b"\xff\xfe" + "first line\nsecond line\n".encode("utf-16-le"))
    assert resume(spark, path, 24, charset="UTF-16") == [(48, "second line")]


@pytest.mark.parametrize("stride", [8, 9, 13, 64])
def test_ranges_do_not_change_the_lines(spark, tmp_path, stride):
    rng = random.Random(stride)
    text = "".join(rng.choice(["a", "b", "é", "😀", "中", "\n", "\r", "\r\n"]) for _ in range(400))
    text += "x" * 300 + "\r\n" + "tail"
    data = text.encode()
    assert scan(spark, tmp_path, data, stride=stride) == sequential(data)
    for mark, codec in ((b"\xff\xfe", "utf-16-le"), (b"\xfe\xff", "utf-16-be"), (b"", "utf-16-be")):
        wide = text.encode(codec)
        expected = sequential(wide, codec, mark)
        assert scan(spark, tmp_path, mark + wide, stride=stride, charset="UTF-16") == expected


def test_malformed_text_is_replaced(spark, tmp_path):
    assert scan(spark, tmp_path, b"a\xffb\nc\n") == [(4, "a�b"), (6, "c")]


def test_unreadable_files(spark, tmp_path):
    here, gone = tmp_path / "here", tmp_path / "gone"
    here.write_bytes(b"x\n")
    names = [str(tmp_path / "none"), str(here)]
    with pytest.raises(Exception, match="none"):
        scan_lines(spark, files=names)
    assert got(scan_lines(spark, files=names, on_error="skip")) == [(2, "x")]
    assert got(scan_lines(spark, files=names[:1], on_error="skip")) == []
    for on_error in ("fail", "skip"):
        gone.write_bytes(b"y\n")
        df = scan_lines(spark, files=[str(here), str(gone)], on_error=on_error)
        gone.unlink()
        if on_error == "skip":
            assert got(df) == [(2, "x")]
        else:
            with pytest.raises(Exception):
                df.collect()
    with pytest.raises(ValueError):
        scan_lines(spark, directory=str(tmp_path), on_error="other")


def test_source_records_and_topic_rows(spark, tmp_path):
    path = tmp_path / "f"
    path.write_bytes(b"a\nbc\n")
    records = to_source_records(scan_lines(spark, files=[str(path)]), "topic")
    assert records.columns == [
        "filename", "position", "progress", "topic", "partition", "key", "value", "timestamp",
    ]
    row = records.orderBy("position").first()
    assert row.filename.endswith("/f") and (row.position, row.progress, row.value) == (2, None, "a")
    assert row.partition is None and row.key is None and row.timestamp is not None
    out = to_kafka_rows(records).orderBy("value").collect()
    assert [(r.topic, r.partition, r.key, bytes(r.value), r.headers) for r in out] == [
        ("topic", None, None, b"a", []), ("topic", None, None, b"bc", []),
    ]
    nested = records.withColumn("value", F.struct(F.col("value").alias("line")))
    assert bytes(to_kafka_rows(nested).orderBy("value").first().value) == b'{"line":"a"}'


def test_byte_lengths(spark):
    texts = ["y", "ޙ", "퟿", "😀", None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(text_byte_length("t"), text_byte_length("t", "UTF-16")).collect()
    assert [tuple(r) for r in got] == [(1, 2), (2, 2), (3, 2), (4, 4), (None, None), (0, 0)]
    with pytest.raises(ValueError):
        text_byte_length("t", "latin-1")


@pytest.mark.parametrize("width", [2, 7, 1 << 20])
def test_positions_and_batches_over_blocks(spark, width):
    rows = [(f, i, "é" * (i % 5)) for f in "ab" for i in range(40 if f == "a" else 3)]
    df = spark.createDataFrame(rows, "f string, n long, line string")
    placed = line_position(df, ["f"], "n", width=width).orderBy("f", "n").collect()
    expected, last = [], None
    for f, _, line in rows:
        at = 0 if f != last else at
        last = f
        at += len(line.encode()) + 1
        expected.append(at)
    assert [r.position for r in placed] == expected
    numbered = batch_number(df, ["f"], "n", 7, width=width).orderBy("f", "n").collect()
    assert [r.batch for r in numbered] == [i // 7 for _, i, _ in rows]


class Tail:
    """A stream run to its end and restarted, as a user would."""

    def __init__(self, spark, tmp_path, **options):
        self.spark, self.options = spark, options
        self.out, self.mark = str(tmp_path / "_out"), str(tmp_path / "_mark")

    def run(self):
        query = (
            tail_lines(self.spark, **self.options)
            .writeStream.format("parquet")
            .option("path", self.out).option("checkpointLocation", self.mark)
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        found = self.spark.read.schema("filename string, position long, line string").parquet(self.out)
        return sorted((r.filename.rsplit("/", 1)[1], r.position, r.line) for r in found.collect())


def append(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "ab") as file:
        file.write(data)


def test_tail_follows_one_file_through_restarts(spark, tmp_path):
    path = tmp_path / "f"
    tail = Tail(spark, tmp_path, files=[str(path)], stride=16)
    expected = []
    for data, new in [
        (b"partial line", []),
        (b" finished\n", [(22, "partial line finished")]),
        (b"line1\rline2\r\nline3\nline4\n\r", [(28, "line1"), (35, "line2"), (41, "line3"), (47, "line4")]),
        (b"subsequent text", [(48, "")]),
        (b"\n", [(64, "subsequent text")]),
        (b"", []),
    ]:
        append(path, data)
        expected += [("f", *n) for n in new]
        assert tail.run() == sorted(expected)


def test_tail_directory_with_new_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    append(folder / "one", b"file1 line1\nfile1 line2 partial")
    append(folder / "two", b"file2 line1\nfile2 line2\nfile2 line3 partial")
    tail = Tail(spark, tmp_path, directory=str(folder))
    first = [("one", 12, "file1 line1"), ("two", 12, "file2 line1"), ("two", 24, "file2 line2")]
    assert tail.run() == first
    append(folder / "one", b" complete\n")
    append(folder / "three", b"\n")
    append(folder / "_hidden", b"no\n")
    rest = [("one", 41, "file1 line2 partial complete"), ("three", 1, "")]
    assert tail.run() == sorted(first + rest)


def test_tail_utf16_and_missing_files(spark, tmp_path):
    path = tmp_path / "w"
    append(path, b"\xff\xfe" + "a\nb".encode("utf-16-le"))
    options = {"files": [str(path), str(tmp_path / "none")], "charset": "UTF-16", "on_error": "skip"}
    tail = Tail(spark, tmp_path, **options)
    assert tail.run() == [("w", 6, "a")]
    append(path, "😀\r\n".encode("utf-16-le"))
    assert tail.run() == [("w", 6, "a"), ("w", 16, "b😀")]
    with pytest.raises(Exception, match="none"):
        Tail(spark, tmp_path / "x", files=[str(tmp_path / "none")]).run()


def test_tail_with_a_byte_limit(spark, tmp_path):
    from stowline.streaming.line_source import GrowingLinesReader

    path = str(tmp_path / "f")
    append(path, b"first\n")
    reader = GrowingLinesReader({"files": f'["{path}"]', "maxbytes": "10"})
    steps = [reader.initialOffset(), reader.latestOffset()]
    append(path, b"aaaa\nbbbb\ncccc\n" + b"d" * 30 + b"\ntail")
    for _ in range(4):
        steps.append(reader.latestOffset())
        reader.partitions(steps[-2], steps[-1])
    assert [s.get(path, 0) for s in steps] == [0, 6, 16, 21, 52, 52]


def test_tail_limit_takes_turns(tmp_path):
    from stowline.streaming.line_source import GrowingLinesReader

    busy, quiet = str(tmp_path / "a"), str(tmp_path / "b")
    append(tmp_path / "a", b"1\n")
    append(tmp_path / "b", b"1\n")
    reader = GrowingLinesReader({"files": f'["{busy}", "{quiet}"]', "maxbytes": "8"})
    at = reader.latestOffset()
    append(tmp_path / "b", b"22\n33\n")
    for _ in range(4):
        append(tmp_path / "a", b"0123456\n" * 2)
        before, at = at, reader.latestOffset()
        reader.partitions(before, at)
    assert at[quiet] == 8 and at[busy] > 2


def test_tail_never_passes_over_a_planned_range(tmp_path):
    from stowline.streaming.line_source import GrowingLinesReader

    path = tmp_path / "f"
    append(path, b"one\ntwo\n")
    reader = GrowingLinesReader({"files": f'["{path}"]', "onerror": "skip"})
    (ranges,) = reader.partitions({}, reader.latestOffset())
    os.rename(path, tmp_path / "away")
    with pytest.raises(OSError):
        list(reader.read(ranges))
    os.rename(tmp_path / "away", path)
    assert sum(len(b) for b in reader.read(ranges)) == 2


def test_a_named_hidden_file_is_read(spark, tmp_path):
    append(tmp_path / "_a.txt", b"x\n")
    append(tmp_path / "b.txt", b"y\n")
    names = [str(tmp_path / "_a.txt"), str(tmp_path / "b.txt")]
    assert sorted(r.line for r in scan_lines(spark, files=names).collect()) == ["x", "y"]
    assert scan_lines(spark, files=names[:1]).count() == 1
    with pytest.raises(FileNotFoundError):
        scan_lines(spark, files=[str(tmp_path / ".none")])
    assert scan_lines(spark, files=[str(tmp_path / ".none"), names[1]], on_error="skip").count() == 1


def _tailed(reader, start):
    """One trigger of a reader: the offset, and its lines as (file, line)."""
    end = reader.latestOffset()
    lines = []
    for task in reader.partitions(start, end):
        for batch in reader.read(task):
            lines += [(r["filename"].rsplit("/", 1)[-1], r["line"]) for r in batch.to_pylist()]
    reader.commit(end)
    return end, sorted(lines)


def test_a_vanished_file_leaves_the_others_alone(spark, tmp_path):
    from stowline.streaming.line_source import GrowingLinesReader
    from stowline.streaming.range_ledger import failed_ranges

    for name in "ab":
        append(tmp_path / "in" / name, f"{name}1\n{name}2\n".encode())
    state = str(tmp_path / "state")
    options = {"directory": str(tmp_path / "in"), "onerror": "skip", "state": state, "stride": "3"}
    reader = GrowingLinesReader(options)
    start, end = reader.initialOffset(), reader.latestOffset()
    tasks = reader.partitions(start, end)
    os.rename(tmp_path / "in" / "a", tmp_path / "away")
    read = lambda r, tasks: sorted(x["line"] for t in tasks for b in r.read(t) for x in b.to_pylist())
    assert read(reader, tasks) == ["b1", "b2"]
    reader.commit(end)
    kept = failed_ranges(spark, state).collect()
    assert [(r.path.rsplit("/", 1)[-1], r.start, r.end, r.tries) for r in sorted(kept, key=lambda r: r.start)] == [("a", 0, 3, 1), ("a", 3, 6, 1)]
    assert all("away" not in r.error and r.error for r in kept)

    append(tmp_path / "in" / "b", b"b3\n")
    start, lines = _tailed(reader, end)
    assert lines == [("b", "b3")]

    os.rename(tmp_path / "away", tmp_path / "in" / "a")
    append(tmp_path / "in" / "a", b"a3\n")
    # a restart in the same state, and the batch run twice, as after a crash before its commit
    reader = GrowingLinesReader(options)
    end = reader.latestOffset()
    tasks = reader.partitions(start, end)
    assert read(reader, tasks) == ["a1", "a2", "a3"]
    reader = GrowingLinesReader(options)
    assert read(reader, reader.partitions(start, end)) == ["a1", "a2", "a3"]
    reader.commit(end)
    assert failed_ranges(spark, state).count() == 0
    again = reader.latestOffset()
    assert reader.partitions(end, again) == [] and again == end

    with pytest.raises(ValueError, match="another query"):
        reader.partitions({str(tmp_path / "in" / "a"): 99}, end)


def test_a_range_that_fails_again_stays(tmp_path):
    from stowline.streaming.line_source import GrowingLinesReader
    from stowline.streaming.range_ledger import RangeLedger

    append(tmp_path / "f", b"one\ntwo\n")
    state = str(tmp_path / "state")
    reader = GrowingLinesReader({"files": f'["{tmp_path / "f"}"]', "onerror": "skip", "state": state})
    end = reader.latestOffset()
    tasks = reader.partitions({}, end)
    os.rename(tmp_path / "f", tmp_path / "away")
    assert [list(reader.read(t)) for t in tasks] == [[]]
    for tries in (1, 2, 3):
        os.rename(tmp_path / "away", tmp_path / "f")
        start, end = end, reader.latestOffset()
        tasks = reader.partitions(start, end)
        os.rename(tmp_path / "f", tmp_path / "away")
        assert [list(reader.read(t)) for t in tasks] == [[]]
        reader.commit(end)
        assert [r["tries"] for r in RangeLedger(state).failures()] == [tries + 1]
    os.rename(tmp_path / "away", tmp_path / "f")
    assert _tailed(reader, end)[1] == [("f", "one"), ("f", "two")]
    assert RangeLedger(state).failures() == []


def test_every_batch_is_bounded_also_after_restarts(spark, tmp_path):
    from stowline.streaming.line_source import drain

    rng = random.Random(5)
    wanted = []
    for name in ("a", "b", "c"):
        lines = [f"{name}{n} {'x' * rng.randrange(60)}" for n in range(80)]
        append(tmp_path / "in" / name, "".join(f"{line}\n" for line in lines).encode())
        wanted += lines
    sizes = []

    def start():
        lines = tail_lines(spark, directory=str(tmp_path / "in"), max_bytes_per_trigger=1024, state=str(tmp_path / "state"))

        def take(batch, _epoch):
            rows = [r.line for r in batch.collect()]
            sizes.append(sum(len(line) + 1 for line in rows))
            got.extend(rows)

        writer = lines.writeStream.foreachBatch(take).trigger(availableNow=True)
        return writer.option("checkpointLocation", str(tmp_path / "checkpoint")).start()

    got = []
    assert drain(start) == len([s for s in sizes if s])
    assert sorted(got) == sorted(wanted) and max(sizes) <= 1024 and len(sizes) >= 8
    append(tmp_path / "in" / "b", b"y" * 3000 + b"\nend\n")
    got.clear()
    drain(start)
    assert got == ["y" * 3000, "end"] and len(sizes[-3:]) == 3


def test_one_query_runs_dry_in_bounded_batches(spark, tmp_path):
    from stowline.streaming.line_source import run_dry

    append(tmp_path / "in" / "a", b"".join(b"%04d\n" % n for n in range(100)))
    lines = tail_lines(spark, directory=str(tmp_path / "in"), max_bytes_per_trigger=50, state=str(tmp_path / "state"))
    got = []
    writer = lines.writeStream.foreachBatch(lambda batch, _epoch: got.append([r.line for r in batch.collect()]))
    writer = writer.option("checkpointLocation", str(tmp_path / "checkpoint"))
    run_dry(lambda: writer.trigger(processingTime="0 seconds").start())
    assert got == [[f"{10 * b + n:04d}" for n in range(10)] for b in range(10)] and not spark.streams.active


def test_limited_triggers_work_a_listing_off(tmp_path, monkeypatch):
    from stowline.streaming.line_source import GrowingLinesReader

    for n in range(9):
        append(tmp_path / "in" / f"{n}", b"%d\n" % n)
    listed, listing = [], GrowingLinesReader._listing
    monkeypatch.setattr(GrowingLinesReader, "_listing", lambda self: listed.append(1) or listing(self))
    reader = GrowingLinesReader({"directory": str(tmp_path / "in"), "maxbytes": "2"})
    start, got = reader.initialOffset(), []
    for turn in range(10):
        start, lines = _tailed(reader, start)
        got += lines
        if turn == 3:
            os.remove(tmp_path / "in" / "4")  # gone before its turn
            append(tmp_path / "in" / "0", b"10\n")
            append(tmp_path / "in" / "9", b"9\n")
    assert [line for _, line in got] == [*"01235678", "9", "10"] and len(listed) == 2


def test_shares_of_a_folder_take_every_file_once(spark, tmp_path):
    from stowline.streaming.line_source import GrowingLinesReader

    def tail(n):
        for name in (f"f{n}", f"sub{n}/f", f"sub{n}/_no/f"):
            append(tmp_path / "in" / name, f"{name}\n".encode())

    for n in range(20):
        tail(n)
    options = [{"directory": str(tmp_path / "in"), "recursive": "true", "share": f"[{i}, 3]"} for i in range(3)]
    readers = [GrowingLinesReader(o) for o in options]
    ends, lines = zip(*(_tailed(r, r.initialOffset()) for r in readers))
    assert sorted(x for part in lines for _, x in part) == sorted(f for n in range(20) for f in (f"f{n}", f"sub{n}/f"))
    assert sum(map(len, ends)) == 40 and max(map(len, ends)) < 25
    tail(20)
    later = [x for r, e in zip(readers, ends) for _, x in _tailed(r, e)[1]]
    assert sorted(later) == ["f20", "sub20/f"]
    for wrong in ({"files": ["a"], "share": (0, 1)}, {"directory": "a", "share": (2, 2)}):
        with pytest.raises(ValueError, match="share"):
            tail_lines(spark, **wrong)


def test_scan_reports_missing_files(spark, tmp_path):
    append(tmp_path / "good", b"a\nb\n")
    files = [str(tmp_path / n) for n in ("good", "never")]
    found = scan_lines(spark, files=files, on_error="report").collect()
    assert sorted((r.filename.rsplit("/", 1)[-1], r.position, r.line, r.error) for r in found) == sorted(
        [("good", 2, "a", None), ("good", 4, "b", None), ("never", 0, None, "no such file")], key=str
    )


def test_extents_that_cannot_be_read_are_rows(tmp_path):
    import pyarrow as pa

    from stowline.sources.lines import _extent_reader

    append(tmp_path / "f", b"a\nb\n")
    rows = [{"path": str(tmp_path / n), "start": s, "size": 2, "length": 4, "origin": 0} for n in ("f", "none") for s in (0, 2)]
    batch = pa.RecordBatch.from_pylist(rows)
    found = [r for b in _extent_reader("UTF-8", False, "report")([batch]) for r in b.to_pylist()]
    assert [(r["position"], r["line"], bool(r["error"])) for r in found] == [(2, "a", False), (4, "b", False), (0, None, True), (2, None, True)]


def test_null_keys_are_a_file(spark):
    from stowline.operators.lines import batch_number, line_position

    rows = [(None, n, "ab") for n in range(5)] + [("f", n, "c") for n in range(3)]
    table = spark.createDataFrame(rows, "file string, n long, line string")
    found = {(r.file, r.n): r.position for r in line_position(table, ["file"], "n", width=2).collect()}
    assert found == {(None, n): 3 * n + 3 for n in range(5)} | {("f", n): 2 * n + 2 for n in range(3)}
    found = {(r.file, r.n): r.batch for r in batch_number(table, ["file"], "n", 2, width=2).collect()}
    assert found == {(None, n): n // 2 for n in range(5)} | {("f", n): n // 2 for n in range(3)}


def test_memory_of_a_range():
    """Masks and texts of a range are made some at a time."""
    import io
    import tracemalloc

    from stowline.sources.line_ranges import read_lines

    class File(io.BytesIO):
        pass

    size = 32 << 20
    data = (b"some words of a line " * 3 + b"\n") * (size // 64)
    file = File(data)
    tracemalloc.start()
    lines = sum(len(b) for b in read_lines(file, "f", 0, size, len(data)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert lines == size // 64 and peak < 150e6
