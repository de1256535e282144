import pytest
from pyspark.sql import functions as F

from stowline.operators.files import (
    files_with_offsets,
    invalid_offsets,
    latest_offsets,
    new_files,
    plan_extents,
    unfinished_files,
)
from stowline.sources.listing import list_files, regular_files
from stowline.sources.storage import choose_input
from stowline.streaming.discovery import discover_new_files


def names(df):
    return sorted(r.path.rsplit("/", 1)[1] for r in df.select("path").collect())


def test_listing(spark, tmp_path):
    for name in ("one.txt", "two words+%41.txt", "_hidden", "k=1/three.txt", "deep/k=2/three.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True, parents=True)
        (tmp_path / name).write_text("abc")
    flat = list_files(spark, str(tmp_path))
    assert names(flat) == ["one.txt", "two words+%41.txt"]
    assert {r.length for r in flat.collect()} == {3}
    assert names(list_files(spark, str(tmp_path), recursive=True)) == [
        "one.txt", "three.txt", "three.txt", "two words+%41.txt",
    ]
    assert names(list_files(spark, "file://" + str(tmp_path) + "/")) == names(flat)
    assert flat.columns == ["path", "length", "modificationTime"]
    assert names(list_files(spark, [str(tmp_path / "one.txt")])) == ["one.txt"]
    plan = flat._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_directory_markers_are_dropped(spark):
    df = spark.createDataFrame([("s3://b/a/",), ("s3://b/a/x",)], "path string")
    assert names(regular_files(df)) == ["x"]


@pytest.mark.parametrize("files,directory", [(None, None), (["a"], "d"), ([], None), ([""], None)])
def test_files_or_directory(files, directory):
    with pytest.raises(ValueError):
        choose_input(files, directory)
    assert choose_input(["a"], None) == ["a"] and choose_input(None, "d") == ["d"]


@pytest.mark.parametrize(
    "length,start,expected",
    [
        (48, 0, [(0, 24), (24, 24)]),
        (32, 0, [(0, 24), (24, 8)]),
        (48, 30, [(30, 18)]),
        (0, 0, []),
        (48, 56, []),
        (48, 48, []),
    ],
)
def test_extents(spark, length, start, expected):
    df = spark.createDataFrame([("f", length, start)], "path string, length long, begin long")
    got = plan_extents(df, 24, "begin").orderBy("start").select("start", "size").collect()
    assert [tuple(r) for r in got] == expected


def test_many_extents_of_one_file_are_whole(spark):
    df = spark.createDataFrame([("f", 100_001)], "path string, length long")
    got = plan_extents(df, 8).agg(F.count("*"), F.sum("size"), F.min("start"), F.max("start")).first()
    assert tuple(got) == (12501, 100_001, 0, 100_000)
    with pytest.raises(ValueError):
        plan_extents(df, 7)


def test_unfinished(spark):
    files = spark.createDataFrame(
        [("new", 5), ("half", 5), ("done", 5), ("cut", 3), ("rows", 5), ("all", 5)],
        "path string, length long",
    )
    state = spark.createDataFrame(
        [("half", 4, None), ("done", 5, None), ("cut", 5, None), ("rows", None, 0.5), ("all", None, 1.0)],
        "filename string, position long, progress double",
    )
    joined = files_with_offsets(files, state)
    assert joined.count() == 6
    left = unfinished_files(joined)
    assert sorted(r.path for r in left.collect()) == ["half", "new", "rows"]
    known = files.where("path != 'new'")
    assert [r.path for r in new_files(files, known).collect()] == ["new"]


def test_latest_offsets(spark):
    df = spark.createDataFrame(
        [("a", 5, None), ("a", 9, None), ("b", None, 0.5), ("b", None, 1.0)],
        "filename string, position long, progress double",
    )
    assert sorted(map(tuple, latest_offsets(df).collect())) == [("a", 9, None), ("b", None, 1.0)]


def test_invalid_offsets(spark):
    rows = [
        ({"filename": "ok"}, {"position": "12"}),
        ({"filename": "reset"}, None),
        ({"filename": "none"}, {"progress": "1.0"}),
        ({"filename": "null"}, {"position": None}),
        ({"filename": "text"}, {"position": "x"}),
        ({"filename": "negative"}, {"position": "-1"}),
        ({"filename": "huge"}, {"position": "9223372036854775808"}),
        ({"name": "x"}, {"position": "1"}),
        (None, {"position": "1"}),
    ]
    df = spark.createDataFrame(rows, "partition map<string,string>, offset map<string,string>")
    assert [r.error for r in invalid_offsets(df).collect()] == [
        "position is missing", "position is not a long", "position is not a long",
        "position is negative", "position is not a long", "filename is missing",
        "partition is null",
    ]


def test_each_new_file_is_reported_once(spark, tmp_path):
    folder, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    (tmp_path / "in").mkdir()

    def run():
        query = (
            discover_new_files(spark, folder)
            .writeStream.format("parquet").option("path", out).option("checkpointLocation", mark)
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return names(spark.read.parquet(out))

    (tmp_path / "in/a").write_text("1")
    (tmp_path / "in/b").write_text("2")
    assert run() == ["a", "b"]
    (tmp_path / "in/c").write_text("3")
    (tmp_path / "in/k=1").mkdir()
    (tmp_path / "in/k=1/deeper").write_text("4")
    assert run() == ["a", "b", "c"]


def test_an_old_file_is_reported(spark, tmp_path):
    import os
    import time

    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    os.mkdir(folder)

    def found():
        query = (
            discover_new_files(spark, folder).writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", state).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return sorted(r.path.rsplit("/", 1)[1] for r in spark.read.parquet(out).collect())

    (tmp_path / "in" / "a").write_text("a")
    assert found() == ["a"]
    (tmp_path / "in" / "old").write_text("b")
    past = time.time() - 30 * 86400
    os.utime(tmp_path / "in" / "old", (past, past))
    (tmp_path / "in" / "new").write_text("c")
    assert found() == ["a", "new", "old"]


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from stowline.scratch import unshared_folder

    assert unshared_folder("local[4]") == unshared_folder("local")
    for master in ("yarn", "spark://host:7077", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            unshared_folder(master)


def test_listing_is_done_by_tasks(spark, tmp_path):
    from stowline.sources.segments import scan_segments

    names = ["a", "x/b", "x/y/c", "x/y/z/d", "x/y/z/w/e", "q/r/s/t/u/f", "_h/g", "x/.i", "x/y/_j/k", "sp ace/é%20+"]
    for name in names:
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(name)
    found = list_files(spark, str(tmp_path / "in"), recursive=True)
    wanted = sorted((f"file:{tmp_path}/in/{n}", len(n.encode())) for n in names if "_" not in n and "/." not in n)
    assert sorted((r.path, r.length) for r in found.collect()) == wanted
    assert [r.path for r in list_files(spark, str(tmp_path / "in")).collect()] == [f"file:{tmp_path}/in/a"]
    for df in (found, scan_segments(spark, str(tmp_path / "in"))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "FileScan" not in plan and "BatchScan" not in plan
    with pytest.raises(FileNotFoundError):
        list_files(spark, str(tmp_path / "none"))
