import datetime as dt
import decimal
import struct

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stowline.operators.files import latest_offsets
from stowline.operators.records import to_source_records
from stowline.sources.listing import list_files
from stowline.sources.parquet import (
    parquet_progress,
    physical_schema,
    physical_tree,
    scan_parquet_physical,
    schema_inventory,
    stream_parquet,
)
from stowline.streaming.widening import SchemaLog, widening_parquet

PHONE_BOOK = """message phone_book {
  required int64 id; required binary name (UTF8);
  required group phoneNumbers { repeated group phone { required int64 number; required binary kind (UTF8); } }
  optional group location { required double lon; optional double lat; }
  optional group accounts (MAP) { repeated group key_value { required binary key; required double value; } }
}"""

DOCUMENT = """message Document {
  required int64 DocId;
  optional group Links { repeated int64 Backward; repeated int64 Forward; }
  repeated group Name {
    repeated group Language { required binary Code; optional binary Country; }
    optional binary Url;
  }
}"""


def person(i):
    row = {
        "id": i, "name": f"p{i}",
        "phoneNumbers": {"phone": [{"number": i, "kind": "cell"}]},
    }
    if i % 3 == 0:
        row["accounts"] = {"key_value": [{"key": "k1", "value": 1.0}, {"key": "k2", "value": 2.0}]}
    else:
        row["location"] = {"lon": float(i), "lat": 2.0 * i if i % 3 == 1 else None}
    return row


@pytest.mark.parametrize(
    "codec,version",
    [("UNCOMPRESSED", "PARQUET_1_0"), ("SNAPPY", "PARQUET_2_0"), ("GZIP", "PARQUET_1_0"), ("ZSTD", "PARQUET_2_0")],
)
def test_phone_book(spark, tmp_path, write_groups, codec, version):
    path = str(tmp_path / "a b+%41.parquet")
    write_groups(path, PHONE_BOOK, [person(i) for i in range(90)], codec, version, row_group=1024)
    df = parquet_progress(spark, path)
    assert df.drop("filename", "row_index", "progress").schema.simpleString() == (
        "struct<id:bigint,name:string,phoneNumbers:struct<phone:array<struct<number:bigint,kind:string>>>,"
        "location:struct<lon:double,lat:double>,accounts:struct<key_value:array<struct<key:binary,value:double>>>>"
    )
    rows = df.orderBy("id").collect()
    assert [r.progress for r in rows] == [(i + 1) / 90 for i in range(90)]
    assert rows[-1].progress == 1.0
    for i, r in enumerate(rows):
        assert (r.id, r.name, r.phoneNumbers.phone) == (i, f"p{i}", [(i, "cell")])
        if i % 3 == 0:
            assert [(bytes(e.key), e.value) for e in r.accounts.key_value] == [(b"k1", 1.0), (b"k2", 2.0)]
            assert r.location is None
        else:
            assert r.location == (i, 2 * i if i % 3 == 1 else None) and r.accounts is None
    by_shuffle = parquet_progress(spark, path, broadcast_files=0)
    assert by_shuffle.agg(F.max("progress")).first()[0] == 1.0
    source = to_source_records(df, "t", F.struct("id", "name"), None, "progress")
    assert latest_offsets(source).first()[1:] == (None, 1.0)


def test_document(spark, tmp_path, write_groups):
    path = str(tmp_path / "d.parquet")
    write_groups(
        path, DOCUMENT,
        [
            {
                "DocId": 10,
                "Name": [
                    {"Language": [{"Code": "en-us", "Country": "us"}, {"Code": "en"}], "Url": "http://A"},
                    {"Url": "http://B"},
                    {"Language": [{"Code": "en-gb", "Country": "gb"}]},
                ],
                "Links": {"Forward": [20, 40, 60]},
            },
            {"DocId": 20, "Links": {"Backward": [10, 30], "Forward": [80]}, "Name": [{"Url": "http://C"}]},
            {"DocId": 30},
        ],
    )
    assert physical_schema(spark, path).simpleString() == (
        "struct<DocId:bigint,Links:struct<Backward:array<bigint>,Forward:array<bigint>>,"
        "Name:array<struct<Language:array<struct<Code:binary,Country:binary>>,Url:binary>>>"
    )
    one, two, three = scan_parquet_physical(spark, path).orderBy("DocId").collect()
    assert one.Links == ([], [20, 40, 60]) and two.Links == ([10, 30], [80])
    assert [len(n.Language) for n in one.Name] == [2, 0, 1]
    assert one.Name[2].Url is None and bytes(one.Name[0].Language[0].Country) == b"us"
    assert three.Links is None and three.Name == []
    inventory = {r.column_path: r for r in schema_inventory(spark, path).collect()}
    assert inventory["DocId"].target_type == "INT64" and not inventory["DocId"].optional
    assert inventory["Links"].target_type == "STRUCT" and inventory["Links"].optional
    assert inventory["Links.Forward"].target_type == "ARRAY<INT64>"
    assert inventory["Name"].target_type == "ARRAY<STRUCT>" and inventory["Name"].optional
    assert inventory["Name.Language.Code"].target_type == "BYTES"
    assert inventory["Name.Language.Code"].depth == 3


def test_types_without_annotations(spark, tmp_path, write_groups):
    path = str(tmp_path / "t.parquet")
    fields = {
        "int64": 2**40, "int32": -5, "boolean": True, "binary": b"\x01", "float": 1.5, "double": 2.5,
        "int96": bytes(range(8)) + struct.pack("<i", 2440588 + 7), "fixed_len_byte_array(3)": b"abc",
    }
    shape, row = [], {}
    for kind, value in fields.items():
        base = kind.split("(")[0]
        for repetition in ("required", "optional", "repeated"):
            name = f"{base}_{repetition}"
            shape.append(f"{repetition} {kind} {name};")
            if repetition != "optional":
                row[name] = [value, value] if repetition == "repeated" else value
    if "int96":
        exact = struct.pack("<q", 3_723_000_001_000) + struct.pack("<i", 2440588 + 20000)
        row["int96_required"], row["int96_repeated"] = exact, [exact, exact]
    write_groups(path, "message m { " + " ".join(shape) + " }", [row])
    got = scan_parquet_physical(spark, path).first()
    for name, value in row.items():
        seen = got[name]
        many = seen if isinstance(seen, list) else [seen]
        wanted = value if isinstance(value, list) else [value]
        assert [bytes(m) if isinstance(m, (bytes, bytearray)) else m for m in many] == wanted
        if name.endswith("_required"):
            assert got[name.replace("_required", "_optional")] is None


def test_annotated_types_show_their_storage(spark, tmp_path):
    path = str(tmp_path / "x.parquet")
    day = dt.date(1970, 1, 11)
    moment = dt.datetime(1970, 1, 1, 0, 0, 1)
    table = pa.table(
        {
            "date": pa.array([day, None]),
            "ts": pa.array([moment, None], pa.timestamp("us")),
            "time": pa.array([dt.time(0, 0, 2), None], pa.time64("us")),
            "u8": pa.array([3, None], pa.uint8()),
            "u32": pa.array([2**32 - 4, None], pa.uint32()),
            "u64": pa.array([2**64 - 5, None], pa.uint64()),
            "dec": pa.array([decimal.Decimal("1.23"), None], pa.decimal128(25, 2)),
            "text": pa.array(["é", None]),
            "raw": pa.array([b"\xff", None]),
            "list": pa.array([[1, None], None], pa.list_(pa.int32())),
            "empty": pa.array([[], None], pa.list_(pa.string())),
            "map": pa.array([[("k", 1.0)], None], pa.map_(pa.string(), pa.float64())),
            "deep": pa.array([{"l": [{"m": [("a", [moment])]}]}, None], pa.struct(
                [("l", pa.list_(pa.struct([("m", pa.map_(pa.string(), pa.list_(pa.timestamp("us"))))])))]
            )),
        }
    )
    pq.write_table(table, path)
    first, second = scan_parquet_physical(spark, path).collect()
    assert (first.date, first.ts, first.time, first.u8, first.u32, first.u64) == (10, 10**6, 2 * 10**6, 3, -4, -5)
    assert int.from_bytes(first.dec, "big") == 123
    assert first.text == "é" and bytes(first.raw) == b"\xff"
    assert first.list.list == [(1,), (None,)] and first.empty.list == []
    assert first.map.key_value == [("k", 1.0)]
    inner = first.deep.l.list[0].element.m.key_value[0]
    assert inner.key == "a" and inner.value.list[0].element == 10**6
    assert all(v is None for v in second)
    types = {r.column_path: r.target_type for r in schema_inventory(spark, path).collect()}
    assert types["ts"] == "INT64" and types["text"] == "STRING" and types["dec"] == "BYTES"
    assert types["list"] == "STRUCT" and types["list.list"] == "ARRAY<STRUCT>"


def test_older_list_layouts_and_binary_annotations(spark, tmp_path, write_groups):
    path = str(tmp_path / "o.parquet")
    schema = """message m {
      optional group a (LIST) { repeated int32 array; }
      optional group b (LIST) { repeated group element { required int32 x; required int32 y; } }
      optional group c (LIST) { repeated group bag { optional int64 array_element; } }
      optional binary e (ENUM); optional binary j (JSON);
      optional int32 d32 (DECIMAL(5,2)); optional int64 d64 (DECIMAL(10,2));
    }"""
    write_groups(path, schema, [
        {
            "a": {"array": [1, 2]}, "b": {"element": [{"x": 1, "y": 2}]},
            "c": {"bag": [{"array_element": 7}, {}]}, "e": b"E", "j": b"{}", "d32": 123, "d64": 456,
        },
        {},
    ])
    first, second = scan_parquet_physical(spark, path).collect()
    assert first.a.array == [1, 2] and first.b.element == [(1, 2)] and first.c.bag == [(7,), (None,)]
    assert (bytes(first.e), bytes(first.j), first.d32, first.d64) == (b"E", b"{}", 123, 456)
    assert all(v is None for v in second)


def test_scan_reads_only_what_is_selected(spark, tmp_path):
    path = str(tmp_path / "p.parquet")
    pq.write_table(pa.table({"id": [1, 2, 3], "v": [[1.0], [2.0], []], "w": ["a", "b", "c"]}), path)
    df = scan_parquet_physical(spark, path).where("id > 1").select("w")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,1)]" in plan
    assert "ReadSchema: struct<id:bigint,w:string>" in plan


def test_corrupt_files_fail_or_are_passed_over(spark, tmp_path):
    for name in "ab":
        pq.write_table(pa.table({"id": [1]}), str(tmp_path / f"{name}.parquet"))
    (tmp_path / "c.parquet").write_bytes(b"PAR1 this is no footer PAR1")
    with pytest.raises(Exception):
        scan_parquet_physical(spark, str(tmp_path)).collect()
    assert scan_parquet_physical(spark, str(tmp_path), on_error="skip").count() == 2


def test_names_agree_with_the_inventory(spark, tmp_path):
    pq.write_table(pa.table({"id": [1]}), str(tmp_path / "a b+%41.parquet"))
    row = scan_parquet_physical(spark, str(tmp_path), with_file=True).first()
    assert row.filename == list_files(spark, str(tmp_path)).first().path


def test_stream_takes_each_file_once(spark, tmp_path):
    folder, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    (tmp_path / "in").mkdir()

    def put(name, ids):
        pq.write_table(pa.table({"id": ids, "l": [[i] for i in ids]}), f"{folder}/{name}.parquet")

    def run():
        query = (
            stream_parquet(spark, folder, max_files_per_trigger=1, with_file=True)
            .writeStream.format("parquet").option("path", out).option("checkpointLocation", mark)
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return sorted((r.id, r.l.list[0].element, r.row_index) for r in spark.read.parquet(out).collect())

    put("a", [1, 2])
    put("b", [3])
    assert run() == [(1, 1, 0), (2, 2, 1), (3, 3, 0)]
    put("c", [4])
    assert run() == [(1, 1, 0), (2, 2, 1), (3, 3, 0), (4, 4, 0)]


def _written(path, **columns):
    import pyarrow as pa
    import pyarrow.parquet as pq

    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table(columns), path)


def test_names_with_any_character(spark, tmp_path):
    names = ["total (USD)", "a;b", "x {", "opt int (String)", "dot.ted", "plain"]
    _written(tmp_path / "a.parquet", **{n: [i, None] for i, n in enumerate(names)})
    rows = scan_parquet_physical(spark, str(tmp_path)).collect()
    assert [r.asDict() for r in rows] == [dict(zip(names, range(6))), dict.fromkeys(names)]
    assert {r.column_path for r in schema_inventory(spark, str(tmp_path)).collect()} == set(names)


def test_columns_of_all_files(spark, tmp_path):
    _written(tmp_path / "a.parquet", id=[1])
    _written(tmp_path / "sub" / "b.parquet", id=[2], extra=["x"], more=[[1, 2]])
    _written(tmp_path / "sub" / "deep" / "c.parquet", more=[[3]], id=[3])
    rows = scan_parquet_physical(spark, str(tmp_path))
    assert rows.columns == ["id", "extra", "more"]
    found = sorted((r.id, r.extra, r.more and [e.element for e in r.more.list]) for r in rows.collect())
    assert found == [(1, None, None), (2, "x", [1, 2]), (3, None, [3])]
    assert scan_parquet_physical(spark, str(tmp_path), recursive=False).columns == ["id"]
    assert {r.progress for r in parquet_progress(spark, str(tmp_path)).collect()} == {1.0}


def test_nested_folder_only(spark, tmp_path):
    _written(tmp_path / "sub" / "b.parquet", id=[1, 2])
    assert scan_parquet_physical(spark, str(tmp_path)).count() == 2


def test_conflicting_types_fail(spark, tmp_path):
    _written(tmp_path / "a.parquet", id=[1])
    _written(tmp_path / "b.parquet", id=["1"])
    with pytest.raises(ValueError, match="column id is .*a.parquet.*b.parquet"):
        scan_parquet_physical(spark, str(tmp_path))


def test_stream_takes_old_files_with_progress(spark, tmp_path):
    import os
    import time

    folder = tmp_path / "in"
    _written(folder / "new.parquet", id=[1, 2])

    def run():
        stream = stream_parquet(spark, str(folder), with_progress=True)
        query = (
            stream.writeStream.format("parquet").option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return sorted((r.id, r.progress) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert run() == [(1, 0.5), (2, 1.0)]
    _written(folder / "old.parquet", id=[3])
    past = time.time() - 30 * 86400
    os.utime(folder / "old.parquet", (past, past))
    _written(folder / "newer.parquet", id=[4])
    assert run() == [(1, 0.5), (2, 1.0), (3, 1.0), (4, 1.0)]


def test_schema_may_be_given(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "a"))
    tree = physical_tree(spark, str(tmp_path / "a"))
    assert scan_parquet_physical(spark, str(tmp_path / "a"), schema=tree).count() == 3
    with pytest.raises(ValueError, match="no file"):
        (tmp_path / "none").mkdir()
        physical_tree(spark, str(tmp_path / "none"))


def _widened(spark, tmp_path, got, files=1):
    def flush(rows, epoch):
        got.extend(r.asDict() for r in rows.collect())

    query = widening_parquet(
        spark, str(tmp_path / "in"), flush, str(tmp_path / "log"), str(tmp_path / "mark"), files, trigger={"availableNow": True}
    )
    query.awaitTermination()


def test_columns_of_later_files_arrive(spark, tmp_path):
    def put(sql, name):
        spark.sql(sql).coalesce(1).write.parquet(str(tmp_path / "in" / name))

    got = []
    put("select 1 as a", "x")
    _widened(spark, tmp_path, got)
    assert got == [{"a": 1}]
    put("select 2 as a, 'new' as b", "y/deep")
    put("select named_struct('u', 1, 'v', 2) as c", "z")
    _widened(spark, tmp_path, got, 5)  # after a restart
    put("select 3 as a", "w")
    put("select named_struct('v', 7, 'w', cast(null as string)) as c", "q")
    _widened(spark, tmp_path, got)
    rows = {str(r.get("a")) + str(r.get("b")): r for r in got if r.get("a") is not None}
    assert rows["1None"] == {"a": 1} and rows["2new"]["b"] == "new" and set(rows["3None"]) >= {"a", "b", "c"}
    deep = [r["c"].asDict() for r in got if r.get("c") is not None]
    assert deep[0]["v"] == 2 and deep[1] == {"u": None, "v": 7, "w": None}
    versions = SchemaLog(str(tmp_path / "log")).versions()
    assert len(versions) == 4 and len({v["kind"] for v in versions}) == 4

    put("select 'text' as a", "bad")
    with pytest.raises(Exception, match=r"column a is .*in/x/.* and .*in/bad/"):
        _widened(spark, tmp_path, got)
    assert len(SchemaLog(str(tmp_path / "log")).versions()) == 4
