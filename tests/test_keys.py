from pyspark.sql import functions as F

from stowline.functions.keys import (
    normalize_prefix,
    object_key,
    parse_object_key,
    sortable_long,
    target_topic,
    valid_prefix,
)


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def test_prefix_is_trimmed_and_ends_in_one_slash(spark):
    given = [None, "", "  ", "a", " a/b ", "a/", "\ta\n"]
    got = [r[0] for r in column(spark, given).select(normalize_prefix("v")).collect()]
    assert got == ["", "", "", "a/", "a/b/", "a/", "a/"]


def test_prefix_characters(spark):
    given = ["", "a-b_c.d/1", "!!abc", "a b", "abc\n"]
    got = [r[0] for r in column(spark, given).select(valid_prefix("v")).collect()]
    assert got == [True, True, False, False, False]


def test_text_order_of_offsets_is_numeric_order(spark):
    given = [0, 9, 10, 99, 100, 2**62, 2**63 - 1]
    got = [r[0] for r in column(spark, given, "long").select(sortable_long("v")).collect()]
    assert got == sorted(got) and all(len(t) == 19 for t in got)
    minus = column(spark, [-1], "long").select(sortable_long("v")).first()[0]
    assert minus == "-000000000000000001"


def test_object_key_and_back(spark):
    df = spark.createDataFrame([("t", 3, 0, 41)], "t string, p int, s long, e long")
    key = df.select(object_key(F.lit("p"), "t", "p", "s", "e").alias("k"))
    assert key.first().k == "p/t/3/0000000000000000000-0000000000000000041"
    assert key.select(parse_object_key("k").alias("k")).select("k.*").first() == ("t", 3, 0, 41)


def test_keys_that_do_not_fit_parse_to_null(spark):
    given = [
        "p/t/3/0000000000000000000--000000000000000001",
        "t/x/1-2",
        "1-2",
        "file:/x/t/3/1-2",
        "t/3/1-99999999999999999999",
    ]
    got = column(spark, given).select(parse_object_key("v").alias("k")).select("k.*").collect()
    assert [tuple(r) for r in got] == [
        (None,) * 4, (None,) * 4, (None,) * 4, ("t", 3, 1, 2), ("t", 3, 1, None),
    ]


def test_target_topic(spark):
    df = spark.createDataFrame([("a", "t"), ("", "t"), (" ", "t"), (None, "t")], "p string, t string")
    got = [r[0] for r in df.select(target_topic("p", "t")).collect()]
    assert got == ["a-t", "t", "t", "t"]
