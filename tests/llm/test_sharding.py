from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stowline.llm.queries import QUERIES
from stowline.llm.sharding import kd_shards, with_slots


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = QUERIES["op5_kd_tree_shards"](spark, folder).collect()
    assert {r.doc_id: r["size"] for r in found} == {d: len((t or "").encode()) + 1 for d, t in docs.items()}
    import zlib

    assert all(r.text_crc32 == zlib.crc32((docs[r.doc_id] or "").encode()) for r in found)
    sums, slots = defaultdict(int), defaultdict(list)
    for r in found:
        sums[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    mean = sum(sums.values()) / 16
    assert sorted(sums) == list(range(16)) and all(abs(s - mean) < 0.1 * mean for s in sums.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {(r.law, r.grown_shard) for r in found} == {("bytes", None)}


def _split(points, shards, first=0):
    """The same tree by sorting, for dimensions without ties: {id: shard}."""
    if shards == 1 or not points:
        return {p[0]: first for p in points}
    spread = [max(p[i] for p in points) - min(p[i] for p in points) for i in (1, 2)]
    dim = 1 if spread[0] >= spread[1] else 2
    ordered = sorted(points, key=lambda p: p[dim])
    half = shards // 2
    goal, upto, best = sum(p[3] for p in points) * half / shards, 0, (0, 0)
    for n, p in enumerate(ordered):
        if upto + p[3] >= goal:
            best = n + 1 if upto + p[3] - goal <= goal - upto else n
            break
        upto += p[3]
    return _split(ordered[:best], half, first) | _split(ordered[best:], shards - half, first + half)


@pytest.mark.parametrize("shards", [2, 5])
def test_against_sorted_splits(spark, shards):
    points = [(i, (i * 7919) % 1009 / 1008, (i * 104729) % 2003 / 2002, 1 + (i * 31) % 17) for i in range(1000)]
    # Both dimensions reach from 0 to 1, so their widths compare as they are.
    points += [(2000, 0.0005, 0.0004, 1), (2001, 1.0, 1.0, 1), (2002, 0.0, 0.0, 1)]
    points = list({p[1]: p for p in {p[2]: p for p in points}.values()}.values())
    table = spark.createDataFrame(points, "id long, x double, y double, weight long")
    found = {r.id: r.shard for r in kd_shards(table, ["x", "y"], shards).collect()}
    wanted = _split(points, shards)
    # A cut may stop within a few ten-thousandths of the median.
    assert sum(found[i] != s for i, s in wanted.items()) <= 2


def test_odd_rows(spark):
    same = [(i % 300, 1.0, None, 1) for i in range(600)]
    table = spark.createDataFrame(same, "id long, x double, y double, weight long").withColumn("shard_of", F.lit(1))
    found = with_slots(kd_shards(table, ["x", "y"], 4)).collect()
    sums = defaultdict(list)
    for r in found:
        sums[r.shard].append(r.slot)
    assert all(abs(len(s) - 150) <= 4 and sorted(s) == list(range(len(s))) for s in sums.values())
    shard = defaultdict(set)
    for r in found:
        shard[r.id].add(r.shard)
    assert all(len(s) == 1 for s in shard.values())
    one = kd_shards(table.limit(1), ["x", "y"], 4).collect()
    assert len(one) == 1 and 0 <= one[0].shard < 4
    nothing = with_slots(kd_shards(table.where("false"), ["x", "y"], 4))
    assert nothing.count() == 0 and {"shard", "slot"} <= set(nothing.columns)
    null_ids = spark.createDataFrame([(None, 1.0, 2.0, 5), (3, None, None, 5)], "id long, x double, y double, weight long")
    assert with_slots(kd_shards(null_ids, ["x", "y"], 2)).count() == 2
