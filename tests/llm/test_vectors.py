import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from stowline.llm import near_vectors, top_scores
from stowline.llm.components import components, joined
from stowline.llm.near_vectors import linked_pairs, quantised
from stowline.llm.queries import QUERIES


def _near(ids, vectors, threshold=0.9):
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    near = unit @ unit.T >= threshold
    np.fill_diagonal(near, False)
    found = brute.Sets(range(len(ids)))
    for i, j in zip(*np.nonzero(near)):
        found.join(int(i), int(j))
    smallest = {}
    for i, n in enumerate(ids):
        root = found.find(i)
        smallest[root] = min(smallest.get(root, n), n)
    return {n: (int(near[i].sum()), smallest[found.find(i)]) for i, n in enumerate(ids)}


def _clustered(rng, count, dim):
    base = rng.normal(size=(count // 10, dim))
    rows = base[rng.integers(0, len(base), count)] + rng.normal(size=(count, dim)) * rng.choice([0, 0.1, 0.3, 0.5], (count, 1))
    return (rows * rng.uniform(0.1, 50, (count, 1))).astype(np.float32)


@pytest.mark.parametrize("dim", [2, 64, 1500])
def test_bounds_lose_no_pair(dim):
    rng = np.random.default_rng(dim)
    rows = _clustered(rng, 700, dim)
    unit = rows.astype(float) / np.linalg.norm(rows.astype(float), axis=1)[:, None]
    codes, scales, errors, own = quantised(rows)
    assert np.allclose(own, unit)
    assert (np.abs(unit @ unit.T - (codes * scales[:, None]) @ (codes * scales[:, None]).T) <= errors[:, None] + errors + np.outer(errors, errors) + 1e-9).all()
    for threshold in (0.0, 0.5, 0.9, 0.999):
        found = {p for i, j in linked_pairs(quantised(rows), quantised(rows), threshold, same=True) for p in zip(i.tolist(), j.tolist())}
        exact = unit @ unit.T
        sure = {(i, j) for i, j in zip(*np.nonzero(exact >= threshold + 1e-12)) if i < j}
        assert sure <= found and all(exact[i, j] >= threshold - 1e-12 for i, j in found)


def test_near_vectors(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "TILE_ROWS", 60)
    rows = _clustered(np.random.default_rng(8), 400, 16)
    ids = [int(i) for i in np.random.default_rng(1).permutation(1000)[:400]]
    rows[5] = rows[17] = rows[200]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, rows)], "vec_id long, embedding array<float>")
    found = near_vectors.near_vectors(table).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == _near(ids, rows.astype(float))
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_near_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    found = QUERIES["op9_int8_near_vectors"](spark, "/root/testdata/sf0.01").collect()
    wanted = _near([r.vec_id for r in rows], np.array([r.embedding for r in rows], float))
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == wanted


NAN, INF = float("nan"), float("inf")
ODD = [
    (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [None, 1.0]), (6, [NAN, 1.0]), (7, [INF, 1.0]), (8, [1.0, 0.0, 0.0]),
    (9, []), (10, [1e30, 1e20]), (11, [1e-30, 0.0]), (12, [-0.0, 1.0]), (13, [0.0, 1.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0]),
]


def test_odd_vectors(spark):
    table = spark.createDataFrame(ODD, "vec_id long, embedding array<float>").withColumn("id", F.lit("x")).withColumn("tile", F.lit(3))
    found = near_vectors.near_vectors(table).collect()
    links = sorted((str(r.vec_id), r.n_links, r.component_id) for r in found)
    near = [(str(i), 4, 1) for i in (1, 1, 2, 10, 11)]
    alone = [(str(i), 0, i) for i in (3, 4, 5, 6, 7, 8, 9)] + [("None", 0, None)]
    assert links == sorted(near + alone + [("12", 1, 12), ("13", 1, 12)])
    assert near_vectors.near_vectors(table.where("false")).count() == 0


def test_repeated_vector_ids(spark, monkeypatch):
    """Vectors under one id have links of their own."""
    monkeypatch.setattr(near_vectors, "TILE_ROWS", 2)
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.1]), (3, [1.0, 0.2]), (4, [0.1, 1.0]), (9, [-1.0, 0.0]), (9, [-1.0, 0.0]), (1, [1.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    found = near_vectors.near_vectors(table).collect()
    assert sorted(tuple(r)[:3] for r in found) == [(1, 0, 1), (1, 1, 1), (1, 2, 1), (2, 2, 1), (3, 2, 1), (4, 1, 1), (9, 1, 9), (9, 1, 9)]


def _top(ids, rows, queries, k):
    result = {}
    for q in queries:
        own = [(-sum(a * b for a, b in zip(rows[i], rows[ids.index(q)])), n) for i, n in enumerate(ids) if n != q]
        result[q] = [(n, -s) for s, n in sorted(own)[:k]]
    return result


@pytest.mark.parametrize("scale", [3, 1000, 10**10])
def test_top_scores(spark, monkeypatch, scale):
    monkeypatch.setattr(top_scores, "TILE_ROWS", 40)
    monkeypatch.setattr(top_scores, "QUERY_ROWS", 7)
    rng = np.random.default_rng(scale % 97)
    rows = rng.integers(-scale, scale + 1, (230, 6))
    rows[100:140] = rows[0]
    rows = [[int(x) for x in r] for r in rows]
    ids = [int(i) for i in rng.permutation(900)[:230]]
    table = spark.createDataFrame(list(zip(ids, rows)), "vec_id long, vector array<long>")
    asked = table.where("vec_id % 9 = 0")
    if scale == 10**10:  # sums beyond 64 bits aside
        table = table.selectExpr("vec_id", "transform(vector, x -> x div 100) vector")
        asked, rows = table.where("vec_id % 9 = 0"), [[int(abs(x) // 100 * (1 if x >= 0 else -1)) for x in r] for r in rows]
    found = {}
    for r in sorted(top_scores.top_scores(table, asked, k=4).collect(), key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(found[r.query_id])
    assert found == _top(ids, rows, [i for i in ids if i % 9 == 0], 4)


def test_top_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    ids, whole = [r.vec_id for r in rows], np.floor(1024 * np.array([r.embedding for r in rows], float)).astype(int)
    wanted = _top(ids, whole.tolist(), [i for i in ids if i % 100 == 0], 10)
    found = sorted(QUERIES["op10_uniform_threshold_top_k"](spark, "/root/testdata/sf0.001").collect())
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in found] == [
        (q, n + 1, i, s) for q in sorted(wanted) for n, (i, s) in enumerate(wanted[q])
    ]


def test_few_candidates(spark):
    rows = [(0, [1, 2]), (1, [3, 4]), (2, None), (3, [None, 1]), (4, [1, 2, 3]), (5, [-1, 0]), (None, [1, 1])]
    table = spark.createDataFrame(rows, "vec_id long, vector array<long>").withColumn("score", F.lit(1))
    found = sorted(map(tuple, top_scores.top_scores(table, table.where("vec_id < 5"), k=10).collect()))
    assert found == [(0, 1, 1, 11), (0, 2, 5, -1), (1, 1, 0, 11), (1, 2, 5, -3)]
    assert top_scores.top_scores(table.where("false"), table, k=3).count() == 0
    assert top_scores.top_scores(table, table.where("false"), k=3).count() == 0


def test_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(top_scores, "TILE_ROWS", 5)
    monkeypatch.setattr(top_scores, "QUERY_ROWS", 2)
    rng = np.random.default_rng(4)
    once = [(i, v) for i, v in enumerate(rng.integers(-50, 51, (40, 5)).tolist())]
    other = (3, [1, -90, 4, 0, 90])  # a second vector of id 3
    rows = [*once, other, *once[5:20], *[once[7]] * 3, other]
    asked = [once[0], once[0], once[3], other, once[3], *[once[8]] * 12, (99, once[8][1])]
    wanted = []
    for q, v in (once[0], once[3], other, once[8], (99, once[8][1])):
        scored = [(-sum(a * b for a, b in zip(v, w)), i) for i, w in [*once, other] if i != q]
        wanted += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:10])]
    table = lambda rows: spark.createDataFrame(rows, "vec_id long, vector array<long>").repartition(3)
    found = top_scores.top_scores(table(rows), table(asked), k=10).collect()
    assert sorted(map(tuple, found)) == sorted(wanted)


def test_components(spark):
    rng = np.random.default_rng(0)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (160, 2))] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5), (7, None)]
    wanted = brute.Sets({n for pair in links for n in pair if n is not None})
    for a, b in links:
        if b is not None:
            wanted.join(a, b)
    table = spark.createDataFrame(links, "a long, b long")
    found = dict(map(tuple, components(table).collect()))
    assert all(found.get(n, n) == wanted.find(n) for n in wanted.up)
    assert components(table.where("false")).count() == 0
    a, b = np.array([p for p in links if p[1] is not None]).T
    parent = joined(np.arange(1100), a, b)
    assert all(parent[n] == wanted.find(n) for n in wanted.up)
