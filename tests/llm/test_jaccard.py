import random

import numpy as np
import pytest

import brute
from stowline.llm import jaccard
from stowline.llm.queries import QUERIES


@pytest.mark.parametrize("seed", range(30))
def test_local_links(seed):
    rng = random.Random(seed)
    percent = rng.choice([40, 60, 80, 85, 95])
    base = [set(rng.sample(range(400), rng.randint(3, 60))) for _ in range(4)]
    sets = []
    for _ in range(60):
        own = set(rng.choice(base))
        for _ in range(rng.randint(0, 6)):
            own ^= {rng.randrange(400)}
        sets.append(own or {1})
    sets.sort(key=len)
    tokens = np.concatenate([np.array(sorted(s), np.uint64) for s in sets])
    parent = jaccard.local_links(np.array([len(s) for s in sets]), tokens, percent)
    found = brute.Sets(range(60))
    for i in range(60):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                found.join(i, j)
    assert parent.tolist() == [found.find(i) for i in range(60)]


def test_query_against_all_pairs(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    wanted = brute.jaccard({r.doc_id: r.text for r in rows}, 4, 85)
    found = QUERIES["op4_token_group_jaccard"](spark, folder).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == wanted


def test_groups_in_blocks(spark, monkeypatch):
    rng = random.Random(3)
    base = [rng.choice("abcdefgh") + str(rng.randrange(200)) for _ in range(90)]
    docs = {}
    for d in range(150):
        own = list(base)
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(90)] = f"x{rng.randrange(10**6)}"
        docs[d] = " ".join(own)
    docs |= {d: " ".join(rng.choice("pqrs") + str(rng.randrange(500)) for _ in range(40)) for d in range(200, 230)}
    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", 1500)
    table = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    for width, percent in ((4, 85), (2, 50)):
        found = jaccard.jaccard_components(table, width=width, percent=percent).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute.jaccard(docs, width, percent)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [
        (9, "A b\tC"), (4, "a B c"), (5, "a b d"), (6, None), (7, ""), (8, " \n "), (10, long), (11, long + " tail"),
        (11, long + " tail"), (None, "a b c"), (None, None), (12, "é É"), (13, "é é"),
    ]
    table = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n", "2 as rep", "3 as token")
    found = sorted(map(tuple, jaccard.jaccard_components(table).collect()), key=str)
    assert found == sorted(
        [(9, 1, 4), (4, 1, 4), (5, 1, 5), (6, 0, 6), (7, 0, 7), (8, 0, 8), (10, 59_997, 10), (11, 59_998, 10), (11, 59_998, 10),
         (None, 1, 4), (None, 0, None), (12, 1, 12), (13, 1, 13)],
        key=str,
    )
    assert jaccard.jaccard_components(table.where("false")).count() == 0


def test_one_id_with_other_texts(spark):
    """Rows of one id are one document: what either links with has one component_id."""
    first, second = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    rows = [(3, first), (9, first + " end"), (9, second), (12, second + " tail"), (12, "alone with these four words"), (4, second), (4, None), (20, "x y")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for n in (1, 3):
        found = jaccard.jaccard_components(table.repartition(n), width=4, percent=85).collect()
        reached = {(r.doc_id, r.component_id) for r in found if r.n_shingles}
        assert reached == {(3, 3), (9, 3), (12, 3), (4, 3), (20, 20)}
        assert sorted(r.n_shingles for r in found) == [0, 1, 2, 37, 37, 37, 38, 38]
