import random
import re
from collections import Counter, defaultdict

import pytest

from stowline.llm import divergence
from stowline.llm.divergence import source_divergence, term_counts


def _terms(text):
    return re.findall(r"[a-z\u0080-\U0010ffff]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def _plain(rows, least, report):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        own = Counter(_terms(text))
        counts[lang or "", source or ""] += own
        docs[lang or ""].update(own.keys())
    result = []
    for lang, source in counts:
        kept = [t for t, n in docs[lang].items() if n >= least]
        groups = {s: c for (x, s), c in counts.items() if x == lang}
        whole = sum(groups.values(), Counter())

        def part(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p, q = part(groups[source]), part(whole)
        pairs = [(-sum(abs(p[t] - other[t]) for t in kept), s.encode()) for s, c in groups.items() if s != source for other in [part(c)]]
        terms = [(q[t] - p[t], t.encode()) for t in kept if groups[source][t] and p[t] > q[t]]
        for name, values, most in (("pair", pairs, None), ("term", terms, report)):
            result += [(lang, source, name, s.decode(), -v, n + 1) for n, (v, s) in enumerate(sorted(values)[:most])]
    return sorted(result)


@pytest.mark.parametrize("blocks", [64, 2])
def test_against_plain_counts(spark, monkeypatch, blocks):
    monkeypatch.setattr(divergence, "BLOCK_SOURCES", blocks)
    monkeypatch.setattr(divergence, "SHARD_TERMS", 7)
    monkeypatch.setattr(divergence, "SLICE_BYTES", 300)
    monkeypatch.setattr(divergence, "PARTIAL_ROWS", 100)
    rng = random.Random(blocks)
    words = ["the", "Of", "ÀÉ", "àé", "straße", "z z", "naïve", "x"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = []
    for n in range(300):
        text = "".join(rng.choice(words[: rng.randint(2, 28)]) + rng.choice([" ", "\n", "1", "-", "\x00", "."]) for _ in range(rng.choice([0, 3, 30, 400])))
        rows.append((text, rng.choice(["en", "fr", None]), rng.choice(["a", "B", "b", "é", "", None])))
    rows += [(None, "xx", "a"), ("12 34", "xx", "b"), ("rare word", "yy", "only"), *[("the the", "en", "hot")] * 60]
    table = spark.createDataFrame(rows, "text string, lang string, source string").selectExpr("*", "1 as term", "2 as p", "'x' as item").repartition(4)
    found = source_divergence(table, least_docs=20, report=5).collect()
    assert sorted(map(tuple, found)) == _plain(rows, 20, 5)
    assert source_divergence(table.where("false")).count() == 0


def test_long_text_is_one_document(spark, monkeypatch):
    monkeypatch.setattr(divergence, "SLICE_BYTES", 1000)
    rows = [("ab cd " * 5000 + "end", "en", "s"), ("ab", "en", "s"), ("x" * 5000 + " ab", "en", "t")]
    table = spark.createDataFrame(rows, "text string, lang string, source string").coalesce(1)
    found = {(r.source, r.term): (r.n, r.docs) for r in term_counts(table).collect()}
    assert found == {
        ("s", "ab"): (5001, 2), ("s", "cd"): (5000, 1), ("s", "end"): (1, 1), ("s", ""): (0, 2),
        ("t", "x" * 5000): (1, 1), ("t", "ab"): (1, 1), ("t", ""): (0, 1),
    }


def test_parts_beyond_64_bits(spark):
    """Counts of a corpus of petabytes keep exact parts."""
    table = spark.createDataFrame([(10**13, 3 * 10**13 + 7, 10**6)], "n long, whole long, terms long")
    part = divergence._part(*(table[c] for c in ("n", "whole", "terms")))
    assert table.select(part).first()[0] == 1 + 10**9 * (10**13 + 5) // (3 * 10**13 + 7 + 5 * 10**6)
