import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from stowline.llm import language
from stowline.llm.queries import QUERIES


def _code_length(learned, text, order=4):
    """Bits of a text after the texts learned, by walking down from the longest context."""
    contexts = {}
    for raw in (t.encode() for t in learned):
        for i in range(len(raw)):
            for depth in range(min(order, i) + 1):
                contexts.setdefault(raw[i - depth : i], Counter())[raw[i]] += 1
    raw, bits = text.encode(), 0.0
    for i in range(len(raw)):
        for depth in range(min(order, i), -2, -1):
            if depth < 0:
                bits += 8
                break
            seen = contexts.get(raw[i - depth : i])
            if seen:
                total, kinds = sum(seen.values()), len(seen)
                if raw[i] in seen:
                    bits -= math.log2(seen[raw[i]] / (total + kinds))
                    break
                bits -= math.log2(kinds / (total + kinds))
    return bits


def _model(texts, monkeypatch):
    monkeypatch.setattr(language, "LEAST_SEEN", 0)
    langs, grams, counts = [], [], []
    for lang, own in texts.items():
        seen = Counter()
        for text in own:
            raw = np.frombuffer(text.encode(), np.uint8)
            for depth in range(1, 6):
                seen.update(language._grams(raw, np.array([0, len(raw)]), depth).tolist())
        langs += [lang] * len(seen)
        grams += seen.keys()
        counts += seen.values()
    return language.build_model(np.array(langs, object), np.array(grams, np.uint64), np.array(counts))


def test_code_lengths(monkeypatch):
    texts = {"a": ["the cat sat on the mat", "this that thé"], "b": ["le chat est là", "une chatte"]}
    model = _model(texts, monkeypatch)
    asked = ["the chat", "", "zzz qq", "une thé the cat sat", "é", "x" * 3000 + "the cat"]
    data = np.frombuffer("".join(asked).encode(), np.uint8)
    starts = np.cumsum([0, *(len(t.encode()) for t in asked)])
    found = language.code_lengths(model, data, starts)
    assert np.allclose(found, [[_code_length(texts[k], t) for k in "ab"] for t in asked], rtol=1e-5)


def test_parts_of_a_long_text(monkeypatch):
    model = _model({"a": ["the cat sat on the mat"], "b": ["le chat est"]}, monkeypatch)
    text = ("the cat is le chat; qu " * 400 + "la fin").encode()
    data, starts = np.frombuffer(text * 3, np.uint8), np.array([0, len(text), 3 * len(text)])
    whole = language.code_lengths(model, data, starts)
    monkeypatch.setattr(language, "SLICE_BYTES", 1000)
    assert np.allclose(whole, language.code_lengths(model, data, starts))


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    found = QUERIES["op1_ppm_language"](spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    right, rows, low, high = (
        found.join(docs, "doc_id").where("held_out and lang is not null")
        .agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*"), F.min("score"), F.max("score")).first()
    )
    assert rows > 200 and right > 0.98 and 0 <= low <= high <= 1


def test_odd_rows(spark):
    learn = spark.createDataFrame(
        [(i, t, k) for i, (t, k) in enumerate([("the cat sat", "en"), ("le chat est", "fr"), (None, "en"), ("x", None), ("", "de")])],
        "id long, text string, lang string",
    )
    model = language.fit_languages(learn)
    assert model.langs == ["en", "fr"]
    rows = [(1, "the cat"), (2, "le chat"), (3, None), (4, ""), (5, "12 !?"), (6, "the cat " * 100_000), (1, "the cat"), (None, "ß")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("mine")).withColumn("_letter", F.lit(7))
    found = language.detect_languages(docs, model).collect()
    assert [r.lang_pred for r in found[:6]] == ["en", "fr", "und", "und", "und", "en"]
    assert found[0] == found[6] and {r._letter for r in found} == {7}
    assert all(r.score == 0 and r.bits_per_byte is None for r in found[2:5])
    named = language.detect_languages(docs, model, names=("p", "q", "r")).first()
    assert (named.score, named.p) == ("mine", "en")
    assert language.detect_languages(docs.where("false"), model).count() == 0
    nothing = language.fit_languages(learn.where("false"))
    assert {r.lang_pred for r in language.detect_languages(docs, nothing).collect()} == {"und"}


def test_long_texts_are_learned(spark):
    book = "das ist der lange Text eines Buches, und er hört nicht auf; " * 2_000
    rows = [(1, book, "de"), (2, "le chat est là " * 9_000, "fr"), (3, "une chatte", "fr"), (4, "the cat sat", "en")]
    learn = spark.createDataFrame(rows, "id long, text string, lang string")
    model = language.fit_languages(learn)
    assert model.langs == ["de", "en", "fr"]
    docs = spark.createDataFrame([(1, "der Text hört auf"), (2, book), (3, "le chat est"), (4, "the cat")], "doc_id long, text string")
    assert [r.lang_pred for r in language.detect_languages(docs, model).collect()] == ["de", "de", "fr", "en"]
    # Every language is learned, however small the sample and whatever the ids.
    same = learn.union(learn).withColumn("id", F.lit(None).cast("long"))
    assert language.fit_languages(same, sample_bytes=1).langs == ["de", "en", "fr"]


def test_sample_of_long_texts(spark, monkeypatch):
    """Stretches hold the bytes of their text, each at most once, some ``sample_bytes`` of a language."""
    seen = []
    monkeypatch.setattr(language, "build_model", lambda langs, grams, counts, order: seen.append((langs, grams, counts)))
    text = "".join(f"{n:07d}é" for n in range(200_000))
    learn = spark.createDataFrame([(1, text, "x")], "id long, text string, lang string")
    raw = text.encode()
    language.fit_languages(learn, sample_bytes=len(raw), order=1)
    langs, grams, counts = seen.pop()
    ones = {int(g) & 255: int(n) for g, n in zip(grams, counts) if int(g) >> 8 == 1}
    assert ones == Counter(raw)
    language.fit_languages(learn, order=1)
    langs, grams, counts = seen.pop()
    assert 200_000 < sum(n for g, n in zip(grams.tolist(), counts.tolist()) if g >> 8 == 1) < 600_000
