import sentencepiece
import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline as pipeline
from stowline.llm.mixing import word_count
from stowline.llm.queries import vocabulary
from stowline.llm.storage import saved

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """What each stage returns, written and read again."""
    docs, tables = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    tables.append(docs)
    for _, stage in pipeline.STAGES:
        docs = saved(stage(spark, docs, FOLDER), "test-stage")
        tables.append(docs)
    return tables


def _whole(text, marks):
    """Text without marked bytes and the characters they cut, by characters."""
    out, at = [], 0
    for char in text:
        size = len(char.encode())
        if not any(marks[at : at + size]):
            out.append(char)
        at += size
    return "".join(out)


def test_stages_in_order(kept):
    names = [n for n, _ in pipeline.STAGES]
    assert names[0] == "language ID" and names[3].startswith("mixing") and len(names) == 5
    assert all(t.columns == kept[0].columns and t.dtypes == kept[0].dtypes for t in kept[:5])


def test_language_keeps_clean_documents(kept):
    assert kept[1].where("text rlike '[a-z]{3}'").count() == kept[0].where("text rlike '[a-z]{3}'").count()


def test_near_copies(kept):
    docs = {r.doc_id: r.text for r in kept[1].collect()}
    wanted = {d for d, (_, c) in brute.jaccard(docs, 5, 80).items() if c == d}
    assert {r.doc_id for r in kept[2].collect()} == wanted and len(wanted) < len(docs)


def test_repeats(kept):
    docs = {r.doc_id: r.text for r in kept[2].collect()}
    marks = brute.covered({d: t.encode() for d, t in docs.items()}, 50)
    wanted = {d: _whole(t, marks[d]) for d, t in docs.items()}
    found = {r.doc_id: (r.text, r.n_chars) for r in kept[3].collect()}
    assert found == {d: (t, len(t)) for d, t in wanted.items() if t == docs[d] or t.strip()}
    assert sum(map(len, wanted.values())) < sum(map(len, docs.values()))


def test_mix(kept):
    words = lambda df: {r.source: r.n for r in df.groupBy("source").agg(F.sum(word_count("text")).alias("n")).collect()}
    before, after = words(kept[3]), words(kept[4])
    ranked = sorted(before)
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(ranked)}
    unit = sum(before.values()) / sum(weights.values())
    for source in ranked:
        if weights[source] * unit < 3 * before[source]:
            assert after[source] == pytest.approx(weights[source] * unit, rel=0.15)
    copies = kept[4].groupBy("doc_id").count()
    assert copies.agg(F.max("count")).first()[0] <= 3
    assert kept[4].distinct().exceptAll(kept[3]).count() == 0


def test_pieces(kept):
    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary(pipeline.PIECES))
    texts = {r.doc_id: r.text for r in kept[4].collect()}
    for r in kept[5].collect():
        assert r.pieces == library.encode(texts[r.doc_id]) and r.n_pieces == len(r.pieces) and r.round_trip
    assert kept[5].count() == kept[4].count()


def test_run(spark, kept):
    assert sorted(r.doc_id for r in pipeline.run(spark, FOLDER).collect()) == sorted(r.doc_id for r in kept[5].collect())


def test_odd_documents(spark, tmp_path):
    text = "the and of is with ther ening tion on the and"
    learn = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    rows = [
        (90001, None, "en", "s", 0), (90002, "", None, None, 0), (90003, text * 3, None, None, 1), (90003, text * 3, None, None, 1),
        (None, text + " more of the", "en", "s", 1), (90004, "12 345", "en", "s", 6),
    ]
    docs = learn.union(spark.createDataFrame(rows, learn.schema))
    own = {"kept": "k", "copies": 9, "n_bytes": 7, "n_removed": 8, "n_spans": 9, "kept_sha256": "d", "score": "mine", "lang_pred": "x"}
    docs = docs.withColumns({name: F.lit(value) for name, value in own.items()})
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    table = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in pipeline.STAGES[:-1]:
        table = saved(stage(spark, table, str(tmp_path)), "odd")
        assert table.columns == docs.columns
        assert {tuple(r[name] for name in own) for r in table.collect()} == {tuple(own.values())}
        ids = [r.doc_id for r in table.collect()]
        assert not {90001, 90002, 90004} & set(ids)
    assert pipeline.STAGES[-1][1](spark, table, "").where("not round_trip").count() == 0
    empty = docs.where("false")
    for _, stage in pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_long_text(spark, tmp_path):
    """A text of some megabytes goes through all stages whole."""
    learn = spark.read.parquet(f"{FOLDER}/documents.parquet")
    body = " ".join(r.text or "" for r in learn.where("lang = 'en'").collect())
    long = " ".join(f"{word} {n}" for n, word in enumerate(body.split() * 4))
    rows = [(70001, long, "en", "src0", len(long)), (70002, long[: 3 * len(long) // 4], "en", "src0", 0)]
    table = learn.union(spark.createDataFrame(rows, learn.schema))
    for _, stage in pipeline.STAGES:
        table = saved(stage(spark, table, FOLDER), "long")
        assert not table.where("doc_id = 70002 and lang <> 'en'").count()
    found = table.where("doc_id = 70001").collect()
    assert all(r.round_trip and r.n_pieces > len(long) // 20 for r in found)


def test_near_copies_with_one_id(spark):
    """Rows of one doc_id are one document: it goes if any of its texts is a copy."""
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, text), (5, text + " more"), (5, ""), (5, "else " * 3), (7, "nothing like it at all here"), (7, "nothing like it at all here"), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = pipeline.one_of_near_copies(spark, docs, FOLDER).collect()
    assert sorted(map(tuple, kept)) == [(1, text), (7, "nothing like it at all here"), (8, "")]


def test_mix_without_ids(spark):
    """Rows without a doc_id are mixed one by one, for their own sources."""
    rows = [(None, f"{'word ' * (5 + i % 9)}{i // 2}", "abc"[i % 3], 1) for i in range(600)]
    rows += [(i, f"{'word ' * (5 + i % 9)}{i}", "abc"[i % 3], 1) for i in range(300)]
    rows += [(None, "the same row again", "b", 2)] * 50 + [(None, None, None, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n int").repartition(5)
    mixed = pipeline.mixed_sources(spark, docs, FOLDER)
    assert mixed.columns == docs.columns
    words = lambda df: {r.source: r.n for r in df.groupBy("source").agg(F.sum(word_count("text")).alias("n")).collect()}
    before, after = words(docs), words(mixed)
    unit = sum(before.values()) / 8
    for source, weight in zip("abc", (5, 2, 1)):
        assert after[source] == pytest.approx(min(weight * unit, 3 * before[source]), rel=0.1)
    counts = {tuple(r)[:4]: r["count"] for r in mixed.groupBy(*docs.columns).count().collect()}
    assert set(counts) <= set(rows) and all(n <= 3 * rows.count(r) for r, n in counts.items())
    again = pipeline.mixed_sources(spark, docs.repartition(2), FOLDER)
    assert sorted(map(str, again.collect())) == sorted(map(str, mixed.collect()))


def test_texts_stay_where_they_are_while_few_copies_go(spark):
    """The ids that go are broadcast, however many stay; without an id all rows stay."""
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, text), (2, text + " more"), (3, "nothing like it at all here"), (4, "a b c"), (4, "a b c"), (None, text), (None, text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = pipeline.one_of_near_copies(spark, docs.where("doc_id is null or doc_id < 4"), FOLDER)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
        assert {(r.doc_id, r.text) for r in kept.collect()} == {(3, rows[2][1]), (1, text), (None, text)}
        kept = sorted(pipeline.one_of_near_copies(spark, docs.where("doc_id is not null"), FOLDER).collect())
        assert [tuple(r) for r in kept] == [(1, text), (3, rows[2][1]), (4, "a b c")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
