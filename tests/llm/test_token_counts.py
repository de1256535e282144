import json

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stowline.llm import token_counts
from stowline.llm.queries import QUERIES, vocabulary
from stowline.llm.token_counts import CLOSED, STATES, Counter, _automaton, count_tokens, scan_states

PATH = vocabulary("word_bpe_49k.json")
ODD = [
    "", "'s", "it's don't 'really 're 'r 've'v 'vx 'll'l 'lx ''s !'s 'S", "a<|endoftext|>b <|startoftext|><|endoftext|>", "İstanbul ΣΑΣ ςσ",
    "ée é", "x y \x1cz​\x85q", "１２３ Ⅷ ⓐ ½", "漢字かな交じり文 🎉🎉 👩‍👩‍👧", "<|endoftext|", "'", "'\"", " ", "\n", "r'e're", "it'S 'RE 'Ll",
    "ǅ ﬁ ß ẞ", "à<|endoftext|>́x", "word" * 5000, "ΑΣ", "ŉ", "ͅ ᾳ", "K Å", "<|ENDOFTEXT|> <|endoftext|><|endoftext|>",
]


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(PATH)
    return lambda texts: [len(e.ids) for e in made.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_as_the_library(spark, library):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()
    texts = ODD + [r.text for r in rows] + [None]
    assert Counter(PATH).count(texts).tolist() == library(texts)


def test_random_strings(library, monkeypatch):
    monkeypatch.setattr(token_counts, "SLICE_CHARS", 500)
    rng = np.random.default_rng(4)
    kinds = ["'strevmld ", "ab1 2,'", "éÉßİ́ x", "<|endoftxsar>' ", "漢🎉‍'l "]
    texts = ["".join(rng.choice(list(k), rng.integers(0, 1300))) for k in kinds for _ in range(60)]
    assert Counter(PATH).count(texts).tolist() == library(texts)


def test_scan_as_a_walk():
    step, _ = _automaton()
    rng = np.random.default_rng(1)
    for size in (1, 63, 64, 65, 1000, 5001):
        kinds = rng.integers(0, step.shape[1], size).astype(np.uint8)
        state, walk = CLOSED, []
        for kind in kinds:
            walk.append(state)
            state = step[state, kind]
        assert scan_states(step, kinds).tolist() == walk
    assert step.shape[0] == STATES


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    wanted = dict(zip(texts, library(list(texts.values()))))
    for r in QUERIES["op8_token_counts_fst"](spark, folder).collect():
        assert (r.n_bytes, r.n_tokens) == (len((texts[r.doc_id] or "").encode()), wanted[r.doc_id])
        assert r.over_limit == (r.n_tokens > 2048)


def test_odd_rows(spark, library):
    rows = [(1, "a b"), (1, "a b"), (None, "é"), (2, None), (3, ""), (4, "long word " * 200_000), (5, "x" * 1_200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("old"))
    found = count_tokens(docs, PATH).collect()
    assert [r.n_tokens for r in found] == library([t for _, t in rows])
    assert [r.n_bytes for r in found] == [len((t or "").encode()) for _, t in rows]
    assert count_tokens(docs.where("false"), PATH).count() == 0


def test_other_steps_are_refused(tmp_path):
    with open(PATH, encoding="utf-8") as file:
        whole = file.read()
    for change in (
        lambda spec: spec["normalizer"]["normalizers"].pop(),
        lambda spec: spec.update(normalizer=None),
        lambda spec: spec["pre_tokenizer"]["pretokenizers"][0]["pattern"].update(Regex=r"\S+"),
        lambda spec: spec["pre_tokenizer"]["pretokenizers"][1].update(add_prefix_space=True),
    ):
        spec = json.loads(whole)
        change(spec)
        path = tmp_path / "other.json"
        path.write_text(json.dumps(spec), encoding="utf-8")
        with pytest.raises(ValueError, match="another normalizer or pre_tokenizer"):
            Counter(str(path))
