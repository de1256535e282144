import hashlib

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as pb

from stowline.llm import pieces
from stowline.llm.pieces import Transducer, decode_pieces, encode_pieces
from stowline.llm.queries import QUERIES, vocabulary

MODEL = vocabulary("piece_bpe_32k.model")
ODD = [
    "", " ", "  ", "a  b", " " * 37 + "x", "\n\n \n", "def f(x):\n        return  x\n\t\t#", "🎉é漢字 ▁▁ x", "<s></s><unk><0x0A>", "\x00\x01",
    "a" * 3000, "   鿿鿿  ", "ꙮ  ꙮ", " leading", "trail ", "tab\tx", "▁", "  é", " .  .", "   ...   ,", "end.\n", "don't -- (x),y.z;", "A.B.C.\r\nD",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_as_the_library(spark, library):
    made = Transducer(MODEL)
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").limit(400).collect()
    texts = ODD + [r.text or "" for r in rows]
    for text, ids in zip(texts, library.encode(texts)):
        assert made.encode(text).tolist() == ids, text[:50]
        assert made.decode(made.encode(text)) == text.replace("▁", " ")


def test_random_strings(library):
    rng = np.random.default_rng(5)
    made = Transducer(MODEL)
    kinds = ["ab .,", "theinrgs ▁", "0123 -+", "éß漢\n\t x", "▁ xX'"]
    texts = ["".join(rng.choice(list(k), rng.integers(1, 60))) for k in kinds for _ in range(300)]
    for text, ids in zip(texts, library.encode(texts)):
        assert made.encode(text).tolist() == ids, text


@pytest.mark.parametrize("turn", [1, -1])
def test_words_that_begin_with_nul(library, turn):
    made = Transducer(MODEL)
    units = sorted({u for t in ODD for u in made.units.findall(t.replace(" ", "▁")) if "▁" not in u and len(u) < 20} | {"abc", "x"})
    texts = [t for u in units for t in (f"{u}  {u}", f"a\0{u}", f"q  \0{u}", f"\0{u}", f"x \0{u} \0\0{u}")][::turn]
    for text, ids in zip(texts, library.encode(texts)):
        assert made.encode(text).tolist() == ids, text
        assert made.decode(made.encode(text)) == text


def test_generations_of_units(monkeypatch, library):
    monkeypatch.setattr(pieces, "CACHE_UNITS", 3)
    monkeypatch.setattr(pieces, "CACHE_PAIRS", 5)
    made = Transducer(MODEL)
    texts = [f"word{i % 7} other{i % 5} end{i}." for i in range(50)]
    assert [made.encode(t).tolist() for t in texts] == library.encode(texts)


def test_unigram_model(tmp_path):
    """Shortest paths by scores: a small model written here, against the library."""
    model = pb.ModelProto()
    for piece, score, kind in [
        ("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), ("▁", -2.0, 1), ("a", -2.5, 1), ("b", -2.5, 1), ("ab", -3.0, 1), ("▁a", -3.1, 1),
        ("bab", -4.5, 1), ("▁ab", -3.9, 1), ("aba", -5.0, 1),
    ]:
        model.pieces.add(piece=piece, score=score, type=kind)
    model.trainer_spec.model_type = 1
    model.normalizer_spec.name, model.normalizer_spec.remove_extra_whitespaces = "identity", False
    path = tmp_path / "small.model"
    path.write_bytes(model.SerializeToString())
    made, library = Transducer(str(path)), sentencepiece.SentencePieceProcessor(model_file=str(path))
    rng = np.random.default_rng(2)
    for _ in range(300):
        text = "".join(rng.choice(list("ab "), rng.integers(1, 20))).strip() or "a"
        assert made.encode(text).tolist() == library.encode(text), text


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in QUERIES["op7_sentencepiece_fst"](spark, folder).collect():
        ids = library.encode(texts[r.doc_id])
        assert (r.n_bytes, r.n_pieces) == (len(texts[r.doc_id].encode()), len(ids))
        assert r.pieces_sha256 == hashlib.sha256(np.array(ids, "<i4").tobytes()).hexdigest()
        assert r.n_fallback == sum(3 <= i < 259 for i in ids) and r.round_trip


def test_odd_rows(spark):
    rows = [(1, "a b"), (1, "a b"), (None, "é"), (2, None), (3, ""), (4, "long word " * 120_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("pieces", F.lit("old")).withColumn("decoded", F.lit(1))
    encoded = encode_pieces(docs, MODEL)
    found = decode_pieces(encoded, MODEL).collect()
    assert [r.decoded for r in found] == [t or "" for _, t in rows]
    assert [r.decoded for r in encode_pieces(docs, MODEL, decoded="decoded").collect()] == [r.decoded for r in found]
    assert [len(r.pieces) for r in found][3:5] == [0, 0] and found[0] == found[1]
    assert encode_pieces(docs.where("false"), MODEL).count() == 0
    none = decode_pieces(spark.createDataFrame([(None,), ([],)], "pieces array<int>"), MODEL).collect()
    assert [r.decoded for r in none] == [None, ""]
