import hashlib
import random
import re

import pytest

from stowline.llm.queries import QUERIES
from stowline.llm.secrets import RULES, Finder, Rule, open_ledger, scan_secrets

WANTED = {r.version for r in RULES}


def _plain(text):
    """Spans of the base kinds, over characters."""
    key = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
    spans = [(m.start(), 0, "assign", m.end()) for m in key.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(spans)


@pytest.mark.parametrize("seed", range(20))
def test_base_kinds(seed):
    rng = random.Random(seed)
    pieces = ["PassWord", "api_key", "ApiKey", "toKen", "ſecret", "secret", " ", "  ", "\t", "=", ":", '"', "'", "AKIA", "AKIAX2", "Q7" * 8, "ab12" * 5,
              "deadbeef", "é", "😀", "\n", "x" * 12, "a.b/c+d=e-f_g", "0" * 15, "short"]
    text = "".join(rng.choice(pieces) for _ in range(400))
    found = [s for s in Finder(RULES).spans(text.encode(), WANTED) if s[1] < 3]
    assert found == _plain(text)


def test_added_kinds():
    texts = {
        "github": "see ghp_" + "a1B2" * 9, "slack": "xoxb-1234567890-abcdefGHIJ", "jwt": "eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSMe",
        "pem": "-----BEGIN RSA PRIVATE KEY-----", "login": "postgres://me:pw@host/db",
    }
    for kind, text in texts.items():
        assert [s[2] for s in Finder(RULES).spans(f"é {text} ".encode(), WANTED)] == [kind]


def test_query_against_characters(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = QUERIES["op12_blob_ledger_secrets"](spark, folder).collect()
    assert len(found) == len(texts) and any(r.n_assign for r in found) and any(r.n_hex for r in found)
    for r in found:
        spans = _plain(texts[r.doc_id])
        told = ",".join(f"{kind}:{begin}:{end}" for begin, _, kind, end in spans)
        assert r.base_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[2] == k for s in spans) for k in ("assign", "access", "hex")]
        assert set(told.split(",")) - {""} <= set(r.spans.split(","))


def test_ledger(spark, tmp_path):
    """Blobs seen before are not scanned again; a new or changed rule runs over all once more."""
    folder, hot = str(tmp_path / "ledger"), "token=abcdefghijkl1"
    schema = "path string, version int, text string, blob int, spans string, todo int"
    first = [("a", 1, hot, 0, "", 0), ("a", 2, "nothing", 0, "", 0), ("b", 1, hot, 0, "", 0), ("b", 1, hot, 0, "", 0), (None, 1, hot, 0, "", 0), ("c", 1, None, 0, "", 0)]
    read = lambda df: sorted((str(r[0]), [tuple(s) for s in r.spans]) for r in df.collect())
    span = [("assign", 0, len(hot))]
    found = scan_secrets(spark.createDataFrame(first, schema).repartition(3), folder, id="path", rules=RULES[:2])
    assert read(found) == [("None", span), ("a", []), ("a", span), ("b", span), ("b", span), ("c", [])]
    ledger = open_ledger(spark, folder).collect()
    assert {r.blob for r in ledger} == {hashlib.sha256(t.encode()).hexdigest() for t in (hot, "nothing", "")}

    later = [("d", 1, "AKIA" + "B2" * 9, 0, "", 0), *first]
    found = scan_secrets(spark.createDataFrame(later, schema), folder, id="path", rules=RULES[:2])
    assert read(found)[-1] == ("d", [("access", 0, 22)]) and len(read(found)) == 7
    assert open_ledger(spark, folder).count() == len(ledger) + 1  # the new blob alone

    changed = (Rule("assign", RULES[0].pattern, 2, 5, True), RULES[1], RULES[2])
    more = [("e", 1, "token=short1", 0, "", 0), *later]
    found = scan_secrets(spark.createDataFrame(more, schema), folder, id="path", rules=changed)
    assert read(found)[-1] == ("e", [("assign", 0, 12)]) and read(found)[2] == ("a", span)
    new = [r for r in open_ledger(spark, folder).collect() if changed[0].version in r.scanned]
    known = {r.blob for r in ledger} | {hashlib.sha256(later[0][2].encode()).hexdigest()}
    # Old blobs get the changed and the new rule, not the one that already ran.
    assert all((RULES[1].version in r.scanned) == (r.blob not in known) for r in new)
    # The old rules still have their own findings only.
    assert read(scan_secrets(spark.createDataFrame(more, schema), folder, id="path", rules=RULES[:1]))[-1] == ("e", [])


def test_odd_rows(spark):
    long = "é" * 400_000 + " secret: '" + "k" * 30 + "' " + "word " * 300_000 + "0123456789abcdef"
    rows = [(1, long), (1, long), (2, ""), (3, None), (None, "AKIA" + "Z" * 20)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((str(r.doc_id), [tuple(s) for s in r.spans]) for r in scan_secrets(table).collect())
    at = long.index("secret")
    spans = [("assign", at, at + 39), ("hex", len(long) - 16, len(long))]
    assert found == [("1", spans), ("1", spans), ("2", []), ("3", []), ("None", [("access", 0, 24)])]
    assert scan_secrets(table.where("false")).count() == 0
    assert all(not r.spans for r in scan_secrets(table, rules=()).collect())
