"""Secret scans over every version of every path, by a ledger of the blobs already scanned."""

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from stowline.llm.storage import SMALL_ROWS, saved
from stowline.llm.texts import give_back
from stowline.scratch import new_folder


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose ``group`` has ``least`` characters or more.

    The pattern is taken over UTF-8 bytes, leftmost and without overlaps; matches that are too
    short are dropped afterwards. With ``any_case``, ASCII letters match in either case.
    ``near`` are byte strings of which a text must hold one for the pattern to be tried.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    any_case: bool = False
    near: tuple = ()

    @property
    def version(self):
        """Changes with anything that can change findings, so old ledger rows don't stand for it."""
        told = repr((self.kind, self.pattern, self.group, self.least, self.any_case))
        return f"{self.kind}:{hashlib.sha256(told.encode()).hexdigest()[:12]}"


# Public shapes of credentials.
RULES = (
    Rule("assign", r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, near=("AKIA",)),
    Rule("hex", r"[0-9a-f]+", 0, 16),
    Rule("github", r"gh[opsur]_[A-Za-z0-9]+", 0, 40, near=("gh",)),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 20, near=("xox",)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30, near=("eyJ",)),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", near=("PRIVATE KEY",)),
    Rule("login", r"(https?|ftp|ssh|amqp|redis|mysql|mongodb|postgres)://[^\x00-\x20/:@]+:[^\x00-\x20/@]+@", near=("://",)),
)
BASE_KINDS = ("assign", "access", "hex")

SPANS = "array<struct<kind:string,start:long,end:long>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


class Finder:
    """Compiled rules over one text after the other."""

    def __init__(self, rules):
        self.rules = []
        for rule in rules:
            pattern = rule.pattern
            if rule.group == 0 and rule.least > 1 and re.fullmatch(r"\[[^]]*\]\+", pattern):
                pattern = f"{pattern[:-1]}{{{rule.least},}}"  # a run of one class: shorter runs needn't be listed
            flags = re.IGNORECASE if rule.any_case else 0
            self.rules.append((rule, [n.encode() for n in rule.near], re.compile(pattern.encode(), flags)))

    def spans(self, text, versions):
        """(start, order of the kind, kind, end) of the rules that ``versions`` names, in code points."""
        found = []
        for order, (rule, near, pattern) in enumerate(self.rules):
            if rule.version not in versions or near and not any(n in text for n in near):
                continue
            for match in pattern.finditer(text):
                begin, end = match.span(rule.group)
                if end - begin >= rule.least:
                    found.append((match.start(), order, rule.kind, match.end()))
        if found and not text.isascii():
            inside = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
            at = lambda byte: int(inside[byte - 1]) if byte else 0
            found = [(at(begin), order, kind, at(end)) for begin, order, kind, end in found]
        return sorted(found)


def blob_address(text):
    """SHA-256 of a text's UTF-8 bytes, null as empty."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def open_ledger(spark, folder):
    """Rows (blob, scanned, spans) of a ledger: rule versions run over a blob, and what they found."""
    schema = f"blob string, scanned array<string>, spans {SPANS}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)


def scan_unseen(versions, folder, path="path", text="text", rules=RULES):
    """Scan what the ledger in ``folder`` lacks, append it there; returns rows (path, blob) of all versions.

    A blob is the SHA-256 of a text. The addresses are gathered without the texts: blobs that
    several rows hold or that the ledger knows get a row with their smallest path and the rule
    versions still to run. Texts without such a row are scanned where they lie, with all
    rules; of the others only those of the smallest path, with the rules that are left. No
    text is shuffled while the rows are few enough to broadcast; beyond that the texts meet
    them by a join on the blob. The ledger gets one row per blob and scan, committed by
    Spark's writer at once, so a job that dies leaves the ledger as it was.
    """
    spark = versions.sparkSession
    rules = tuple(rules)
    wanted = [rule.version for rule in rules]
    every = F.array(*map(F.lit, wanted)) if wanted else F.array().cast("array<string>")
    texts = versions.select(F.col(path).alias("path"), F.col(text).alias("text"), blob_address(F.col(text)).alias("blob"))
    held = saved(texts.select("path", "blob"), "versions")
    ledger = open_ledger(spark, folder)
    seen = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_set("scanned"))).alias("seen"))
    blobs = held.groupBy("blob").agg(F.count("*").alias("rows"), F.min("path").alias("path"))
    noted = blobs.join(seen, "blob", "left").where("rows > 1 or seen is not null").select(
        "blob", F.col("path").alias("holder"), F.col("seen").isNull().alias("fresh"),
        F.when(F.col("seen").isNotNull(), F.array_except(every, "seen")).alias("todo"),
    )
    noted = saved(noted, "noted")
    few = noted.count() <= SMALL_ROWS
    met = texts.join(F.broadcast(noted) if few else noted, "blob", "left")
    here = F.when(F.col("fresh").isNull(), every).when(F.col("path").eqNullSafe(F.col("holder")), F.coalesce("todo", every))
    met = met.withColumn("scanned", here).where(F.size("scanned") > 0).select("blob", "text", "scanned")

    def scan(batches):
        finder = Finder(rules)
        for batch in batches:
            rows = []
            todo = batch.column(2).to_pylist()
            for body, versions in zip(batch.column(1).cast(pa.binary()), todo):
                found = finder.spans(body.as_py() or b"", versions)
                rows.append([{"kind": kind, "start": start, "end": end} for start, _, kind, end in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(rows, _SPANS)], ["blob", "scanned", "spans"])
        give_back()

    found = met.mapInArrow(scan, f"blob string, scanned array<string>, spans {SPANS}")
    found.write.mode("append").parquet(folder)
    return held


def scan_secrets(docs, folder=None, id="doc_id", text="text", rules=RULES):
    """Rows (id, blob, spans) for every row of ``docs``: the secrets of its text.

    ``docs`` may hold any number of historical versions of a path, one row each; equal texts
    are scanned once, whatever their path, and in later calls with the same ledger ``folder``
    not at all, unless a rule is new or changed. Without ``folder`` a ledger of its own is
    begun. Spans are structs (kind, start, end), in code points with the end exclusive, by
    start and then by the order of ``rules``; overlapping spans of several kinds all stay.
    Findings go back to all rows by a join on the blob, in which one text that most rows hold
    is one row of the ledger's side.

    A null text counts as empty and has no spans. Repeated ids and rows give a row each.
    Whole texts are searched, one at a time, so a task holds the longest. An empty table has
    no rows; other columns are left aside.
    """
    spark = docs.sparkSession
    rules = tuple(rules)
    folder = folder or new_folder(spark, "llm-ledger")
    held = scan_unseen(docs, folder, id, text, rules)
    valid = {rule.kind: n for n, rule in enumerate(rules)}
    ranks = F.create_map(*[F.lit(x) for pair in valid.items() for x in pair]) if valid else F.create_map().cast("map<string,int>")
    wanted = F.array(*[F.lit(rule.version) for rule in rules]) if rules else F.array().cast("array<string>")
    ledger = open_ledger(spark, folder).where(F.size("spans") > 0)
    # A scan's row counts for the kinds whose present version it ran.
    current = F.filter("scanned", lambda v: F.array_contains(wanted, v))
    kinds = F.transform(current, lambda v: F.substring_index(v, ":", 1))
    fresh = F.filter("spans", lambda s: F.array_contains(kinds, s["kind"]))
    ordered = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.element_at(ranks, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    found = (
        ledger.select("blob", fresh.alias("spans")).groupBy("blob").agg(F.flatten(F.collect_set("spans")).alias("spans"))
        .withColumn("spans", F.array_sort(F.array_distinct(ordered)))
        .withColumn("spans", F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))))
        .where(F.size("spans") > 0)
    )
    found = saved(found, "findings")
    few = found.count() <= SMALL_ROWS
    return held.join(F.broadcast(found) if few else found, "blob", "left").select(
        F.col("path").alias(id), "blob", F.coalesce("spans", F.array().cast(SPANS)).alias("spans")
    )
