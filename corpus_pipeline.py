"""A corpus pipeline over ``documents``: each stage works on all that the stage before kept.

A null text is rejected by the first stage. Rows that share a doc_id are one document; rows
without a doc_id stay through the stages that compare documents, and each is mixed as a
document of its own. Other columns pass through.
"""

from pyspark.sql import functions as F

from stowline.llm.jaccard import jaccard_components
from stowline.llm.language import detect_languages, fit_languages
from stowline.llm.mixing import mix_sources, word_count
from stowline.llm.pieces import encode_pieces
from stowline.llm.queries import held_out, vocabulary
from stowline.llm.storage import forget, saved
from stowline.llm.suffixes import ADDED, remove_repeats
from stowline.llm.texts import unused

#: A text is rejected when the best language's code is no shorter than its bytes.
MOST_BITS = 8.0
NEAR_WORDS, NEAR_PERCENT = 5, 80
REPEAT_BYTES = 50
#: So many ids, of 8 bytes each, are broadcast.
GONE_ROWS = 1 << 20
PIECES = "piece_bpe_32k.model"


def known_language(spark, docs, sf_dir):
    """Documents with a letter, in a text that the best learned language compresses."""
    model = fit_languages(docs.where(~held_out()).select(F.col("doc_id").alias("id"), "text", "lang"))
    names = lang, _, bits = [unused(docs.columns, n) for n in ("lang_pred", "score", "bits_per_byte")]
    found = detect_languages(docs, model, names=names)
    return found.where((F.col(lang) != "und") & (F.col(bits) < MOST_BITS)).select(*docs.columns)


def one_of_near_copies(spark, docs, sf_dir):
    """Of documents that links of 5-word shingles (Jaccard 0.8 or more) connect, that of the smallest id.

    Ids that go are fewer than those that stay: up to GONE_ROWS of them are broadcast, so that
    texts are not shuffled.
    """
    found = jaccard_components(docs, width=NEAR_WORDS, percent=NEAR_PERCENT)
    ids = found.groupBy("doc_id").agg(F.min("component_id").alias("component_id"), F.count("*").alias("rows"))
    apart = saved(ids.where("doc_id <> component_id or rows > 1"), "apart").select("doc_id", "rows", F.expr("doc_id = component_id").alias("stays"))
    gone = apart.select("doc_id")
    if gone.count() <= GONE_ROWS:
        gone = F.broadcast(gone)
    # a null id is in no table of ids
    once = docs.join(gone, "doc_id", "left_anti")
    if apart.where("stays").head(1):
        again = docs.join(apart.where("stays").select("doc_id"), "doc_id", "left_semi")
        once = once.union(again.dropDuplicates(["doc_id"]))
    return once


def without_repeats(spark, docs, sf_dir):
    """Texts without the 50-byte strings of documents of smaller ids; those left blank by it go."""
    names = [unused(docs.columns, name) for name in ADDED]
    removed, kept = F.col(names[1]), names[3]
    cut = remove_repeats(docs, width=REPEAT_BYTES, keep=[*docs.columns, kept], whole_characters=True, names=names)
    text = F.when(removed > 0, F.col(kept).cast("string")).otherwise(F.col("text"))
    cut = cut.withColumn("text", text).where((removed == 0) | F.col("text").rlike("[^\\s]"))
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixed_sources(spark, docs, sf_dir):
    """Documents in the copies that bring their sources to the weights 5, 2, 1, repeating.

    A row without a doc_id has a digest of its columns and, among equal rows, a number for an
    id; the copies of equal rows are taken of any of them.
    """
    row, one = unused(docs.columns, "_row"), F.lit(1).cast("long")
    nameless = docs.where("doc_id is null").withColumn(row, F.sha2(F.to_json(F.struct(*docs.columns)), 256))
    words = ["source", word_count("text").alias("size")]
    units = docs.where("doc_id is not null").select("doc_id", *words).groupBy("doc_id").agg(F.min("source").alias("source"), F.sum("size").alias("size"))
    equal = nameless.select("doc_id", F.col(row).alias("row"), *words).groupBy("doc_id", "row", "source", "size").agg(F.count("*").alias("rows"))
    equal = equal.select(F.explode(F.sequence(one, F.col("rows"))).alias("n"), "doc_id", "row", "source", "size")
    # The hash of a struct passes over nulls: documents with a doc_id rank by it alone.
    units = units.select(F.struct("doc_id", F.lit(None).cast("string").alias("row"), F.lit(None).cast("long").alias("n")).alias("id"), "source", "size")
    units = units.union(equal.select(F.struct("doc_id", "row", "n").alias("id"), "source", "size"))
    copies = saved(mix_sources(saved(units, "sizes")).where("copies > 0").select("id.doc_id", "id.row", "copies"), "copies")
    again = F.explode(F.sequence(one, F.col("c.copies"))).alias(unused(docs.columns, "_copy"))
    # There is a row of copies for most documents: never a table to broadcast.
    chosen = copies.where("row is null").hint("merge").alias("c")
    named = docs.alias("d").join(chosen, F.col("d.doc_id") == F.col("c.doc_id"))
    shared = copies.where("row is not null").groupBy("row").agg(F.sum("copies").alias("copies"))
    others = nameless.dropDuplicates([row]).alias("d").join(shared.alias("c"), F.col(f"d.{row}") == F.col("c.row"))
    return named.select("d.*", again).select(*docs.columns).union(others.select("d.*", again).select(*docs.columns))


def as_pieces(spark, docs, sf_dir):
    """Documents as SentencePiece ids, with whether they decode to the text again."""
    model = vocabulary(PIECES)
    decoded = encode_pieces(docs.select("doc_id", "lang", "source", "text"), model, decoded="decoded")
    same = F.col("decoded") == F.translate(F.coalesce("text", F.lit("")), "▁", " ")
    return decoded.select("doc_id", "lang", "source", "pieces", F.size("pieces").alias("n_pieces"), same.alias("round_trip"))


STAGES = [
    ("language ID", known_language),
    ("n-gram Jaccard join", one_of_near_copies),
    ("suffix-array dedup", without_repeats),
    ("mixing sources to target weights", mixed_sources),
    ("SentencePiece encoding and decoding", as_pieces),
]

#: Code lengths, components, suffix sorting and balancing go beyond SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if number:
            forget(before)
    return STAGES[-1][1](spark, docs, sf_dir)
