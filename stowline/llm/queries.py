"""The registered queries of this package, over whole tables."""

from pyspark.sql import functions as F

from stowline.llm.divergence import source_divergence
from stowline.llm.jaccard import jaccard_components
from stowline.llm.language import detect_languages, fit_languages
from stowline.llm.licenses import scan_licenses
from stowline.llm.mixing import mix_sources, word_count
from stowline.llm.near_vectors import near_vectors
from stowline.llm.oracles import ORACLES
from stowline.llm.pieces import encode_pieces, transducer
from stowline.llm.secrets import BASE_KINDS, scan_secrets
from stowline.llm.sharding import kd_shards, with_slots
from stowline.llm.storage import saved
from stowline.llm.suffixes import remove_repeats
from stowline.llm.token_counts import count_tokens
from stowline.llm.top_scores import top_scores
from stowline.llm.vector_codes import codebooks_digest, vector_codes

MAX_TOKENS = 2048
SHARDS = 16


def vocabulary(name):
    """Path of a public tokenizer's file, installed wherever tasks run."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def op1_ppm_language(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    model = fit_languages(docs.where(~held_out()).select(F.col("doc_id").alias("id"), "text", "lang"))
    found = detect_languages(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op2_entropy_balanced_mix(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    sizes = saved(docs.select(F.col("doc_id").alias("id"), "source", word_count("text").alias("size")), "sizes")
    mixed = mix_sources(sizes)
    return mixed.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"), "copies", "rate",
    )


def op3_two_stage_suffixes(spark, sf_dir):
    return remove_repeats(_documents(spark, sf_dir), width=50, keep=["doc_id"])


def op4_token_group_jaccard(spark, sf_dir):
    return jaccard_components(_documents(spark, sf_dir), width=4, percent=85)


def document_points(docs):
    """Metadata of documents as points of a k-d tree, weighing their UTF-8 bytes plus 1."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    code = lambda c: F.crc32(F.col(c).cast("binary")).cast("double")
    return docs.select(
        "doc_id", size.alias("size"), F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.log2(size).alias("log_size"), code("source").alias("source_code"), code("lang").alias("lang_code"),
        F.col("doc_id").cast("double").alias("age"),
    )


POINT_DIMENSIONS = ("log_size", "source_code", "lang_code", "age")


def op5_kd_tree_shards(spark, sf_dir):
    points = saved(document_points(_documents(spark, sf_dir)), "points")
    sharded = kd_shards(points, POINT_DIMENSIONS, SHARDS, weight="size", id="doc_id")
    return with_slots(sharded.select("doc_id", "size", "text_crc32", "shard"), id="doc_id").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_license_templates(spark, sf_dir):
    return scan_licenses(_documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


def op7_sentencepiece_fst(spark, sf_dir):
    """Ids and decoded text as digests: SHA-256 of the ids as little-endian 32-bit numbers, and of the text."""
    model = vocabulary("piece_bpe_32k.model")
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    found = encode_pieces(docs, model, decoded="decoded", packed="packed")
    fallback = sorted(transducer(model).byte.values())
    return found.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.size("pieces").cast("long").alias("n_pieces"),
        F.size(F.filter("pieces", lambda x: x.between(fallback[0], fallback[-1]))).cast("long").alias("n_fallback"),
        F.sha2("packed", 256).alias("pieces_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        (F.col("decoded") == F.translate(F.coalesce("text", F.lit("")), "▁", " ")).alias("round_trip"),
    )


def op8_token_counts_fst(spark, sf_dir):
    counted = count_tokens(_documents(spark, sf_dir), vocabulary("word_bpe_49k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > MAX_TOKENS)


def op9_int8_near_vectors(spark, sf_dir):
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), threshold=0.9)


def op10_uniform_threshold_top_k(spark, sf_dir):
    scaled = F.transform("embedding", lambda x: F.floor(F.lit(1024.0) * x.cast("double")))
    good = F.forall("embedding", lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").where(good).select("vec_id", scaled.alias("vector"))
    return top_scores(rows, rows.where(F.col("vec_id") % 100 == 0), k=10)


def op11_arrow_divergence(spark, sf_dir):
    return source_divergence(_documents(spark, sf_dir))


def op12_blob_ledger_secrets(spark, sf_dir):
    """All versions against a new ledger; digests and texts of the spans."""
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return scan_secrets(_documents(spark, sf_dir)).select(
        "doc_id", *map(count, BASE_KINDS), F.sha2(told(base).cast("binary"), 256).alias("base_sha256"), told(F.col("spans")).alias("spans")
    )


def op13_laesa_vector_codes(spark, sf_dir):
    rows, books = vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return rows.withColumn("codebooks_sha256", F.lit(codebooks_digest(books)))


QUERIES = {
    "op1_ppm_language": op1_ppm_language,
    "op2_entropy_balanced_mix": op2_entropy_balanced_mix,
    "op3_two_stage_suffixes": op3_two_stage_suffixes,
    "op4_token_group_jaccard": op4_token_group_jaccard,
    "op5_kd_tree_shards": op5_kd_tree_shards,
    "op6_license_templates": op6_license_templates,
    "op7_sentencepiece_fst": op7_sentencepiece_fst,
    "op8_token_counts_fst": op8_token_counts_fst,
    "op9_int8_near_vectors": op9_int8_near_vectors,
    "op10_uniform_threshold_top_k": op10_uniform_threshold_top_k,
    "op11_arrow_divergence": op11_arrow_divergence,
    "op12_blob_ledger_secrets": op12_blob_ledger_secrets,
    "op13_laesa_vector_codes": op13_laesa_vector_codes,
}
