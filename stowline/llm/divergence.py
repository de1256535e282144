"""Divergence of each source's words from its language and from the language's other sources."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from stowline.llm.storage import SMALL_ROWS, saved
from stowline.llm.texts import give_back, slices, utf8

#: Terms are runs of ASCII letters and characters beyond ASCII; these bytes stand between them.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
_BREAKS = np.ones(256, bool)
_BREAKS[65:91] = _BREAKS[97:123] = _BREAKS[128:] = False
#: Probabilities are whole parts of this, counts are raised by this many occurrences.
SCALE, ADDED = 1_000_000_000, 5
SLICE_BYTES = 1 << 22
#: Rows of partial counts that a task gathers before it passes them on.
PARTIAL_ROWS = 1 << 19
#: Sources of a block, and terms of a shard: a task holds two blocks of one shard.
BLOCK_SOURCES = 64
SHARD_TERMS = 512
_COUNTS = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())]
)


def _terms(texts):
    """(row, term) of every occurrence in an array of texts."""
    split = pc.split_pattern_regex(pc.ascii_lower(texts), pattern=BETWEEN)
    rows, terms = pc.list_parent_indices(split), pc.list_flatten(split)
    held = pc.greater(pc.binary_length(terms), 0)
    return rows.filter(held).to_numpy(), terms.filter(held)


def _summed(table, keys, sums):
    grouped = table.group_by(keys, use_threads=False).aggregate([(c, "sum") for c in sums])
    return grouped.select([*keys, *[f"{c}_sum" for c in sums]]).rename_columns([*keys, *sums])


def _batch_counts(batch):
    """Rows (lang, source, term, n, docs) of a batch; the empty term counts documents alone."""
    lang, source = (pc.fill_null(batch.column(i), "").dictionary_encode() for i in (1, 2))
    width = max(1, len(source.dictionary))
    group = lang.indices.to_numpy().astype(np.int64) * width + source.indices.to_numpy()
    data, starts = utf8(batch.column(0))
    found = [(group, np.zeros(len(group), np.int64), np.ones(len(group), np.int64), pa.array([""], pa.string()))]
    long_row, long_parts = -1, []

    def whole_long_text():
        """Parts of one long text are one document together."""
        if long_parts:
            once = _summed(pa.concat_tables(long_parts), ["term"], ["n"])
            found.append((np.full(len(once), group[long_row]), once.column("n").to_numpy(), np.ones(len(once), np.int64), once.column("term").combine_chunks()))
            long_parts.clear()

    for first, last, begin, end in slices(data, starts, limit=SLICE_BYTES, breaks=_BREAKS):
        offsets = (np.clip(starts[first : last + 1], begin, end) - begin).astype(np.int32)
        texts = pa.StringArray.from_buffers(last - first, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[begin:end])))
        rows, terms = _terms(texts)
        coded = terms.dictionary_encode()
        codes = coded.indices.to_numpy().astype(np.int64)
        if last == first + 1 and (begin, end) != (starts[first], starts[last]):
            if first != long_row:
                whole_long_text()
                long_row = first
            counted = np.bincount(codes, minlength=len(coded.dictionary)).astype(np.int64)
            long_parts.append(pa.table({"term": coded.dictionary, "n": counted}))
            continue
        table = pa.table({"row": rows.astype(np.int64), "code": codes}).group_by(["row", "code"], use_threads=False).aggregate([([], "count_all")])
        row, code = table.column("row").to_numpy(), table.column("code").to_numpy()
        part = pa.table({"group": group[first + row], "code": code, "n": table.column("count_all").to_numpy(), "docs": np.ones(len(row), np.int64)})
        part = _summed(part, ["group", "code"], ["n", "docs"])
        found.append((part.column("group").to_numpy(), part.column("n").to_numpy(), part.column("docs").to_numpy(), coded.dictionary.take(part.column("code").combine_chunks())))
    whole_long_text()
    tables = []
    for held, n, docs, term in found:
        term = term if len(term) == len(held) else pa.array([""] * len(held), pa.string())
        tables.append(pa.table(
            [lang.dictionary.take(pa.array(held // width)), source.dictionary.take(pa.array(held % width)), term, pa.array(n, pa.int64()), pa.array(docs, pa.int64())],
            schema=_COUNTS,
        ))
    return pa.concat_tables(tables)


def _count_terms(batches):
    """Partial counts of a task: a row per group and term, as far as it has gathered them."""
    kept, rows = [], 0
    keys, sums = ["lang", "source", "term"], ["n", "docs"]
    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append(_batch_counts(batch))
        rows += len(kept[-1])
        if rows >= PARTIAL_ROWS:
            kept = [_summed(pa.concat_tables(kept), keys, sums)]
            rows = len(kept[0])
            if rows >= PARTIAL_ROWS // 2:
                yield from kept[0].cast(_COUNTS).to_batches(max_chunksize=1 << 16)
                kept, rows = [], 0
    if kept:
        yield from _summed(pa.concat_tables(kept), keys, sums).cast(_COUNTS).to_batches(max_chunksize=1 << 16)
    give_back()


def term_counts(docs, text="text", lang="lang", source="source"):
    """Rows (lang, source, term, n, docs): occurrences of a term in a group, and its documents with it.

    Every group has a row of the empty term, whose docs are all of its documents.
    """
    partial = docs.select(text, lang, source).mapInArrow(
        _count_terms, "lang string, source string, term string, n long, docs long"
    )
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _part(count, whole, terms):
    """1 + floor(SCALE * (count + 5) / (whole + 5 * terms)), exact beyond 64 bits."""
    wide = lambda c: c.cast("decimal(20,0)")
    return F.call_function(
        "div", F.lit(SCALE).cast("decimal(10,0)") * wide(count + ADDED), wide(whole + ADDED * terms)
    ).cast("long") + 1


def _pair_sums(key, table):
    """Sums of |p - q| over a shard's terms, for each source of one block and each of the other.

    Terms of which both sources have no row differ by their base probabilities: shard 0 adds
    these for all terms of the language, and every shard takes off those that it holds.
    """
    lang, shard = key[0].as_py(), key[1].as_py()
    heads = table.filter(pc.is_null(table.column("term")))
    held = table.filter(pc.is_valid(table.column("term")))
    names, base = heads.column("source").combine_chunks(), heads.column("p").to_numpy()
    block = heads.column("block").to_numpy()
    order = pc.index_in(held.column("source").combine_chunks(), value_set=names).to_numpy(zero_copy_only=False)
    terms = held.column("term").combine_chunks().dictionary_encode()
    width = len(terms.dictionary)
    matrix = np.repeat(base[:, None], width, axis=1)
    matrix[order, terms.indices.to_numpy()] = held.column("p").to_numpy()
    a, b = key[2].as_py(), key[3].as_py()
    left, right = np.flatnonzero(block == a), np.flatnonzero(block == b)
    everything = heads.column("terms").to_numpy()[0] if shard == 0 and len(heads) else 0
    ones, others, values = [], [], []
    for i in left:
        value = np.abs(matrix[right] - matrix[i]).sum(axis=1)
        value += (everything - width) * np.abs(base[right] - base[i])
        other = right != i
        ones.append(np.full(other.sum(), i))
        others.append(right[other])
        values.append(value[other])
        if a != b:
            ones.append(right)
            others.append(np.full(len(right), i))
            values.append(value)
    join = lambda x: np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)
    ones, others, values = join(ones), join(others), join(values)
    return pa.table(
        [pa.array([lang] * len(ones), pa.string()), names.take(pa.array(ones)), names.take(pa.array(others)), pa.array(values)],
        names=["lang", "source", "item", "value"],
    )


def source_divergence(docs, text="text", lang="lang", source="source", least_docs=30, report=50):
    """Rows (lang, source, part, item, value, rank): how far the groups' words are from each other.

    A language keeps the terms that at least ``least_docs`` of its documents hold. A group is
    a (lang, source) that occurs; its probability of a kept term is
    1 + floor(10^9 * (count + 5) / (N + 5 * V)), with N the count of all V kept terms. Part
    ``pair`` has the sum of all differences from every other source of the language, ranked
    whole; part ``term`` has the terms that the group holds and uses more than its language,
    by their difference, up to rank ``report``. Ties rank by UTF-8 bytes of the item.

    Tasks count terms by Arrow functions alone and gather counts per group and term, so a
    group with most rows leaves a task as one row per term. The merged counts are stored;
    pairs of sources come from shards of a language's terms and blocks of its sources as
    dense matrices of bounded size, whose sums add up. The rows of part ``pair`` are as many
    as the pairs of sources in a language.

    Null text, lang and source count as ''. A group without terms has counts of 0; a language
    without kept terms has pairs of value 0. Repeated rows are documents of their own. A
    long text is counted in parts and is one document. An empty table has no rows; other
    columns are left aside.
    """
    merged = saved(term_counts(docs, text, lang, source), "counts")
    kept = (
        merged.where("term <> ''").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("whole"))
        .where(F.col("docs") >= least_docs).select("lang", "term", "whole")
    )
    kept = saved(kept, "kept-terms")
    counted = saved(merged.where("term <> ''").drop("docs").join(kept, ["lang", "term"]), "kept-counts")
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("whole").alias("lang_words"))
    words = counted.groupBy("lang", "source").agg(F.sum("n").alias("words"))
    groups = merged.where("term = ''").select("lang", "source").join(words, ["lang", "source"], "left").join(langs, "lang", "left")
    none = F.lit(0).cast("long")
    groups = saved(groups.select("lang", "source", *[F.coalesce(c, none).alias(c) for c in ("words", "terms", "lang_words")]), "groups")
    small = groups.count() <= SMALL_ROWS
    few = F.broadcast if small else (lambda df: df)
    rated = counted.join(few(groups), ["lang", "source"]).select(
        "lang", "source", "term", _part(F.col("n"), F.col("words"), F.col("terms")).alias("p"),
        _part(F.col("whole"), F.col("lang_words"), F.col("terms")).alias("q"),
    )
    rated = saved(rated, "rated")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order)
    used = rated.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    used = used.withColumn("rank", rank).where(F.col("rank") <= report)

    sizes = groups.groupBy("lang").agg(F.count("*").alias("sources"), F.max("terms").alias("lang_terms"))
    cut = sizes.select("lang", F.ceil(F.col("sources") / BLOCK_SOURCES).alias("blocks"), F.ceil(F.greatest("lang_terms", F.lit(1)) / SHARD_TERMS).alias("shards"))
    cut = few(saved(cut, "shards"))
    block = F.pmod(F.xxhash64(F.lit("block"), "source"), F.col("blocks")).alias("block")
    columns = ("lang", "source", "term", "p", "terms", "blocks", "block", "shard")
    base = F.when(F.col("terms") > 0, _part(none, F.col("words"), F.greatest("terms", F.lit(1)))).otherwise(none)
    heads = groups.join(cut, "lang").withColumns({"term": F.lit(None).cast("string"), "p": base, "block": block})
    heads = heads.withColumn("shard", F.explode(F.sequence(none, F.col("shards") - 1)))
    cells = rated.join(cut, "lang").withColumns({"terms": none, "block": block, "shard": F.pmod(F.xxhash64(F.lit("shard"), "term"), F.col("shards"))})
    met = heads.select(*columns).union(cells.select(*columns)).withColumn("other", F.explode(F.sequence(none, F.col("blocks") - 1)))
    met = met.select("lang", "shard", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "source", "term", "p", "terms", "block")
    sums = met.groupBy("lang", "shard", "a", "b").applyInArrow(_pair_sums, "lang string, source string, item string, value long")
    pairs = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).withColumn("rank", rank)
    shape = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return shape(pairs, "pair").union(shape(used, "term"))
