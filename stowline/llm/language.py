"""Language of a text by prediction by partial matching."""

from collections import namedtuple

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from stowline.llm.texts import declared, give_back, slices, unused, utf8

#: Bytes of labelled text per language that a model learns from, in expectation.
SAMPLE_BYTES = 400_000
#: Texts are sampled by stretches of so many bytes, so that no single text makes up a sample.
STRETCH_BYTES = 8_192
ORDER = 4
SLICE_BYTES = 1 << 19
#: A context of 3 bytes or more that the sample shows fewer times than this is left out.
LEAST_SEEN = 2

#: langs: names; symbols: symbol of each byte, 0 for a byte never learned; children: per
#: depth, node of (node one byte shorter, symbol), 0 if none; cost: per depth and node, bits
#: of its last byte after the rest by language; escape: per depth and node, bits of leaving
#: the node as a context by language; unseen: bits of a byte never seen.
Model = namedtuple("Model", "langs symbols children cost escape unseen")


def fit_languages(labelled, order=ORDER, sample_bytes=SAMPLE_BYTES):
    """Context trees of up to ``order`` bytes for each language of (id, text, lang) rows.

    Learns from a sample by hash of id and text, ``sample_bytes`` of text per language in
    expectation: one pass counts bytes by language over all rows, a second reads the sample
    and counts its contexts on the executors. Texts of any length take part: a long one is
    chosen by stretches of 8 KiB, each with a chance of its own. Of a language with text, the
    row of the least hash is always in the sample, with its first stretch. Rows without text
    or language are left out; without any, the model knows no language.

    Escapes follow method C (a context seen n times with d different followers escapes with
    d / (n + d)), without exclusion, down to a uniform byte.
    """
    labelled = labelled.select("id", "text", "lang").where("text is not null and lang is not null")
    labelled = labelled.withColumn("size", F.octet_length("text")).where("size > 0")
    labelled = labelled.withColumn("key", F.xxhash64(F.lit("sample"), "id", "text"))
    chance = lambda n: F.xxhash64("key", n).bitwiseAND(0xFFFFFFFF) / float(1 << 32)
    first = chance(F.lit(0).cast("long"))
    # One row per language, as many as the model holds.
    totals = F.broadcast(labelled.groupBy("lang").agg(F.sum("size").cast("double").alias("bytes"), F.min(first).alias("least")))
    share = F.lit(float(sample_bytes)) / F.col("bytes")
    stretches = F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / STRETCH_BYTES))
    chosen = F.filter(stretches, lambda n: (chance(n) < share) | ((n == 0) & (chance(n) == F.col("least"))))
    raw = F.col("text").cast("binary")
    cut = F.transform(chosen, lambda n: F.substring(raw, (n * STRETCH_BYTES + 1).cast("int"), F.lit(STRETCH_BYTES)))
    sample = labelled.join(totals, "lang").select("lang", F.explode(cut).alias("text"))
    counts = (
        sample.select("lang", "text")
        .mapInArrow(_count_grams(order), "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    return build_model(
        np.array(counts["lang"].to_pylist(), object),
        counts["gram"].to_numpy().astype(np.uint64),
        counts["n"].to_numpy().astype(np.int64),
        order,
    )


def _grams(data, begins, depth):
    """Keys of all stretches of ``depth`` bytes within texts: the bytes, with the depth on top."""
    size = len(data) - depth + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    key = np.full(size, depth, np.uint64)
    inside = np.ones(size, bool)
    for k in range(depth):
        key = (key << np.uint64(8)) | data[k : k + size]
    for begin in begins[1:-1]:
        inside[max(0, begin - depth + 1) : begin] = False
    return key[inside]


def _count_grams(order):
    def count(batches):
        for batch in batches:
            texts, langs = batch.column("text"), np.array(batch.column("lang").to_pylist(), object)
            for lang in np.unique(langs.astype(str)) if len(langs) else []:
                data, starts = utf8(texts.filter(pa.array(langs == lang)))
                for first, last, begin, end in slices(data, starts, overlap=order):
                    bounds = np.clip(starts[first : last + 1], begin, end) - begin
                    for depth in range(1, order + 2):
                        keys, n = np.unique(_grams(data[begin:end], bounds, depth), return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(keys), pa.string()), pa.array(keys.astype(np.int64)), pa.array(n)],
                            ["lang", "gram", "n"],
                        )
        give_back(all_kept=True)

    return count


def build_model(langs, grams, counts, order=ORDER):
    """The tables of a model from counts of grams (see ``_grams``) by language."""
    names = sorted(set(langs.tolist()))
    kinds = len(names)
    lang = np.array([names.index(x) for x in langs.tolist()], np.int64)
    depths = np.zeros(len(grams), np.int64)
    for depth in range(1, order + 2):
        depths[(grams >> np.uint64(8 * depth)) == depth] = depth
    symbols = np.zeros(256, np.int64)
    seen = np.unique(grams[depths == 1] & np.uint64(255)).astype(np.int64)
    symbols[seen] = np.arange(1, len(seen) + 1)
    width = len(seen) + 1
    children, cost, escape = [None], [None], [np.zeros((2, kinds), np.float32)]
    uniform = 8.0
    # Node 1 of depth 0 is the empty context; node 0 of every depth stands for "none".
    keys = np.zeros(1, np.uint64)
    lower = np.full((1, kinds), uniform)
    for depth in range(1, order + 2):
        own = depths == depth
        gram, who, n = grams[own] - (np.uint64(depth) << np.uint64(8 * depth)), lang[own], counts[own]
        context = gram >> np.uint64(8)
        if depth > 3 and len(gram):
            _, group = np.unique(context, return_inverse=True)
            total = np.bincount(group, weights=n)
            keep = (total[group] >= LEAST_SEEN) & np.isin(context, keys)
            gram, who, n, context = gram[keep], who[keep], n[keep], context[keep]
        nodes, at = np.unique(gram, return_inverse=True)
        table = np.zeros((len(nodes), kinds))
        np.add.at(table, (at, who), n)
        parent = np.searchsorted(keys, nodes >> np.uint64(8)) if depth > 1 else np.zeros(len(nodes), int)
        total = np.zeros((len(keys), kinds))
        kindsseen = np.zeros((len(keys), kinds))
        np.add.at(total, parent, table)
        np.add.at(kindsseen, parent, table > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            leave = np.where(total > 0, -np.log2(kindsseen / (total + kindsseen)), 0.0)
            bits = -np.log2(table / (total + kindsseen)[parent])
        # The same byte after the context without its first byte: what an escape leads to.
        if depth == 1:
            back = np.full((len(nodes), kinds), uniform)
        else:
            tail = nodes & np.uint64((1 << (8 * (depth - 1))) - 1)
            place = np.searchsorted(keys, tail)
            place[place >= len(keys)] = 0
            found = keys[place] == tail
            back = np.where(found[:, None], lower[place], uniform)
        value = np.where(table > 0, bits, leave[parent] + back)
        # The context's own escape belongs to the depth of the context.
        escape[depth - 1][1:] = leave
        step = np.zeros((len(keys) + 1, width), np.int32)
        step[parent + 1, symbols[(nodes & np.uint64(255)).astype(int)]] = np.arange(1, len(nodes) + 1)
        children.append(step.ravel())
        cost.append(np.vstack([np.zeros((1, kinds)), value]).astype(np.float32))
        escape.append(np.zeros((len(nodes) + 1, kinds), np.float32))
        keys, lower = nodes, value
    return Model(names, symbols.astype(np.int32), children, cost, escape[: order + 1], uniform)


def code_lengths(model, data, starts):
    """Bits that each language's statistics take for each text: an array (texts, languages)."""
    kinds = len(model.langs)
    result = np.zeros((len(starts) - 1, kinds))
    order, width = len(model.cost) - 2, int(model.symbols.max()) + 1
    for first, last, begin, end in slices(data, starts, limit=SLICE_BYTES, overlap=order):
        symbol = model.symbols[data[begin:end]]
        size = len(symbol)
        bounds = np.clip(starts[first : last + 1], begin, end) - begin
        fresh = begin == starts[first]
        # How many bytes of its text lie before each position, as far as they count.
        before = np.full(size, order, np.int8)
        for k in range(order):
            at = (bounds[:-1] if fresh else bounds[1:-1]) + k
            at = at[(at < size)]
            before[at] = np.minimum(before[at], k)
        # Deepest node whose bytes end here, over all depths.
        node = model.children[1][width + symbol]
        here = [None, node]
        for depth in range(2, order + 2):
            step = np.zeros(size, np.int32)
            step[1:] = model.children[depth][here[depth - 1][:-1] * np.int64(width) + symbol[1:]]
            step[before < depth - 1] = 0
            here.append(step)
        bits = np.zeros((size, kinds), np.float32)
        open_ = np.ones(size, bool)
        for depth in range(order + 1, 0, -1):
            found = here[depth]
            if depth == order + 1:
                rows = np.flatnonzero(found)
                bits[rows] = model.cost[depth][found[rows]]
                open_[rows] = False
                rest = np.flatnonzero(open_)
                continue
            # The byte was not found one depth deeper: leave the context of this depth.
            context = np.zeros(len(rest), np.int32)
            inner = (before[rest] >= depth) & (rest > 0)
            context[inner] = here[depth][rest[inner] - 1]
            bits[rest] += model.escape[depth][context]
            hit = found[rest] > 0
            bits[rest[hit]] += model.cost[depth][found[rest[hit]]]
            rest = rest[~hit]
        bits[rest] += model.escape[0][1] + model.unseen
        if not fresh:
            bits[: order] = 0
        sums = np.zeros((size + 1, kinds))
        np.cumsum(bits, axis=0, dtype=np.float64, out=sums[1:])
        result[first:last] += sums[bounds[1:]] - sums[bounds[:-1]]
    return result


def detect_languages(docs, model, text="text", keep=None, names=("lang_pred", "score", "bits_per_byte")):
    """Every row with lang_pred, score and bits_per_byte more; ``keep`` names the columns to return.

    The language is that of the shortest code; the score is its share when each language's
    code length is read as a likelihood (0 to 1). A text that is null or has no letter gets
    ``und`` and score 0; so does every text if the model knows no language. Equal lengths
    take the first language by name. ``bits_per_byte`` is null for ``und``. Repeated rows
    and columns of any name pass through; columns of the three new names are replaced (``names`` gives others).
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(tuple(model))
    rest = docs.drop(*names)
    letters = unused(rest.columns, "_letter")
    keep = [c for c in rest.columns if keep is None or c in keep]
    rest = rest.select(*{*keep, text})
    schema = ", ".join(
        [declared(rest.schema[c]) for c in keep] + [f"`{n}` {kind}" for n, kind in zip(names, ("string", "double", "double"))]
    )

    def detect(batches):
        own = Model(*shared.value)
        for batch in batches:
            data, starts = utf8(batch.column(text))
            letter = np.array(batch.column(letters).to_pylist(), bool)
            found = np.full(batch.num_rows, "und", object)
            score, rate = np.zeros(batch.num_rows), [None] * batch.num_rows
            if own.langs and batch.num_rows:
                bits = code_lengths(own, data, starts)
                best = bits.argmin(axis=1)
                least = bits[np.arange(len(best)), best]
                share = 1 / np.exp2(np.minimum(least[:, None] - bits, 0)).sum(axis=1)
                found = np.where(letter, np.array(own.langs, object)[best], "und")
                score = np.where(letter, share, 0.0)
                sizes = np.maximum(np.diff(starts), 1)
                rate = [x if ok else None for x, ok in zip((least / sizes).tolist(), letter.tolist())]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, keep), pa.array(found.tolist(), pa.string()), pa.array(score), pa.array(rate, pa.float64())],
                [*keep, *names],
            )
            del data, batch
            give_back(all_kept=True)

    flagged = rest.withColumn(letters, F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    return flagged.mapInArrow(detect, schema)
