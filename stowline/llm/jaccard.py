"""Exact Jaccard join of word shingles, with a token-group matrix."""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column
from pyspark.sql import functions as F

from stowline.llm.components import components, joined
from stowline.llm.storage import SMALL_ROWS, forget, saved
from stowline.llm.texts import BLANK, SMALL, Rolling, find_words, give_back, mixed, slices, utf8

#: Tokens in this share of all documents come last in the order of tokens.
FREQUENT_SHARE = 0.001
#: Documents of a slice that must hold a token for the slice to report it.
LEAST_REPORTED = 4
#: Shared tokens that open a group, at least and as a part of a set: prefixes are long enough
#: for any linked pair to have them.
SHARED, SHARED_PART = 3, 10
#: Leading bits of tokens by which documents that may share them are found, and such keys of a bucket.
KEY_BITS, BUCKET_KEYS = 44, 1 << 19
#: First tokens that a block of documents may hold together, one document excepted.
DEALT_TOKENS = 1 << 20
#: Tokens that a block of a group may hold together.
BLOCK_TOKENS = 1 << 20
SLICE_BYTES = 1 << 21
#: Candidates of one component tried before the rest of it.
FIRST_TRIED = LEADERS = 8


def shingle_sets(column, width):
    """Yield (first row, last row + 1, offsets, tokens): sorted distinct shingles by text.

    A token is a 64-bit hash of ``width`` lower-cased words, or of the whole text where it
    has fewer; texts without words have none.
    """
    data, starts = utf8(column)
    rolling = Rolling()
    held = []
    for first, last, begin, end in slices(data, starts, limit=SLICE_BYTES, breaks=BLANK):
        piece = SMALL[data[begin:end]]
        bounds = np.clip(starts[first : last + 1], begin, end) - begin
        begins, ends, owner = find_words(piece, bounds, ~BLANK)
        hashes = rolling.span(rolling.totals(piece), begins, ends)
        if end < starts[last]:
            held.append(hashes)
            continue
        if held:
            hashes, held = np.concatenate([*held, hashes]), []
            owner = np.zeros(len(hashes), np.int64)
        yield first, last, *_tokens(hashes, np.bincount(owner, minlength=last - first), width)


def _tokens(words, counts, width):
    """Offsets and sorted distinct tokens of texts with so many words each."""
    made = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    owner = np.repeat(np.arange(len(counts)), made)
    heads = (np.cumsum(counts) - counts)[owner] + np.arange(len(owner)) - (np.cumsum(made) - made)[owner]
    length = np.minimum(counts, width)[owner]
    value = length.astype(np.uint64)
    for k in range(width):
        word = words[np.minimum(heads + k, max(len(words) - 1, 0))] if len(words) else words
        value = np.where(k < length, mixed(value * np.uint64(0x9FB21C651E98DF25) + word), value)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    if len(value):
        keep = np.concatenate([[True], (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])])
        value, owner = value[keep], owner[keep]
    sizes = np.bincount(owner, minlength=len(counts))
    return np.concatenate([[0], np.cumsum(sizes)]), value


def needed(n, percent):
    """Tokens of n that a linked set must share: at least percent of their union, so of n."""
    return -(-n * percent // 100)


def shared_tokens(n, percent):
    """First tokens that a set of n shares with a linked, different set of as many or more.

    A tenth of the set, so that a passage in common opens nothing; at least SHARED, fewer
    if such small sets can link. ``n`` is an array or a column of numbers.
    """
    smallest = -(-percent // (100 - percent)) if percent < 100 else SHARED
    least = max(1, min(SHARED, needed(max(smallest, 1), percent)))
    if isinstance(n, Column):
        return F.greatest(F.lit(least), F.floor(n / SHARED_PART))
    return np.maximum(least, n // SHARED_PART)


#: Blocks of fewer bytes leave little behind, and are many.
GIVEN_BACK = 1 << 20


def _frequent(docs, text, width):
    """Tokens that many documents hold, counted over all: no more than set size / share."""

    def report(batches):
        for batch in batches:
            for first, last, offsets, tokens in shingle_sets(batch.column(0), width):
                value, count = np.unique(tokens, return_counts=True)
                many = count >= LEAST_REPORTED
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.append(value[many].view(np.int64), 0)), pa.array(np.append(count[many], 0)),
                     pa.array(np.append(np.zeros(many.sum(), np.int64), last - first))],
                    ["token", "n", "docs"],
                )
        give_back(all_kept=True)

    seen = saved(
        docs.select(text).mapInArrow(report, "token long, n long, docs long").groupBy("token").agg(
            F.sum("n").alias("n"), F.sum("docs").alias("docs")
        ),
        "frequent",
    )
    total = seen.agg(F.sum("docs")).first()[0] or 0
    found = seen.where(F.col("n") >= max(LEAST_REPORTED, FREQUENT_SHARE * total)).select("token").toArrow()
    forget(seen)
    return np.sort(found["token"].to_numpy().view(np.uint64))


def _blocks(docs, id, text, width, percent, frequent):
    """Rows of some MB of tokens each: (block, ids, n, k1, k2, size, tokens), lists by document.

    n is a set's size, k1 and k2 its fingerprint, and size how many of the first tokens stand
    in ``tokens`` (64-bit numbers in one binary). Tokens are in order of hash, frequent ones
    last. Two linked sets share at least s of their first n - needed(n) + s tokens, with s
    from ``shared_tokens`` for the smaller of them.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def sets(batches):
        late = shared.value
        for batch in batches:
            for first, last, offsets, tokens in shingle_sets(batch.column(1), width):
                sizes = np.diff(offsets)
                owner = np.repeat(np.arange(last - first), sizes)
                keys = np.zeros((2, last - first), np.int64)
                for k, seed in enumerate((0x5851F42D4C957F2D, 0x14057B7EF767814F)):
                    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(tokens ^ np.uint64(seed)))])
                    keys[k] = (sums[offsets[1:]] - sums[offsets[:-1]]).view(np.int64)
                # A set of n links with another only if n of n + 1 is enough.
                length = np.where(sizes * 100 >= percent * (sizes + 1), np.minimum(sizes, sizes - needed(sizes, percent) + shared_tokens(sizes, percent)), 0)
                at = np.minimum(np.searchsorted(late, tokens), max(len(late) - 1, 0))
                order = np.arange(len(tokens))
                if len(late):
                    order = np.lexsort((late[at] == tokens, owner))
                place = np.arange(len(tokens)) - np.repeat(offsets[:-1], sizes)
                lists = [batch.column(0).slice(first, last - first), *(pa.array(x.astype(np.int64)) for x in (sizes, *keys, length))]
                yield lists, tokens[order][place < length[owner]]

    def block_of(number, held):
        lists = [pa.concat_arrays(column) for column in zip(*(lists for lists, _ in held))]
        edges = pa.array([0, len(lists[0])], pa.int32())
        tokens = np.concatenate([tokens for _, tokens in held])
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), *(pa.ListArray.from_arrays(edges, x) for x in lists), pa.array([tokens.tobytes()], pa.binary())],
            ["block", "ids", "n", "k1", "k2", "size", "tokens"],
        )

    def read(batches):
        block = TaskContext.get().partitionId() << 32
        held, filled = [], 0
        for lists, tokens in sets(batches):
            if held and filled + len(tokens) > DEALT_TOKENS:
                yield block_of(block, held)
                block, held, filled = block + 1, [], 0
            held.append((lists, tokens))
            filled += len(tokens)
        if held:
            yield block_of(block, held)
        give_back(all_kept=True)

    lists = ", ".join(f"{c} array<bigint>" for c in ("ids", "n", "k1", "k2", "size"))
    return docs.select(F.col(id).cast("long").alias("id"), text).mapInArrow(read, f"block long, {lists}, tokens binary")


#: Sorted keys of some documents of a block: the first, the steps from it, and whose they are.
_PACKED = "count long, first long, steps binary, owners binary"


def _packed(keys, owners):
    """Values of the columns ``_PACKED``; numbers are as narrow as they can be."""
    steps = np.diff(keys, prepend=keys[:1])
    steps = steps.astype(np.uint32 if steps.max() < 1 << 32 else np.uint64)
    owners = owners.astype(np.uint16 if owners.max() < 1 << 16 else np.uint32)
    return len(keys), int(keys[0]), steps.tobytes(), owners.tobytes()


def _unpacked(table):
    """(keys, owners) of each row, and how many it has."""
    keys, owners, counts = [], [], []
    for row in table.select(["count", "first", "steps", "owners"]).to_pylist():
        count = row["count"]
        steps = np.frombuffer(row["steps"], np.uint32 if len(row["steps"]) == 4 * count else np.uint64)
        keys.append(row["first"] + np.cumsum(steps.astype(np.int64)))
        owners.append(np.frombuffer(row["owners"], np.uint16 if len(row["owners"]) == 2 * count else np.uint32).astype(np.int64))
        counts.append(count)
    none = [np.zeros(0, np.int64)]
    return np.concatenate(keys or none), np.concatenate(owners or none), np.array(counts, np.int64)


def _keys_by_bucket(buckets):
    """Arrow function: the tokens of each block as sorted keys with their documents, by bucket."""

    def deal(batches):
        for batch in batches:
            for block, size, tokens in zip(*(batch.column(c) for c in ("block", "size", "tokens"))):
                key = (np.frombuffer(tokens.as_buffer(), np.uint64) >> np.uint64(64 - KEY_BITS)).astype(np.int64)
                owner = np.repeat(np.arange(len(size)), size.values.to_numpy())
                order = np.argsort(key, kind="stable")
                key, owner = key[order], owner[order]
                edges = np.searchsorted(key, -(-(np.arange(buckets + 1) << KEY_BITS) // buckets))
                rows = [(int(k), block.as_py(), *_packed(key[edges[k] : edges[k + 1]], owner[edges[k] : edges[k + 1]])) for k in np.flatnonzero(np.diff(edges))]
                yield pa.RecordBatch.from_pylist([dict(zip(_BUCKETED.names, r)) for r in rows], _BUCKETED)
        give_back(all_kept=True)

    return deal


_BUCKETED = pa.schema(
    [("bucket", pa.int64()), ("block", pa.int64()), ("count", pa.int64()), ("first", pa.int64()), ("steps", pa.binary()), ("owners", pa.binary())]
)


def _shared_keys(key, table):
    """Of a bucket's keys those that several documents hold, for each block that has such."""
    keys, owners, counts = _unpacked(table)
    blocks = np.repeat(table.column("block").to_numpy(), counts)
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    chosen = order[np.append(same, False) | np.append(False, same)]
    chosen = chosen[np.lexsort((keys[chosen], blocks[chosen]))]
    keys, owners, blocks = keys[chosen], owners[chosen], blocks[chosen]
    edges = np.append(np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1])) if len(blocks) else [], len(blocks)).astype(np.int64)
    rows = [(int(blocks[a]), *_packed(keys[a:b], owners[a:b])) for a, b in zip(edges[:-1], edges[1:])]
    found = pa.Table.from_pylist([dict(zip(_BUCKETED.names[1:], r)) for r in rows], pa.schema(list(_BUCKETED)[1:]))
    give_back(all_kept=True)
    return found


def _grouped_rows(percent):
    """Cogroup function: a block's shared keys and documents to rows (token, id, n, gid).

    A linked set has at least that percentage of the tokens of the other, and shares what
    that size calls for; documents with fewer shared keys go. A group is named by its members'
    least shared key: what a copy has changed is shared by nobody, so near copies mostly meet
    in one group, and in a few at all. Equal sets have equal rows: only those of the documents
    that name their class go on.
    """

    def settle(key, found, known):
        token, owner, _ = _unpacked(found)
        known = known.sort_by("owner")
        name, n = known.column("owner").to_numpy(), known.column("n").to_numpy()
        place = np.searchsorted(name, owner)
        here = place < len(name)
        here[here] = name[place[here]] == owner[here]
        token, place = token[here], place[here]
        held = np.bincount(place, minlength=len(n))
        enough = shared_tokens((n * percent + 99) // 100, percent)
        least = np.full(len(n), np.iinfo(np.int64).max)
        np.minimum.at(least, place, token)
        place, token = place[held[place] >= enough[place]], token[held[place] >= enough[place]]
        rep = known.column("rep").to_numpy()
        made = pa.table([pa.array(x) for x in (token, rep[place], n[place], least[place])], names=["token", "id", "n", "gid"])
        give_back(all_kept=True)
        return made

    return settle


def _whole(width):
    """Arrow function that puts the whole set in the place of the last column, a text."""

    def read(batches):
        for batch in batches:
            *before, texts = batch.columns
            for first, last, offsets, tokens in shingle_sets(texts, width):
                cells = [tokens[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
                kept = [c.slice(first, last - first) for c in before]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(cells, pa.binary())], [*batch.schema.names[:-1], "tokens"])
        give_back(all_kept=True)

    return read


def local_links(sizes, tokens, percent):
    """Smallest place of each set's component among some sets, all links between them followed.

    ``tokens`` holds the sets one after the other, in order of size. Rare tokens come first
    here, by their own counts; a set is compared with earlier ones of other components that
    share one of its first tokens: first with the sets that linked last, then with some of
    each component, then with the rest of it while none of them linked.
    """
    count = len(sizes)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    owner = np.repeat(np.arange(count), sizes)
    _, code, often = np.unique(tokens, return_inverse=True, return_counts=True)
    code = code[np.lexsort((code, often[code], owner))]
    place = np.arange(len(code)) - offsets[owner]
    first = np.flatnonzero((place < (sizes - needed(sizes, percent) + 1)[owner]) & (often[code] > 1))
    # Per first token the sets that hold it, in order; and where each set's tokens stand there.
    order = np.lexsort((owner[first], code[first]))
    holders, held = owner[first][order], code[first][order]
    heads = np.searchsorted(held, code[first])
    stands = np.empty(len(first), np.int64)
    stands[order] = np.arange(len(first))
    edges = np.searchsorted(owner[first], np.arange(count + 1))
    mark = np.zeros(len(often), bool)
    parent = np.arange(count)
    leaders = []

    def linked(q, others):
        spans = sizes[others]
        ends = np.cumsum(spans)
        at = np.repeat(offsets[others] - (ends - spans), spans) + np.arange(ends[-1])
        both = np.add.reduceat(mark[code[at]].astype(np.int64), ends - spans)
        return others[100 * both >= percent * (sizes[q] + spans - both)]

    for q in range(count):
        spans = [holders[a:b] for a, b in zip(heads[edges[q] : edges[q + 1]], stands[edges[q] : edges[q + 1]]) if b > a]
        if not spans:
            continue
        own = code[offsets[q] : offsets[q + 1]]
        mark[own] = True
        if leaders:
            hit = linked(q, np.array(leaders))
            parent = joined(parent, np.full(len(hit), q), hit)
        others = np.concatenate(spans)
        others = np.unique(others[parent[others] != parent[q]])
        others = others[sizes[others] * 100 >= percent * sizes[q]]
        if len(others):
            groups = parent[others]
            by = np.argsort(groups, kind="stable")
            others, groups = others[by], groups[by]
            starts = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
            rank = np.arange(len(others)) - np.repeat(starts, np.diff(np.append(starts, len(others))))
            early = rank < FIRST_TRIED
            hit = linked(q, others[early])
            rest = others[~early & ~np.isin(groups, parent[hit])]
            if len(rest):
                hit = np.concatenate([hit, linked(q, rest)])
            parent = joined(parent, np.full(len(hit), q), hit)
        mark[own] = False
        if parent[q] != q:
            leaders = [d for d in leaders if parent[d] != parent[q]][: LEADERS - 1] + [q]
    return parent


def jaccard_components(docs, id="doc_id", text="text", width=4, percent=85):
    """Rows (id, n_shingles, component_id) by links of word shingles, none left out.

    A document's set holds the distinct shingles of ``width`` words (runs of characters other
    than space and control characters 9 to 13, A-Z lower-cased); with fewer words the whole
    sequence is the one shingle, and without any the set is empty and links with nothing.
    Sets link when 100 * shared >= percent * union. component_id is the smallest id reached.

    Equal sets form a class and are compared once. Of each set's first tokens in a global
    order (frequent tokens last) only those matter that other documents hold: blocks of
    documents send theirs as sorted keys of 44 bits to buckets of keys, which tell the shared
    ones. Classes with the same least shared token form a group. The matrix of groups and
    tokens has, for each group, the union of its members' shared first tokens, with the sizes
    of their sets. The
    tokens in the unions of two groups bound what any two of their sets can share, and a
    group is opened to the sets of another only if that is enough and sizes allow a link. Opened groups compare sets
    exactly, in blocks of bounded size, every pair of blocks in a task of its own, and give
    one link per set. Tokens and fingerprints are hashes of 64 and 128 bits.

    Null texts count as empty, a null id never is a component's name but where it is alone,
    repeated rows are equal sets. Rows of one id are one document: each has the n_shingles of its
    own text, and all that have words reach each other and have one component_id.
    """
    frequent = _frequent(docs, text, width)
    blocks = saved(_blocks(docs, id, text, width, percent, frequent), "blocks")
    zipped = F.arrays_zip(F.col("ids").alias("id"), "n", "k1", "k2", "size")
    sets = blocks.select("block", F.posexplode(zipped).alias("owner", "s")).select("block", F.col("owner").cast("long").alias("owner"), "s.*")
    classes = saved(sets.where("n > 0").groupBy("k1", "k2").agg(F.min("id").alias("rep")), "fingerprints")
    named = saved(sets.where("n > 0").join(classes, ["k1", "k2"]).select("id", "n", "rep", "size", "block", "owner"), "classes")
    empty = saved(sets.where("n = 0").select("id"), "empty")
    total = named.agg(F.sum("size")).first()[0] or 0
    buckets = total // BUCKET_KEYS + 1
    keys = blocks.select("block", "size", "tokens").mapInArrow(
        _keys_by_bucket(buckets), f"bucket long, block long, {_PACKED}"
    )
    shared = keys.groupBy("bucket").applyInArrow(_shared_keys, f"block long, {_PACKED}")
    able = named.where("size > 0 and id = rep").select("block", "owner", "rep", "n")
    rows = shared.groupBy("block").cogroup(able.groupBy("block")).applyInArrow(
        _grouped_rows(percent), "token long, id long, n long, gid long"
    )
    rows = saved(rows, "common")
    forget(blocks)
    matrix = saved(rows.groupBy("token", "gid").agg(F.min("n").alias("low"), F.max("n").alias("high")), "matrix")
    near = (F.col("a.high") * 100 >= F.col("b.low") * percent) & (F.col("b.high") * 100 >= F.col("a.low") * percent)
    smallest = F.greatest(F.min("a.low"), F.min("b.low"))
    bound = shared_tokens(F.floor((smallest * percent + 99) / 100), percent)
    pairs = (
        matrix.alias("a").join(matrix.alias("b"), (F.col("a.token") == F.col("b.token")) & (F.col("a.gid") < F.col("b.gid")) & near)
        .groupBy(F.col("a.gid").alias("one"), F.col("b.gid").alias("two")).agg(F.count("*").alias("shared"), bound.alias("bound"))
        .where("shared >= bound").select("one", "two")
    )
    members = saved(rows.select("gid", "id", "n").distinct(), "members")
    many = members.groupBy("gid").agg(F.count("*").alias("docs"))
    pairs = pairs.join(many.select(F.col("gid").alias("one"), F.col("docs").alias("n1")), "one").join(
        many.select(F.col("gid").alias("two"), F.col("docs").alias("n2")), "two"
    )
    # The smaller group's sets are the queries of the larger.
    small = F.col("n1") < F.col("n2")
    asked = pairs.select(F.when(small, F.col("one")).otherwise(F.col("two")).alias("gid"), F.when(small, F.col("two")).otherwise(F.col("one")).alias("opens"))
    visits = members.join(asked, "gid").select(F.col("opens").alias("gid"), "id", "n")
    opened = saved(visits.union(members), "visits")
    forget(matrix)
    forget(rows)
    weights = opened.groupBy("gid").agg(F.count("*").alias("members"), F.sum("n").alias("weight")).where("members > 1")
    blocks = (F.floor(F.col("weight") / BLOCK_TOKENS) + 1).cast("int")
    part = F.pmod(F.xxhash64(F.lit("block"), "id"), F.col("blocks")).cast("int")
    placed = opened.join(weights.select("gid", blocks.alias("blocks")), "gid").withColumn("part", part)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = saved(
        placed.withColumn("other", other).select(
            "id", "gid", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b")
        ),
        "placed",
    )
    forget(opened)
    forget(members)
    texts = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    if placed.count() <= SMALL_ROWS:
        texts = texts.join(F.broadcast(placed), "id").select("gid", "a", "b", "id", "text")
        met = texts.mapInArrow(_whole(width), "gid long, a int, b int, id long, tokens binary")
    else:
        texts = texts.join(placed.select("id").distinct(), "id", "left_semi")
        met = placed.join(texts.mapInArrow(_whole(width), "id long, tokens binary"), "id")

    def compare(key, table):
        ids = table.column("id").to_numpy()
        cells = [np.frombuffer(c, np.uint64) for c in table.column("tokens").to_pylist()]
        sizes = np.array([len(c) for c in cells])
        order = np.lexsort((ids, sizes))
        ids, sizes = ids[order], sizes[order]
        parent = local_links(sizes, np.concatenate([cells[i] for i in order]), percent)
        moved = np.flatnonzero(parent != np.arange(len(parent)))
        if table.nbytes > GIVEN_BACK:
            del cells
            give_back(all_kept=True)
        return pa.table([pa.array(ids[moved]), pa.array(ids[parent[moved]])], names=["a", "b"])

    links = met.groupBy("gid", "a", "b").applyInArrow(compare, "a long, b long")
    # Rows of one id with different sets are one document: their classes are linked.
    ids = named.where("id is not null").groupBy("id").agg(F.min("rep").alias("least"), F.max("rep").alias("most"))
    several = saved(ids.where("least <> most").select("id", "least"), "several")
    same_id = named.join(several, "id").select(F.col("rep").alias("a"), F.col("least").alias("b"))
    comps = components(links.union(same_id)).withColumnRenamed("node", "rep")
    for done in (placed, several, classes):
        forget(done)
    found = named.join(comps, "rep", "left").select("id", "n", F.coalesce("component", "rep", "id").alias("component_id"))
    empty = empty.select("id", F.lit(0).cast("long").alias("n"), F.col("id").alias("component_id"))
    return found.union(empty).select(F.col("id").alias(id), F.col("n").alias("n_shingles"), "component_id")
