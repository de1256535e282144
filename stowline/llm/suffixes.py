"""Removal of byte strings that stand in earlier documents, by two-stage suffix sorting."""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from stowline.llm.texts import Rolling, declared, give_back, mixed, slices, unused, utf8

WIDTH = 50
#: Bytes of the anchors that route strings to tasks.
GRAM = 16
#: Text of a group of documents that a task handles together.
GROUP_BYTES = 6 << 20
#: Bits of an anchor that are compared to find anchors of one document; more only pass in error.
KEY_BITS = 40
#: Anchors and text that a bucket holds in the middle, and how many buckets a task takes.
BUCKET_ANCHORS = 1 << 18
BUCKET_BYTES = 2 << 20
TASK_BUCKETS = 8
#: Text that is suffix-sorted at once.
SORT_BYTES = 2 << 20
SLICE_BYTES = 1 << 18
#: An anchor with more text is routed window by window. Groups report its text in powers of 2 times AMOUNT.
HOT_BYTES = SORT_BYTES
AMOUNT = 128
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _gram_hashes(data):
    """Hash of the GRAM bytes from each position on."""
    words = _words(data)
    size = len(data) - GRAM + 1
    low, high = words[:size].astype(np.uint64), words[8 : 8 + size].astype(np.uint64)
    return mixed(low * np.uint64(0x9E3779B97F4A7C15) + (high ^ (high >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F))


def _words(data):
    """The 8 bytes from each position on as a number that sorts like them; data is padded."""
    padded = np.concatenate([data, np.zeros(64, np.uint8)])
    return np.ndarray((len(data) + 56,), ">u8", padded, strides=(1,))


def _sliding_least(values, span):
    have = 1
    while 2 * have <= span:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[: len(values) - (span - have)], values[span - have :]) if span > have else values


def _ranges(begins, sizes):
    """All positions of stretches, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(begins - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def anchored_segments(piece, bounds, width=WIDTH):
    """(first window, windows, anchor) of each stretch of windows with one anchor.

    A window is ``width`` bytes of one text; its anchor is the least hash of the strings of
    16 bytes in it. Equal windows have equal anchors, wherever they stand.
    """
    windows = len(piece) - width + 1
    if windows <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    anchor = _sliding_least(_gram_hashes(piece), width - GRAM + 1)
    whole = np.ones(windows, bool)
    late = (bounds[1:, None] - np.arange(1, width)).ravel()
    whole[late[(late >= 0) & (late < windows)]] = False
    fresh = whole.copy()
    fresh[1:] &= ~whole[:-1] | (anchor[1:] != anchor[:-1])
    first = np.flatnonzero(fresh)
    stop = np.flatnonzero(fresh | ~whole)
    after = np.append(stop, windows)[np.searchsorted(stop, first) + 1]
    return first, after - first, anchor[first]


class _Group:
    """Documents of one group in a fixed order, whatever order they came in."""

    def __init__(self, table, id, text):
        table = table.combine_chunks()
        ids = table.column(id).cast(pa.int64())
        known = np.array(ids.is_valid().to_pylist(), bool)
        docs = ids.fill_null(0).to_numpy()
        order = np.lexsort((docs, ~known))
        if len(np.unique(docs)) < len(docs):
            raw = table.column(text).to_pylist()
            order = np.array(sorted(range(len(docs)), key=lambda i: (not known[i], docs[i], raw[i] or "")), np.int64)
        self.table = table.take(pa.array(order, pa.int64())) if len(order) else table
        self.docs, self.known = docs[order], known[order]
        column = self.table.column(text)
        self.data, self.starts = utf8(column.cast(pa.large_string()) if column.nbytes > 1 << 30 else column)

    def segments(self, width):
        """Per slice (rows, positions, windows, anchors, where they stand, bytes)."""
        for first, last, begin, end in slices(self.data, self.starts, limit=SLICE_BYTES, overlap=width - 1):
            piece = self.data[begin:end]
            bounds = np.clip(self.starts[first : last + 1], begin, end) - begin
            at, run, anchor = anchored_segments(piece, bounds, width)
            owner = np.searchsorted(bounds, at, side="right") - 1
            some = self.known[first:last][owner] if len(at) else np.zeros(0, bool)
            at, run, anchor, owner = at[some], run[some], anchor[some], owner[some]
            if len(at):
                yield owner + first, at + begin - self.starts[first:last][owner], run, anchor, at, piece

    def keys(self, width):
        """Sorted distinct keys of the anchors, which are of several documents here, and their text."""
        found = [(a >> np.uint64(64 - KEY_BITS), r, n + width - 1) for r, _, n, a, _, _ in self.segments(width)]
        if not found:
            return np.zeros(0, np.uint64), np.zeros(0, bool), np.zeros(0, np.int64)
        key, row, amount = (np.concatenate(c) for c in zip(*found))
        order = np.argsort(key, kind="stable")
        key, doc = key[order], self.docs[row[order]]
        heads = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        several = np.minimum.reduceat(doc, heads) != np.maximum.reduceat(doc, heads)
        return key[heads], several, np.add.reduceat(amount[order], heads)


def _by_bucket(key, buckets):
    """Edges of the buckets in sorted keys: each takes an equal range."""
    edges = [(n << KEY_BITS) // buckets for n in range(buckets)]
    return np.append(np.searchsorted(key, np.array(edges, np.uint64)), len(key))


def _list_anchors(id, text, width, buckets):
    """Per group its anchors' keys, by bucket: (bucket, grp, size, blob)."""

    def listed(key, table):
        keys, several, amount = _Group(table, id, text).keys(width)
        power = np.ceil(np.log2(np.maximum(amount / AMOUNT, 1))).astype(np.uint8)
        give_back(all_kept=True)
        edges, rows = _by_bucket(keys, buckets), []
        for bucket in np.flatnonzero(np.diff(edges)):
            own = slice(edges[bucket], edges[bucket + 1])
            low = (int(bucket) << KEY_BITS) // buckets
            steps = np.diff(keys[own], prepend=np.uint64(low))
            kind = np.uint32 if int(steps.max()) < 1 << 32 else np.uint64
            raw = bytes([kind().itemsize]) + np.packbits(several[own]).tobytes() + power[own].tobytes() + steps.astype(kind).tobytes()
            rows.append((int(bucket), key[0].as_py(), int(own.stop - own.start), len(raw), pa.compress(raw, codec="zstd", asbytes=True)))
        return _table(rows, [("bucket", pa.int64()), ("grp", pa.int64()), ("n", pa.int64()), ("size", pa.int64()), ("blob", pa.binary())])

    return listed


def _table(rows, fields):
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.table([pa.array(c, kind) for c, (_, kind) in zip(columns, fields)], names=[n for n, _ in fields])


def _find_shared(buckets):
    """For each group and bucket which of its keys others have too, then which have much text: (grp, bucket, bits)."""

    def one_bucket(bucket, lists):
        low = np.uint64((bucket << KEY_BITS) // buckets)
        keys, several, powers = [], [], []
        for _, n, size, blob in lists:
            raw = pa.decompress(blob, decompressed_size=size, codec="zstd", asbytes=True)
            bits = -(-n // 8)
            several.append(np.unpackbits(np.frombuffer(raw, np.uint8, bits, 1), count=n).astype(bool))
            powers.append(np.frombuffer(raw, np.uint8, n, 1 + bits))
            steps = np.frombuffer(raw, np.uint32 if raw[0] == 4 else np.uint64, n, 1 + bits + n)
            keys.append(np.cumsum(steps, dtype=np.uint64) + low)
        key, shared = np.concatenate(keys), np.concatenate(several)
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        shared[order[1:][same]] = True
        shared[order[:-1][same]] = True
        heads = np.flatnonzero(np.append(True, ~same))
        amount = np.add.reduceat(np.exp2(np.concatenate(powers)[order].astype(np.float64)), heads) * AMOUNT
        hot = np.zeros(len(order), bool)
        hot[order] = np.repeat(amount > HOT_BYTES, np.diff(np.append(heads, len(order))))
        at, rows = 0, []
        for grp, n, _, _ in lists:
            rows.append((grp, bucket, np.packbits(shared[at : at + n]).tobytes() + np.packbits(hot[at : at + n]).tobytes()))
            at += n
        fields = [("grp", pa.int64()), ("bucket", pa.int64()), ("bits", pa.binary())]
        return _table(rows, fields).to_batches()

    def find(batches):
        held = {}
        for batch in batches:
            for bucket, *rest in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault(bucket, []).append(rest)
        for bucket in list(held):
            yield from one_bucket(bucket, held.pop(bucket))
        give_back(all_kept=True)

    return find


def _route(id, text, width, key_buckets, buckets):
    """Per group the segments whose anchor several documents have, by bucket of the anchor.

    Of segments with equal bytes in the group only the earliest document's go on; the others
    are covered. (bucket, grp, size, blob); size -1 marks spans that are covered already.

    Segments of an anchor with much text are taken apart into windows, which go by anchor and
    window: equal windows still meet, and the anchor is spread over all buckets. Windows in a
    row that are equal stay one segment.
    """

    def settled(doc, run, content, begins, body):
        """Which segments, at ``begins`` of ``body``, an earlier document of these has too."""
        sizes = run + width - 1
        order = np.lexsort((doc, run, content))
        same = np.zeros(len(order), bool)
        a, b = order[:-1], order[1:]
        same[1:] = (content[a] == content[b]) & (run[a] == run[b])
        head = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
        later = same & (doc[order] > doc[head])
        mine, theirs = order[later], head[later]
        covered = np.zeros(len(doc), bool)
        for at in range(0, len(mine), 1 << 14):
            x, y = mine[at : at + (1 << 14)], theirs[at : at + (1 << 14)]
            differ = body[_ranges(begins[x], sizes[x])] != body[_ranges(begins[y], sizes[y])]
            heads = np.cumsum(sizes[x]) - sizes[x]
            covered[x[~np.logical_or.reduceat(differ, heads)]] = True
        return covered

    def windows_of(docs, rolling, sums, row, pos, run, anchor, at, piece):
        """The segments of anchors with much text by windows, as entries of ``held``, and spans covered here."""
        place, of = _ranges(at, run), np.repeat(np.arange(len(at)), run)
        value = rolling.span(sums, place, place + width)
        fresh = np.append(True, (value[1:] != value[:-1]) | (of[1:] != of[:-1]))
        first = np.flatnonzero(fresh)
        run = np.diff(np.append(first, len(place)))
        place, of, anchor = place[first], of[first], anchor[of[first]] ^ mixed(value[first])
        row, pos = row[of], pos[of] + place - at[of]
        content = rolling.span(sums, place, place + run + width - 1)
        covered = settled(docs[row], run, content, place, piece)
        rest = np.flatnonzero(~covered)
        body = [piece[_ranges(place[x], run[x] + width - 1)] for x in np.split(rest, range(1 << 14, len(rest), 1 << 14))]
        spans = np.stack([row[covered], pos[covered], pos[covered] + run[covered] + width - 1]).astype(np.int64)
        return (row[rest], pos[rest], run[rest], anchor[rest], content[rest], np.concatenate(body)), spans

    def joined(spans):
        """Spans (row, begin, end) with those that touch or overlap made one."""
        row, begin, end = spans[:, np.lexsort((spans[1], spans[0]))]
        step = int(end.max()) + 1
        reach = np.maximum.accumulate(row * step + end)
        heads = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (row[1:] * step + begin[1:] > reach[:-1])))
        tails = np.append(heads[1:], len(row)) - 1
        return np.stack([row[heads], begin[heads], reach[tails] - row[heads] * step])

    def gather(grp, docs, held, spans):
        row, pos, run, anchor, content = (np.concatenate(c) for c in list(zip(*held))[:5])
        body = np.concatenate([h[5] for h in held])
        doc = docs[row]
        sizes = run + width - 1
        begins = np.cumsum(sizes) - sizes
        covered = settled(doc, run, content, begins, body)
        bucket = (mixed(anchor + np.uint64(1)) % np.uint64(buckets)).astype(np.int64)
        rows = []
        at = np.flatnonzero(covered)
        spans = np.concatenate([*spans, np.stack([row[at], pos[at], pos[at] + sizes[at]]).astype(np.int64)], axis=1)
        if spans.shape[1]:
            rows.append((grp % buckets, grp, -1, joined(spans).tobytes()))
        kept = np.flatnonzero(~covered)
        kept = kept[np.argsort(bucket[kept], kind="stable")]
        edges = np.flatnonzero(np.append(True, bucket[kept][1:] != bucket[kept][:-1])) if len(kept) else []
        for x, y in zip(edges, [*edges[1:], len(kept)]):
            own = kept[x:y]
            raw = b"".join([
                np.int64(len(own)).tobytes(), np.diff(doc[own], prepend=0).tobytes(), np.diff(row[own], prepend=0).astype(np.int32).tobytes(),
                pos[own].astype(np.int32).tobytes(), run[own].astype(np.int32).tobytes(), body[_ranges(begins[own], sizes[own])].tobytes(),
            ])
            rows.append((int(bucket[own[0]]), grp, len(raw), pa.Codec("zstd", compression_level=3).compress(raw, asbytes=True)))
        return rows

    def route(key, table, bits):
        group, held, spans = _Group(table, id, text), [], []
        keys, *_ = group.keys(width)
        edges = _by_bucket(keys, key_buckets)
        shared, hot = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
        for bucket, raw in zip(bits.column("bucket").to_pylist(), bits.column("bits").to_pylist()):
            own = slice(edges[bucket], edges[bucket + 1])
            raw = np.frombuffer(raw, np.uint8).reshape(2, -1)
            shared[own], hot[own] = np.unpackbits(raw, axis=1, count=own.stop - own.start)
        wanted, hot, rolling = keys[shared], hot[shared], Rolling()
        if len(wanted):
            for row, pos, run, anchor, at, piece in group.segments(width):
                short = anchor >> np.uint64(64 - KEY_BITS)
                place = np.minimum(np.searchsorted(wanted, short), len(wanted) - 1)
                known = wanted[place] == short
                sums = rolling.totals(piece) if known.any() else None
                some = np.flatnonzero(known & hot[place])
                if len(some):
                    parts, over = windows_of(group.docs, rolling, sums, row[some], pos[some], run[some], anchor[some], at[some], piece)
                    held.append(parts)
                    spans.append(over)
                some = np.flatnonzero(known & ~hot[place])
                if len(some):
                    at, run = at[some], run[some]
                    content = rolling.span(sums, at, at + run + width - 1)
                    held.append((row[some], pos[some], run, anchor[some], content, piece[_ranges(at, run + width - 1)]))
        rows = gather(key[0].as_py(), group.docs, held, spans) if held else []
        del group, held
        give_back(all_kept=True)
        return _table(rows, [("bucket", pa.int64()), ("grp", pa.int64()), ("size", pa.int64()), ("blob", pa.binary())])

    return route


def two_stage_order(text, begins, windows, width=WIDTH):
    """Starts of all windows of some segments, in order of their first ``width`` bytes.

    A segment is ``windows`` windows, one per byte, and the rest of the last one. Suffixes
    smaller than their successor are sorted directly, by their bytes. A suffix larger than
    its successor follows from it: with the buckets of first bytes scanned upwards, each
    sorted suffix puts the one before it behind those its bucket has so far. Where a segment
    ends, and in runs of one byte as long as a window, a suffix counts as smaller.
    """
    size = len(text)
    ends = begins + windows + width - 1
    change = np.ones(size, bool)
    change[:-1] = text[:-1] != text[1:]
    change[ends - 1] = True
    place = np.arange(size)
    last = np.minimum.accumulate(np.where(change, place, size)[::-1])[::-1]  # of the run of one byte
    closing = np.zeros(size, bool)
    closing[ends - 1] = True
    larger = ~closing[last] & (last - place < width - 1)
    larger &= text[np.minimum(last + 1, size - 1)] < text
    smaller_at = np.minimum.accumulate(np.where(larger, size, place)[::-1])[::-1]
    window = np.zeros(size, bool)
    window[_ranges(begins, windows)] = True
    # Beyond the windows, as far as they follow from others.
    reach = smaller_at[begins + windows - 1] - begins + 1
    wanted = np.zeros(size, bool)
    wanted[_ranges(begins, np.maximum(reach, windows))] = True
    follows = larger & wanted
    words = _words(text)
    direct = _sorted_directly(words, np.flatnonzero(wanted & ~larger), width)
    heads = np.searchsorted(text[direct], np.arange(257))
    arrived = [[] for _ in range(256)]
    result = []
    for byte in range(256):
        found = arrived[byte]
        here = np.concatenate(found) if found else np.zeros(0, np.int64)
        part = [here]
        while len(here):
            here = here - 1
            here = here[follows[here] & (text[here] == byte)]
            part.append(here)
        part.append(direct[heads[byte] : heads[byte + 1]])
        part = np.concatenate(part)
        arrived[byte] = None
        if not len(part):
            continue
        result.append(part)
        before = part - 1
        before = before[follows[before] & (text[before] > byte)]
        if len(before):
            first = text[before]
            before = before[np.argsort(first, kind="stable")]
            edges = np.cumsum(np.bincount(first, minlength=256))
            for other in np.flatnonzero(np.diff(edges, prepend=0)):
                arrived[other].append(before[(edges[other - 1] if other else 0) : edges[other]])
    order = np.concatenate(result) if result else np.zeros(0, np.int64)
    return order[window[order]]


def _sorted_directly(words, places, width):
    """Places sorted by the ``width`` bytes there: 8 bytes at a time, and only where still equal."""
    order = places[np.argsort(words[places].astype(np.uint64))]
    value = words[order].astype(np.uint64)
    tied = np.zeros(len(order) + 1, bool)
    tied[1:-1] = value[1:] == value[:-1]
    for step in range(8, width, 8):
        open_ = np.flatnonzero(tied[1:] | tied[:-1])
        if not len(open_):
            break
        group = np.cumsum(~tied[:-1])[open_]
        value = words[order[open_] + step].astype(np.uint64)
        by = np.lexsort((value, group))
        order[open_] = order[open_][by]
        value = value[by]
        same = np.zeros(len(open_), bool)
        same[1:] = (value[1:] == value[:-1]) & (group[1:] == group[:-1])
        tied[open_] = same
    return order


def equal_to_next(text, order, width=WIDTH):
    """For windows in order, whether each has its first ``width`` bytes in common with the next."""
    words = _words(text)
    same = np.arange(len(order) - 1)
    for step in range(0, width, 8):
        a, b = words[order[same] + step].astype(np.uint64), words[order[same + 1] + step].astype(np.uint64)
        if step + 8 > width:
            drop = np.uint64(8 * (step + 8 - width))
            a, b = a >> drop, b >> drop
        same = same[a == b]
    equal = np.zeros(max(len(order) - 1, 0), bool)
    equal[same] = True
    return equal


def covered_windows(doc, run, text, width=WIDTH):
    """For each window of some segments whether an earlier document holds the same bytes."""
    begins = np.cumsum(run + width - 1) - (run + width - 1)
    order = two_stage_order(text, begins, run, width)
    owner = np.zeros(len(text), np.int32)
    owner[begins[1:]] = 1
    owner = np.cumsum(owner)
    docs = doc[owner[order]]
    group = np.cumsum(np.concatenate([[0], ~equal_to_next(text, order, width)])) if len(order) else order
    least = np.full(int(group[-1]) + 1 if len(group) else 0, np.iinfo(np.int64).max)
    np.minimum.at(least, group, docs)
    covered = np.zeros(len(text), bool)
    covered[order[docs > least[group]]] = True
    return covered[_ranges(begins, run)]


def _resolve(width):
    """Spans (grp, row, begin, end) that earlier documents cover, bucket by bucket."""

    def spans_of(grp, row, begin, end):
        columns = [pa.array(np.asarray(c, np.int64)) for c in (grp, row, begin, end)]
        return pa.RecordBatch.from_arrays(columns, ["grp", "row", "begin", "end"])

    def covered_spans(doc, grp, row, pos, run, text):
        covered = covered_windows(doc, run, text, width)
        heads = np.cumsum(run) - run
        first = covered.copy()
        first[1:] &= ~covered[:-1]
        first[heads] = covered[heads]
        stop = ~covered
        stop[heads] = True
        at, stop = np.flatnonzero(first), np.append(np.flatnonzero(stop), len(covered))
        after = stop[np.searchsorted(stop, at, side="right")]
        owner = np.searchsorted(heads, at, side="right") - 1
        begin = pos[owner] + at - heads[owner]
        return spans_of(grp[owner], row[owner], begin, begin + (after - at) + width - 1)

    def one_bucket(blobs):
        parts = []
        for grp, size, blob in blobs:
            raw = pa.decompress(blob, decompressed_size=size, codec="zstd", asbytes=True)
            n = int(np.frombuffer(raw, np.int64, 1)[0])
            row, pos, run = np.frombuffer(raw, np.int32, 3 * n, 8 + 8 * n).astype(np.int64).reshape(3, n)
            doc = np.cumsum(np.frombuffer(raw, np.int64, n, 8))
            parts.append((doc, np.full(n, grp), np.cumsum(row), pos, run, np.frombuffer(raw, np.uint8, -1, 8 + 20 * n)))
        anchors = []
        for *_, run, text in parts:
            sizes = run + width - 1
            begins = np.cumsum(sizes) - sizes
            hashes = np.append(_gram_hashes(text), np.full(GRAM - 1, _NONE))
            hashes[(begins + sizes)[:, None] - np.arange(1, GRAM)] = _NONE
            anchors.append(np.minimum.reduceat(hashes, begins))
        anchor = np.concatenate(anchors)
        doc, grp, row, pos, run = (np.concatenate([p[k] for p in parts]) for k in range(5))
        text = np.concatenate([p[5] for p in parts])
        del parts, anchors
        sizes = run + width - 1
        begins = np.cumsum(sizes) - sizes
        # Strings of an anchor that only one document holds are covered by none.
        order = np.lexsort((doc, anchor))
        heads = np.flatnonzero(np.append(True, anchor[order][1:] != anchor[order][:-1]))
        tails = np.append(heads[1:], len(order)) - 1
        several = doc[order[heads]] != doc[order[tails]]
        amounts = np.add.reduceat(sizes[order], heads)
        block, weight = [], 0
        for head, tail, amount in zip(heads[several].tolist(), tails[several].tolist(), amounts[several].tolist()):
            if amount > SORT_BYTES:
                yield from split_anchor(doc, grp, row, pos, run, text, begins, order[head : tail + 1])
                continue
            block.append(order[head : tail + 1])
            weight += amount
            if weight >= SORT_BYTES:
                own = np.concatenate(block)
                yield covered_spans(doc[own], grp[own], row[own], pos[own], run[own], text[_ranges(begins[own], sizes[own])])
                block, weight = [], 0
        if block:
            own = np.concatenate(block)
            yield covered_spans(doc[own], grp[own], row[own], pos[own], run[own], text[_ranges(begins[own], sizes[own])])

    def split_anchor(doc, grp, row, pos, run, text, begins, own):
        """An anchor with more text than is sorted at once: its windows one by one, in parts by hash."""
        windows = int(run[own].sum())
        parts = windows * width // SORT_BYTES + 1
        rolling, numbers = Rolling(), []
        for at in range(0, len(own), 1 << 14):
            some = own[at : at + (1 << 14)]
            local = text[_ranges(begins[some], run[some] + width - 1)]
            starts = _ranges(np.cumsum(run[some] + width - 1) - (run[some] + width - 1), run[some])
            hashes = rolling.span(rolling.totals(local), starts, starts + width)
            numbers.append((hashes % np.uint64(parts)).astype(np.int32))
        numbers = np.concatenate(numbers)
        by_part = np.argsort(numbers, kind="stable")
        edges = np.searchsorted(numbers[by_part], np.arange(parts + 1))
        owners, all_places = np.repeat(own, run[own]), _ranges(begins[own], run[own])
        for first, last in zip(edges[:-1], edges[1:]):
            owner, places = owners[by_part[first:last]], all_places[by_part[first:last]]
            ones = np.ones(len(owner), np.int64)
            if len(owner):
                yield covered_spans(
                    doc[owner], grp[owner], row[owner], pos[owner] + places - begins[owner], ones, text[_ranges(places, ones * width)]
                )

    def resolve(batches):
        held = {}
        for batch in batches:
            for bucket, grp, size, blob in zip(*(c.to_pylist() for c in batch.columns)):
                if size < 0:
                    row, begin, end = np.frombuffer(blob, np.int64).reshape(3, -1)
                    yield spans_of(np.full(len(row), grp), row, begin, end)
                else:
                    held.setdefault(bucket, []).append((grp, size, blob))
        for bucket in list(held):
            yield from one_bucket(held.pop(bucket))
        give_back(all_kept=True)

    return resolve


def merged(spans, size):
    """Begins and ends of a text's spans, sorted, joined where they touch, and within its size."""
    if not len(spans):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin, end = np.clip(spans, 0, size).T
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    fresh = np.append(True, begin[1:] > reach[:-1])
    heads = np.flatnonzero(fresh)
    return begin[heads], reach[np.append(heads[1:], len(reach)) - 1]


#: Columns that ``remove_repeats`` adds, and their types.
ADDED = {"n_bytes": "long", "n_removed": "long", "n_spans": "long", "kept": "binary", "kept_sha256": "string"}


def remove_repeats(docs, id="doc_id", text="text", width=WIDTH, keep=None, whole_characters=False, names=tuple(ADDED)):
    """Every row with n_bytes, n_removed, n_spans, kept (bytes) and kept_sha256 more.

    ``names`` are the five columns' names; a column of ``docs`` that has one of them is replaced.

    Each byte covered by a ``width``-byte string that also starts in a document of smaller id
    goes; strings are judged on the texts as they came. A null text has no bytes; a null id
    is no document's smaller or larger, so its text stays; repeated rows of one id are one
    document. ``keep`` names the columns to return, of the rows' own and of kept. With
    ``whole_characters`` a span grows to the characters it cuts, so that kept is UTF-8.

    Documents are dealt into groups of some 6 MB, by one shuffle that three steps read.
    (1) Groups list their anchors (see ``anchored_segments``); an anchor of one document
    alone holds no string of another. (2) The stretches with the other anchors, some of the
    text, go to their anchor's bucket, where the windows are suffix-sorted and windows with
    equal neighbours found (``two_stage_order``, ``equal_to_next``). Equal strings in one
    group are settled before. (3) Groups cut their texts. Buckets are worked off one by one.
    Groups also report each anchor's text; one with more than 2 MB in all goes to all buckets,
    window by window. So a bucket's text does not grow with a frequent anchor, only with the
    groups (of some 6 MB) that hold one and the same window.
    """
    if width <= GRAM:
        raise ValueError(f"strings must be longer than {GRAM} bytes")
    added = dict(zip(names, ADDED.values()))
    docs = docs.drop(*added)
    always = [name for name, kind in added.items() if kind != "binary"]
    wanted = [c for c in (*docs.columns, *added) if keep is None or c in keep or c in always]
    own = [c for c in docs.columns if c in wanted or c in (id, text)]
    total, rows = docs.agg(F.sum(F.octet_length(text)), F.count("*")).first()
    total = total or 0
    groups = max(total // GROUP_BYTES, rows // (1 << 16)) + 1
    # A segment has some (width - 14) / 2 windows; about half of them may go on.
    segments = total / ((width - GRAM + 2) / 2)
    key_buckets = int(segments // BUCKET_ANCHORS) + 1
    buckets = int((total + segments * width) / 2 // BUCKET_BYTES) + 1
    grp = unused(docs.columns, "_group")
    dealt = docs.select(*own, F.pmod(F.xxhash64(id, text), F.lit(groups)).alias(grp)).groupBy(grp)

    keys = dealt.applyInArrow(_list_anchors(id, text, width, key_buckets), "bucket long, grp long, n long, size long, blob binary")
    keys = keys.repartition(-(-key_buckets // TASK_BUCKETS), "bucket")
    shared = keys.mapInArrow(_find_shared(key_buckets), "grp long, bucket long, bits binary")
    routed = dealt.cogroup(shared.groupBy("grp")).applyInArrow(
        _route(id, text, width, key_buckets, buckets), "bucket long, grp long, size long, blob binary"
    )
    routed = routed.repartition(-(-buckets // TASK_BUCKETS), "bucket")
    spans = routed.mapInArrow(_resolve(width), "grp long, row long, begin long, end long")
    schema = ", ".join(declared(docs.schema[c]) if c in docs.columns else f"`{c}` {added[c]}" for c in wanted)
    kinds = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}

    def cut(key, table, found):
        group = _Group(table, id, text)
        order = np.lexsort((found.column("begin").to_numpy(), found.column("row").to_numpy()))
        row = found.column("row").to_numpy()[order]
        pairs = np.stack([found.column(c).to_numpy()[order] for c in ("begin", "end")], 1)
        edges = np.searchsorted(row, np.arange(len(group.docs) + 1))
        out = {c: [] for c in added}
        for n in range(len(group.docs)):
            raw = group.data[group.starts[n] : group.starts[n + 1]]
            first, last = merged(pairs[edges[n] : edges[n + 1]], len(raw))
            if whole_characters and len(first):
                inner = np.append((raw & 0xC0) == 0x80, False)
                place = np.arange(len(inner))
                lead = np.maximum.accumulate(np.where(inner, 0, place))
                tail = np.minimum.accumulate(np.where(inner, len(raw), place)[::-1])[::-1]
                first, last = merged(np.stack([lead[first], tail[last]], 1), len(raw))
            bounds = np.concatenate([[0], np.stack([first, last], 1).ravel(), [len(raw)]])
            kept = b"".join(raw[a:b].tobytes() for a, b in zip(bounds[::2], bounds[1::2]))
            values = (len(raw), int((last - first).sum()), len(first), kept, hashlib.sha256(kept).hexdigest())
            for name, value in zip(added, values):
                out[name].append(value)
        columns = [group.table.column(c) if c in own else pa.array(out[c], kinds[added[c]]) for c in wanted]
        return pa.table(columns, names=wanted)

    return dealt.cogroup(spans.groupBy("grp")).applyInArrow(cut, schema)
