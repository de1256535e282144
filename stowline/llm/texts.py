"""Texts of an Arrow batch as one byte array, cut into slices of bounded memory."""

import ctypes
import sys
import types

import numpy as np
import pyarrow as pa

#: An odd base for polynomial hashes modulo 2^64, and the multiplier that spreads byte values.
BASE = np.uint64(0x9E3779B97F4A7C15)
SPREAD = np.uint64(0xD6E8FEB86659FD93)


def kept(key, make):
    """What ``make()`` returns; made once in a Python worker and kept for its later tasks.

    Functions travel to workers by value, so a module's variables would start anew in each task.
    """
    holder = sys.modules.setdefault("stowline_kept", types.ModuleType("stowline_kept"))
    if key not in holder.__dict__:
        holder.__dict__[key] = make()
    return holder.__dict__[key]


def give_back(all_kept=False):
    """Return freed memory to the system: Python workers live on, idle or in other stages.

    With ``all_kept`` also what ``kept`` holds, for stages that need the room and none of it.
    """
    if all_kept:
        sys.modules.pop("stowline_kept", None)
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def declared(field):
    """A column's name and type as text for a schema."""
    return f"`{field.name.replace('`', '``')}` {field.dataType.simpleString()}"


def unused(columns, name):
    """``name``, with underscores put before it until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def utf8(column):
    """(bytes of all texts one after the other, where each starts, with the end as last entry).

    Null counts as an empty text.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64 if wide else np.int32) if offsets else np.zeros(1, int)
    starts = starts[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if not len(starts):
        starts = np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[starts[0] : starts[-1]], starts - starts[0]


def slices(data, starts, limit=1 << 21, overlap=0, breaks=None):
    """Cut texts into slices: (first text, last text + 1, first byte, last byte + 1).

    A slice holds whole texts of about ``limit`` bytes together, or a part of one longer
    text. Parts of a text overlap by ``overlap`` bytes; with ``breaks`` (256 booleans) a
    part ends behind a byte of that kind, and grows until there is one.
    """
    first, texts = 0, len(starts) - 1
    while first < texts:
        last = int(np.searchsorted(starts, starts[first] + limit, side="right")) - 1
        if last > first:
            yield first, last, int(starts[first]), int(starts[last])
            first = last
            continue
        begin, stop = int(starts[first]), int(starts[first + 1])
        while True:
            end, step = min(begin + limit, stop), limit
            while breaks is not None and end < stop:
                found = np.flatnonzero(breaks[data[begin:end]])
                if len(found):
                    end = begin + int(found[-1]) + 1
                    break
                step *= 2
                end = min(begin + step, stop)
            yield first, first + 1, begin, end
            if end >= stop:
                break
            begin = end - overlap
        first += 1


class Rolling:
    """Hashes of any stretch of values in constant time: polynomials modulo 2^64."""

    def __init__(self):
        self.powers = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n):
        if n <= len(self.powers):
            return
        size = max(n, 1 << 16)
        back = pow(int(BASE), -1, 1 << 64)
        self.powers = np.cumprod(np.full(size, BASE, np.uint64)) * np.uint64(pow(int(BASE), -1, 1 << 64))
        self.inverse = np.cumprod(np.full(size, back, np.uint64)) * BASE

    def totals(self, values):
        """Running sums that ``span`` takes stretches from."""
        n = len(values)
        self._grow(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        spread = (values.astype(np.uint64) + np.uint64(1)) * SPREAD
        spread ^= spread >> np.uint64(29)
        spread *= self.powers[:n]
        np.cumsum(spread, out=sums[1:])
        return sums

    def span(self, sums, begin, end):
        return mixed((sums[end] - sums[begin]) * self.inverse[begin] + (end - begin).astype(np.uint64))


def mixed(values):
    """Spread 64-bit values evenly; a bijection."""
    values = values ^ (values >> np.uint64(32))
    values = values * SPREAD
    values = values ^ (values >> np.uint64(29))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(32))


#: Bytes between words: space and the control characters 9 to 13.
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
#: Bytes with A-Z as small letters.
SMALL = np.arange(256, dtype=np.uint8)
SMALL[65:91] += 32


def find_words(piece, bounds, inside):
    """(first byte, last byte + 1, text) of each word of a slice; ``inside``: which bytes words hold.

    ``bounds`` are where the slice's texts start, with its end; words never cross them.
    """
    held = np.zeros(len(piece) + 1, bool)
    held[:-1] = inside[piece]
    fresh = held[:-1].copy()
    fresh[1:] &= ~held[:-2]
    edges = bounds[:-1][bounds[:-1] < len(piece)]
    fresh[edges] = held[edges]
    begins = np.flatnonzero(fresh)
    stop = ~held
    stop[:-1] |= fresh
    stops = np.flatnonzero(stop)
    ends = stops[np.searchsorted(stops, begins, side="right")]
    return begins, ends, np.searchsorted(bounds, begins, side="right") - 1
