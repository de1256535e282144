"""Token counts by a compiled transducer, for BPE vocabularies with word ends."""

import heapq
import json
import unicodedata

import numpy as np
import pyarrow as pa

from stowline.llm.texts import Rolling, kept, utf8

# Character classes of the splitting automaton. An apostrophe, and the letters that follow it
# in contractions ('s 't 'm 'd, 're, 've, 'll), have classes of their own.
SPACE, DIGIT, OTHER, QUOTE, LETTER, SHORT, R, V, E, L, MARK = range(11)
# States: nothing open; in a run of letters; in a run of other characters; behind an
# apostrophe that opens a token; behind it and an r, v or l.
CLOSED, WORD, RUN, OPENED, QUOTE_R, QUOTE_V, QUOTE_L = range(7)
STATES, CLASSES = 7, 11
#: What the automaton and ``_prepared`` stand for; files with other steps are refused.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
#: Output of a step: a token starts at this character, or started at the one before.
STARTS, STARTED = 1, 2
#: White space as Unicode's property has it.
SPACES = "\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
MARKER = "\ud800"
CHUNK = 64
SLICE_CHARS = 1 << 20
CACHE_WORDS = 1_000_000
SHORT_WORD = 40
#: Above any rank.
NEVER = 1 << 30


def _automaton():
    """step[state, class] and output[state, class]."""
    step, output = np.zeros((STATES, CLASSES), np.uint8), np.zeros((STATES, CLASSES), np.uint8)
    letters = (LETTER, SHORT, R, V, E, L)
    for state in range(STATES):
        for kind in range(CLASSES):
            late = STARTED if state >= QUOTE_R else 0
            inside = state == WORD or late
            if kind == SPACE:
                step[state, kind], output[state, kind] = CLOSED, late
            elif kind in (DIGIT, MARK):
                step[state, kind], output[state, kind] = CLOSED, STARTS | late
            elif kind in (OTHER, QUOTE):
                runs = state in (RUN, OPENED)
                step[state, kind] = RUN if runs or kind == OTHER else OPENED
                output[state, kind] = (0 if runs else STARTS) | late
            elif state == OPENED and kind == SHORT:
                step[state, kind] = CLOSED
            elif state == OPENED and kind in (R, V, L):
                step[state, kind] = {R: QUOTE_R, V: QUOTE_V, L: QUOTE_L}[kind]
            elif (state in (QUOTE_R, QUOTE_V) and kind == E) or (state == QUOTE_L and kind == L):
                step[state, kind] = CLOSED
            else:
                assert kind in letters
                step[state, kind], output[state, kind] = WORD, late if inside else STARTS
    return step, output


def _tables():
    """Class and lower case of every code point."""
    kinds, lower = np.full(0x110000, OTHER, np.uint8), np.arange(0x110000, dtype=np.uint32)
    for point in range(0x110000):
        char = chr(point)
        category = unicodedata.category(char)
        if category[0] == "L":
            kinds[point] = LETTER
            small = char.lower()
            if len(small) == 1:
                lower[point] = ord(small)
        elif category[0] == "N":
            kinds[point] = DIGIT
            lower[point] = ord(char.lower())
        elif category == "So":
            lower[point] = ord(char.lower())
    for chars, kind in ((SPACES, SPACE), ("'", QUOTE), ("stmd", SHORT), ("r", R), ("v", V), ("e", E), ("l", L), (MARKER, MARK)):
        for char in chars:
            kinds[ord(char)] = kind
    return kinds, lower


def scan_states(step, kinds, start=CLOSED):
    """State before each position, by a parallel prefix scan over maps of chunks.

    The text is cut into chunks of 64 characters. All chunks are stepped together from every
    state, which gives each chunk's map of states; maps compose by doubling distances, and
    with the state known where each chunk starts, all chunks are stepped once more.
    """
    size = len(kinds)
    chunks = -(-size // CHUNK)
    grid = np.zeros((CHUNK, chunks), np.uint8)
    padded = np.zeros(chunks * CHUNK, np.uint8)
    padded[:size] = kinds
    grid[:] = padded.reshape(chunks, CHUNK).T
    flat = np.ascontiguousarray(step.T).ravel()  # by class, then state
    offsets = grid.astype(np.uint8) * np.uint8(STATES)
    maps = np.repeat(np.arange(STATES, dtype=np.uint8)[:, None], chunks, axis=1)
    for k in range(CHUNK):
        maps = flat[offsets[k] + maps]
    # Maps of all chunks up to each: what follows is applied to what comes before.
    distance, index = 1, np.arange(chunks)
    while distance < chunks:
        later = maps[:, distance:]
        maps = np.concatenate([maps[:, :distance], later[maps[:, :-distance], index[: chunks - distance]]], axis=1)
        distance *= 2
    state = np.full(chunks, start, np.uint8)
    state[1:] = maps[start, :-1]
    states = np.empty((CHUNK, chunks), np.uint8)
    for k in range(CHUNK):
        states[k] = state
        state = flat[offsets[k] + state]
    return states.T.ravel()[:size]


class Counter:
    """Counts of tokens per text for one vocabulary file.

    Splitting runs on the automaton above, which stands for one normalizer and one
    pre_tokenizer; a file with others is refused. Only splitting is compiled: merges within a
    word go by rank over the whole word, so tokens of a word are counted by merging when it
    first comes, and the number is kept for the word. Up to a million words are kept at a time.
    """

    def __init__(self, path):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or not model["end_of_word_suffix"] or model["unk_token"] is not None:
            raise ValueError(f"not a BPE vocabulary with word ends: {path}")
        if spec["normalizer"] != NORMALIZER or spec["pre_tokenizer"] != PRE_TOKENIZER:
            raise ValueError(f"another normalizer or pre_tokenizer than the splitting automaton stands for: {path}")
        self.end = model["end_of_word_suffix"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.step, self.output = _automaton()
        self.kinds, self.lower = _tables()
        self.rolling = Rolling()
        self.known = {}
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown, extra = {b: chr(b) for b in printable}, 0
        for byte in range(256):
            if byte not in shown:
                shown[byte] = chr(256 + extra)
                extra += 1
        self.shown = [shown[b] for b in range(256)]
        vocab = model["vocab"]
        self.inner = np.array([vocab[s] for s in self.shown], np.int32)
        self.last = np.array([vocab[s + self.end] for s in self.shown], np.int32)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.pairs, self.pair_ranks = keys[order], order

    def words(self, points, starts, ends):
        """Tokens that words emit: merges by rank, leftmost first, in all words at once.

        ``points`` holds lower-case characters, a word stands from ``starts`` to ``ends``.
        Every round makes one merge per word and looks up the pairs beside it.
        """
        joined = np.concatenate([points[a:b] for a, b in zip(starts.tolist(), ends.tolist())])
        text = joined.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
        width = 1 + (joined > 0x7F).astype(np.int64) + (joined > 0x7FF) + (joined > 0xFFFF)
        chars = ends - starts
        sizes = np.add.reduceat(width, np.cumsum(chars) - chars)
        counts = sizes.copy()
        bounds = np.cumsum(sizes) - sizes
        values = np.frombuffer(text, np.uint8)
        for i in np.flatnonzero(sizes > SHORT_WORD).tolist():
            own = [self.shown[b] for b in text[bounds[i] : bounds[i] + sizes[i]]]
            own[-1] += self.end
            counts[i] = len(self._long_word(own))
        symbols = self.inner[values]
        symbols[bounds + sizes - 1] = self.last[values[bounds + sizes - 1]]
        word = np.repeat(np.arange(len(sizes)), sizes)
        keep = sizes[word] <= SHORT_WORD
        symbols, word = symbols[keep], word[keep]
        ranks = np.full(len(symbols), NEVER, np.int64)
        ranks[:-1] = np.where(word[1:] == word[:-1], self._ranks(symbols[:-1], symbols[1:]), NEVER)
        while len(symbols):
            heads = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            place = np.arange(len(symbols))
            best = np.minimum.reduceat(ranks * np.int64(1 << 32) + place, heads)
            going = best < (np.int64(NEVER) << 32)
            at = best[going] & np.int64((1 << 32) - 1)
            if not len(at):
                break
            counts[word[at]] -= 1
            symbols[at] = self.merged[ranks[at]]
            keep = np.repeat(going, np.diff(np.append(heads, len(symbols))))
            keep[at + 1] = False
            at = (np.cumsum(keep) - 1)[at]
            symbols, word, ranks = symbols[keep], word[keep], ranks[keep]
            for left in (at, at[at > 0] - 1):
                right = np.minimum(left + 1, len(symbols) - 1)
                same = (word[left] == word[right]) & (left < right)
                ranks[left] = np.where(same, self._ranks(symbols[left], symbols[right]), NEVER)
        return counts

    def _ranks(self, left, right):
        keys = (left.astype(np.int64) << 32) | right
        at = np.searchsorted(self.pairs, keys)
        at[at == len(self.pairs)] = 0
        return np.where(self.pairs[at] == keys, self.pair_ranks[at], NEVER)

    def _long_word(self, parts):
        """The same merges over a heap of pairs, for words of any length."""
        size = len(parts)
        ranks = self.ranks
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = [(ranks[p], i, p) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            if parts[i] is None:
                continue
            j = after[i]
            if j >= size or (parts[i], parts[j]) != pair:
                continue
            parts[i], parts[j] = parts[i] + parts[j], None
            k = after[i] = after[j]
            if k < size:
                before[k] = i
                pair = (parts[i], parts[k])
                if pair in ranks:
                    heapq.heappush(heap, (ranks[pair], i, pair))
            h = before[i]
            if h >= 0:
                pair = (parts[h], parts[i])
                if pair in ranks:
                    heapq.heappush(heap, (ranks[pair], h, pair))
        return [p for p in parts if p is not None]

    def _prepared(self, text):
        for special in self.special:
            if special in text:
                text = text.replace(special, MARKER)
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            if "\u0130" in text:
                text = text.replace("\u0130", "i\u0307")
        return text

    def count(self, texts):
        """Number of tokens of each text of a list; null counts as empty."""
        result = np.zeros(len(texts), np.int64)
        held, owners, size = [], [], 0
        for index, text in enumerate(texts):
            for piece in self._pieces(self._prepared(text or "")):
                held.append(piece)
                owners.append(index)
                size += len(piece) + 1
                if size >= SLICE_CHARS:
                    self._count(held, owners, result)
                    held, owners, size = [], [], 0
        self._count(held, owners, result)
        return result

    def _pieces(self, text):
        """A long text in parts that end behind white space."""
        while len(text) > SLICE_CHARS:
            cut = max(text.rfind(c, 0, SLICE_CHARS) for c in " \n\t\r") + 1
            if not cut:
                after = [p for c in " \n\t\r" if (p := text.find(c, SLICE_CHARS)) >= 0]
                cut = min(after, default=len(text) - 1) + 1
            yield text[:cut]
            text = text[cut:]
        if text:
            yield text

    def _count(self, texts, owners, result):
        if not texts:
            return
        points = np.frombuffer(" ".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        points = self.lower[points]
        kinds = self.kinds[points]
        states = scan_states(self.step, kinds)
        output = self.output[states, kinds]
        starting = (output & STARTS) > 0
        starting[:-1] |= (output[1:] & STARTED) > 0
        starts = np.flatnonzero(starting)
        if not len(starts):
            return
        breaks = np.flatnonzero(starting | (kinds == SPACE))
        ends = breaks[np.searchsorted(breaks, starts) + 1]
        hashes = self.rolling.span(self.rolling.totals(points), starts, ends)
        unique, at, back = np.unique(hashes, return_index=True, return_inverse=True)
        counts = np.fromiter(map(self.known.get, unique.tolist(), (-1 for _ in unique)), np.int64, len(unique))
        missing = np.flatnonzero(counts < 0)
        if len(self.known) + len(missing) > CACHE_WORDS:
            self.known = {}
        if len(missing):
            begins = starts[at[missing]]
            own = self.words(points, begins, ends[at[missing]])
            counts[missing] = np.where(points[begins] == ord(MARKER), 1, own)
            self.known.update(zip(unique[missing].tolist(), counts[missing].tolist()))
        lengths = np.array([len(t) + 1 for t in texts])
        bounds = np.cumsum(lengths) - lengths
        owner = np.array(owners)[np.searchsorted(bounds, starts, side="right") - 1]
        np.add.at(result, owner, counts[back])


def count_tokens(docs, vocabulary, id="doc_id", text="text"):
    """Rows (id, n_bytes, n_tokens): tokens of each whole text, null counted as empty.

    ``vocabulary`` is the path of a tokenizer file, present on every machine that runs
    tasks. Special strings inside a text count as the one token they stand for. A text of
    any length is counted in parts that end at white space; repeated rows give repeated
    results. A Python worker compiles the vocabulary once and keeps it.
    """
    kind = docs.schema[id].dataType.simpleString()

    def count(batches):
        counter = kept(f"tokens {vocabulary}", lambda: Counter(vocabulary))
        for batch in batches:
            _, starts = utf8(batch.column(1))
            tokens = counter.count(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(starts)), pa.array(tokens)], ["id", "n_bytes", "n_tokens"]
            )

    return docs.select(id, text).mapInArrow(count, f"`{id}` {kind}, n_bytes long, n_tokens long")
