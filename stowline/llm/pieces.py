"""SentencePiece encoding and decoding by shortest paths in a weighted transducer."""

import re

import numpy as np
import pyarrow as pa

from stowline.llm.texts import declared, give_back, kept, utf8

SPACE = "▁"
#: Units in each of two generations, and pairs of pieces, that a worker keeps.
CACHE_UNITS = 300_000
CACHE_PAIRS = 300_000
BATCH_CHARS = 1 << 20
FAR = float("inf")
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, USER, BYTE = 1, 2, 4, 6


class Transducer:
    """Normaliser, pieces and byte fallback of a model, compiled for composition.

    Pieces form a trie whose accepting arcs carry a weight in the tropical semiring; a
    character that no piece covers takes its bytes. The text's paths are segmentations, and
    the shortest is taken. In a unigram model an arc weighs minus its score. In a BPE model a
    state also holds the last piece, and an arc weighs nothing if merging would leave the two
    side by side and infinitely much if not: that leaves one finite path, the one merging
    gives. Text is composed unit by unit, cut where no piece can cross: before a space mark
    behind another character, around characters that only occur alone, and before
    punctuation that no piece holds behind a letter.
    """

    def __init__(self, path):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        normal = model.normalizer_spec
        if normal.precompiled_charsmap or normal.remove_extra_whitespaces or not normal.escape_whitespaces:
            raise ValueError(f"only models with the identity normaliser: {path}")
        self.merging = model.trainer_spec.model_type == BPE
        if not self.merging and model.trainer_spec.model_type != UNIGRAM:
            raise ValueError(f"neither a BPE nor a unigram model: {path}")
        self.prefix = SPACE if normal.add_dummy_prefix else ""
        self.text = [p.piece for p in model.pieces]
        self.score = [p.score for p in model.pieces]
        usable = [i for i, p in enumerate(model.pieces) if p.type in (NORMAL, USER)]
        self.ids = {self.text[i]: i for i in usable}
        self.byte = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == UNKNOWN)
        self.bytes = [
            bytes([int(p.piece[3:5], 16)]) if p.type == BYTE else b"" if p.type not in (NORMAL, USER) else p.piece.encode()
            for p in model.pieces
        ]
        self.least = min(self.score) - 10.0
        if any(SPACE in t.lstrip(SPACE) for t in self.ids):
            raise ValueError(f"a piece holds a space behind another character: {path}")
        joined = {c for t in self.ids if len(t) > 1 for c in t}
        solo = {chr(c) for c in range(128)} - joined
        marks = {chr(c) for c in range(128) if not chr(c).isalnum()} - solo
        behind = {b for t in self.ids for a, b in zip(t, t[1:]) if a not in marks and a != SPACE}
        listed = lambda chars: "".join(map(re.escape, sorted(chars)))
        solo, free, other = listed(solo), listed(marks - behind), listed(marks) + SPACE
        inner = f"[^{SPACE}{solo}{free}]" + (f"|(?<![^{other}])[{free}]" if free else "")
        alone = f"|[{solo}]" if solo else ""
        self.units = re.compile(f"{SPACE}*[^{SPACE}{solo}](?:{inner})*|{SPACE}+{alone}")
        self.trie = {}
        for text, index in self.ids.items():
            node = self.trie
            for char in text:
                node = node.setdefault(char, {})
            node[""] = index
        self.runs = {len(t): i for t, i in self.ids.items() if t == SPACE * len(t)}
        self.longest_run = max(self.runs, default=1)
        self.pair = {}
        if self.merging:
            self._learn_halves()
        self.clear()

    def clear(self):
        """Forget the units and pairs of pieces seen so far."""
        self.fresh, self.older, self.next_to = {}, {}, {}

    def _learn_halves(self):
        """The two pieces that each piece is merged from, and its place in the order of merges."""
        order = sorted(self.ids.values(), key=lambda i: (-self.score[i], i))
        self.rank = {i: n for n, i in enumerate(order)}
        self.halves = {}
        for index in order:
            parts = list(self.text[index])
            if len(parts) == 1 or any(c not in self.ids for c in parts):
                continue
            while len(parts) > 2:
                pairs = [self.rank.get(self.ids.get(a + b), len(order)) for a, b in zip(parts, parts[1:])]
                at = pairs.index(min(pairs))
                if pairs[at] == len(order):
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            if len(parts) == 2:
                left, right = self.ids[parts[0]], self.ids[parts[1]]
                self.halves[index] = (left, right)
                self.pair[left, right] = self.rank[index]
        #: Place in the order of merges; -1 for pieces that are not merged from others.
        self.late = [self.rank[i] if i in self.halves else -1 for i in range(len(self.text))]

    def _neighbours(self, left, right):
        """Whether merging leaves two pieces side by side.

        Undoes their merges, latest first. Before each is undone, the pieces at the border
        must not have been able to merge earlier; on the left side, and between equals, the
        earlier place wins.
        """
        late, halves, pair = self.late, self.halves, self.pair
        bound = len(late)
        while True:
            if pair.get((left, right), bound) < bound:
                return False
            a, b = late[left], late[right]
            if a > b:
                bound, left = a, halves[left][1]
            elif b >= 0:
                bound, right = b + 1, halves[right][0]
            else:
                return True

    def _path(self, text):
        """Pieces of the shortest path through a text without runs of space marks."""
        size, trie = len(text), self.trie
        piece, begin = [None] * (size + 1), [0] * (size + 1)
        if self.merging:
            # All finite paths weigh nothing: depth first, longest pieces first, finds the one.
            ids, known, later = self.ids, self.next_to, []
            i, last = 0, -1
            while i < size:
                arcs = [] if text[i] in ids else [(-1, i + 1)]
                node, j = trie, i
                while j < size and (node := node.get(text[j])) is not None:
                    j += 1
                    if "" in node and piece[j] is None:
                        arcs.append((node[""], j))
                while True:
                    if not arcs:
                        i, arcs = later.pop()
                        last = piece[i] if i else -1
                        continue
                    index, j = arcs.pop()
                    if piece[j] is not None:
                        continue
                    if last < 0 or index < 0:
                        break
                    fit = known.get((last, index))
                    if fit or (fit is None and self._fits(last, index)):
                        break
                if arcs:
                    later.append((i, arcs))
                piece[j], begin[j] = index, i
                i, last = j, index
        else:
            cost = [FAR] * (size + 1)
            cost[0] = 0.0
            for i in range(size):
                base, node, j = cost[i], trie, i
                while j < size and (node := node.get(text[j])) is not None:
                    j += 1
                    index = node.get("")
                    if index is not None and base - self.score[index] < cost[j]:
                        cost[j], piece[j], begin[j] = base - self.score[index], index, i
                if text[i] not in self.ids and base - self.least < cost[i + 1]:
                    cost[i + 1], piece[i + 1], begin[i + 1] = base - self.least, -1, i
        path, at = [], size
        while at:
            path.append(text[begin[at] : at] if piece[at] < 0 else piece[at])
            at = begin[at]
        return path[::-1]

    def _fits(self, left, right):
        if len(self.next_to) >= CACHE_PAIRS:
            self.next_to.clear()
        found = self.next_to[left, right] = self._neighbours(left, right)
        return found

    def _unit(self, text):
        """Ids of one unit, as bytes of 32-bit numbers."""
        run = len(text) - len(text.lstrip(SPACE)) if self.merging else 0
        path = self._path(text[run - 1 :] if run > 1 and run < len(text) else text if run < 2 else SPACE)
        if run > 1:
            # Pieces of space marks alone merge last, from the left.
            marks = run if path[0] == self.runs.get(1) or run == len(text) else run - 1
            path = path[1:] if marks == run else path
            if len(self.runs) == self.longest_run:
                full, rest = divmod(marks, self.longest_run)
                path = [self.runs[self.longest_run]] * full + ([self.runs[rest]] if rest else []) + path
            else:
                path = self._path_of_marks(marks) + path
        ids = []
        for step in path:
            if isinstance(step, str):
                ids += [self.byte[b] for b in step.encode("utf-8")] if self.byte else [self.unknown]
            else:
                ids.append(step)
        return np.array(ids, np.int32).tobytes()

    def _path_of_marks(self, marks):
        parts = [1] * marks
        while True:
            fits = [(-self.score[self.runs[a + b]], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.runs]
            if not fits:
                return [self.runs[p] for p in parts]
            _, at = min(fits)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def encode(self, text):
        """Ids of a text as a NumPy array; null and empty have none."""
        if not text:
            return np.zeros(0, np.int32)
        if self.prefix and text[0] != " " and text[-1] != " " and "  " not in text and SPACE not in text:
            # Every space starts a unit of its own.
            return np.frombuffer(b"".join(self._known(text.split(" "), SPACE)), np.int32)
        units = self.units.findall(self.prefix + text.replace(" ", SPACE))
        return np.frombuffer(b"".join(self._known(units, "")), np.int32)

    def _known(self, parts, mark):
        """Ids of each part behind a mark, as bytes; two generations of parts are kept."""
        fresh, older = self.fresh, self.older
        if mark:
            found = list(map(fresh.get, parts))
            keys = parts
        else:
            # Words behind a mark hold no space, so no word has the key of a unit without one.
            keys = [" " + p for p in parts]
            found = list(map(fresh.get, keys))
        if None not in found:
            return found
        for at, ids in enumerate(found):
            if ids is not None:
                continue
            key = keys[at]
            ids = fresh.get(key) or older.get(key)
            if ids is None:
                units = self.units.findall(mark + parts[at]) if mark else [parts[at]]
                ids = self._unit(units[0]) if len(units) == 1 else b"".join(self._known(units, ""))
            if len(key) <= 64:
                fresh[key] = ids
            found[at] = ids
        if len(fresh) > CACHE_UNITS:
            self.fresh, self.older = {}, fresh
        return found

    def decode(self, ids):
        """Text of ids; bytes that form no character become U+FFFD."""
        if not len(ids):
            return ""
        text = b"".join(map(self.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")
        text = text.replace(SPACE, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text


def transducer(path):
    """The compiled model; a Python worker compiles it once and keeps it."""
    return kept(f"pieces {path}", lambda: Transducer(path))


def encode_pieces(docs, model, text="text", column="pieces", keep=None, decoded=None, packed=None):
    """Every row with the ids of its text (array of int) more; null and empty texts have none.

    ``keep`` names the columns to return beside the ids. With ``decoded``, a column of that
    name has the text that the ids decode to, made in the same pass; with ``packed``, one has
    the ids as a binary of little-endian 32-bit numbers.

    ``model`` is the path of a model file, present on every machine that runs tasks. A
    column of the new name is replaced; repeated rows stay.
    """
    more = {n: kind for n, kind in ((decoded, "string"), (packed, "binary")) if n}
    docs = docs.drop(column, *more)
    keep = [c for c in docs.columns if keep is None or c in keep]
    docs = docs.select(*{*keep, text})
    schema = ", ".join([*(declared(docs.schema[c]) for c in keep), f"`{column}` array<int>", *(f"`{n}` {kind}" for n, kind in more.items())])

    def encode(batches):
        made = transducer(model)
        for batch in batches:
            for part in parts(batch, text):
                ids = [made.encode(t) for t in part.column(text).to_pylist()]
                edges = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                values = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                lists = pa.ListArray.from_arrays(pa.array(edges), pa.array(values, pa.int32()))
                columns, names = [*map(part.column, keep), lists], [*keep, column]
                if decoded:
                    columns.append(pa.array(map(made.decode, ids), pa.string()))
                    names.append(decoded)
                if packed:
                    columns.append(pa.array([i.astype("<i4").tobytes() for i in ids], pa.binary()))
                    names.append(packed)
                yield pa.RecordBatch.from_arrays(columns, names)
            batch = part = columns = ids = values = lists = None
            give_back()
        # Units and pairs of one task hardly help the next, but would stay in the worker.
        made.clear()
        give_back()

    return docs.mapInArrow(encode, schema)


def decode_pieces(encoded, model, pieces="pieces", column="decoded"):
    """Every row with the text of its ids more; null for null ids."""
    encoded = encoded.drop(column)
    schema = ", ".join([*map(declared, encoded.schema.fields), f"`{column}` string"])

    def decode(batches):
        made = transducer(model)
        for batch in batches:
            ids = batch.column(pieces)
            flat = ids.flatten().to_numpy(zero_copy_only=False)
            edges = np.cumsum([0, *ids.value_lengths().fill_null(0).to_pylist()])
            texts = [made.decode(flat[a:b]) for a, b in zip(edges[:-1], edges[1:])]
            texts = [t if ok else None for t, ok in zip(texts, ids.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, column])

    return encoded.mapInArrow(decode, schema)


def parts(batch, text):
    """A batch in parts of about a million bytes of text."""
    _, starts = utf8(batch.column(text))
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + BATCH_CHARS, side="right")) - 1)
        yield batch.slice(first, last - first)
        first = last
