"""License scans: templates with optional and replaceable regions, matched as token automata."""

import re

import numpy as np
import pyarrow as pa

from stowline.llm.texts import SMALL, Rolling, find_words, slices, utf8

# License wording and the markup around it, as published with the licenses.
# [[...]] may be absent; {{n}} stands for up to n words of any kind.
TEMPLATES = (
    ("mit", "base", "mit license"),
    ("apache", "base", "apache license"),
    ("gpl", "base", "general public license"),
    ("mit", "text", """
        permission is hereby granted free of charge to any person obtaining a copy of this software and associated
        documentation files [[the software]] to deal in the software without restriction including without limitation the
        rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit
        persons to whom the software is furnished to do so subject to the following conditions
        the above copyright notice and this permission notice [[including the next paragraph]] shall be included in all
        copies or substantial portions of the software
        the software is provided as is without warranty of any kind express or implied including but not limited to the
        warranties of merchantability fitness for a particular purpose and noninfringement in no event shall {{8}} be
        liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from
        out of or in connection with the software or the use or other dealings in the software"""),
    ("mit", "notice", "licensed under the [[terms of the]] mit license"),
    ("mit", "notice", "released under the [[terms of the]] mit license"),
    ("apache", "notice", "licensed under the apache license [[version 2 0]]"),
    ("apache", "text", """
        licensed under the apache license version 2 0 the license you may not use {{3}} except in compliance with the
        license you may obtain a copy of the license at {{12}}
        unless required by applicable law or agreed to in writing software distributed under the license is distributed
        on an as is basis without warranties or conditions of any kind either express or implied see the license for the
        specific language governing permissions and limitations under the license"""),
    ("apache", "title", "apache license version 2 0 january 2004"),
    ("gpl", "text", """
        {{4}} is free software you can redistribute it and or modify it under the terms of the gnu [[lesser]] [[affero]]
        [[library]] general public license as published by the free software foundation either version {{3}} of the
        license or [[at your option]] any later version
        {{4}} is distributed in the hope that it will be useful but without any warranty without even the implied warranty
        of merchantability or fitness for a particular purpose see the gnu [[lesser]] [[affero]] [[library]] general
        public license for more details"""),
    ("gpl", "notice", "licensed under the [[terms of the]] gnu general public license"),
    ("gpl", "notice", "gnu general public license [[as published by the free software foundation]]"),
    ("bsd", "text", """
        redistribution and use in source and binary forms with or without modification are permitted provided that the
        following conditions are met
        [[1]] redistributions of source code must retain the above copyright notice this list of conditions and the
        following disclaimer
        [[2]] redistributions in binary form must reproduce the above copyright notice this list of conditions and the
        following disclaimer in the documentation and or other materials provided with the distribution
        [[ [[3]] neither the name of {{12}} nor the names of its contributors may be used to endorse or promote products
        derived from this software without specific prior written permission ]]
        this software is provided by {{12}} as is and any express or implied warranties including but not limited to the
        implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall {{12}}
        be liable for any direct indirect incidental special exemplary or consequential damages including but not limited
        to procurement of substitute goods or services loss of use data or profits or business interruption however caused
        and on any theory of liability whether in contract strict liability or tort including negligence or otherwise
        arising in any way out of the use of this software even if advised of the possibility of such damage"""),
    ("bsd", "notice", "licensed under the [[2 clause]] [[3 clause]] [[new]] [[simplified]] bsd license"),
    ("isc", "text", """
        permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is hereby
        granted provided that the above copyright notice and this permission notice appear in all copies
        the software is provided as is and {{6}} disclaims all warranties with regard to this software including all
        implied warranties of merchantability and fitness in no event shall {{8}} be liable for any special direct
        indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in
        an action of contract negligence or other tortious action arising out of or in connection with the use or
        performance of this software"""),
    ("mpl", "text", """
        this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not
        distributed with this file you can obtain one at"""),
    ("mpl", "notice", "mozilla public license [[version]] [[v]] 2 0"),
    ("cc", "notice", "creative commons attribution [[noncommercial]] [[sharealike]] [[noderivatives]] {{2}} license"),
    ("unlicense", "text", """
        this is free and unencumbered software released into the public domain
        anyone is free to copy modify publish use compile sell or distribute this software either in source code form or
        as a compiled binary for any purpose commercial or non commercial and by any means
        in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all
        copyright interest in the software to the public domain we make this dedication for the benefit of the public at
        large and to the detriment of our heirs and successors we intend this dedication to be an overt act of
        relinquishment in perpetuity of all present and future rights to this software under copyright law
        the software is provided as is without warranty of any kind express or implied including but not limited to the
        warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors
        be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from
        out of or in connection with the software or the use or other dealings in the software"""),
)

ANY = -1
#: Word bytes: digits, letters (lower-cased) and every byte of a character beyond ASCII.
_CLASS = np.zeros(256, bool)
_CLASS[48:58] = _CLASS[65:91] = _CLASS[97:123] = _CLASS[128:] = True


class Automata:
    """All templates as one deterministic automaton, its states made when first reached."""

    def __init__(self, templates=TEMPLATES):
        parsed = [re.findall(r"\[\[|\]\]|\{\{\d+\}\}|[^\s\[\]{}]+", text) for _, _, text in templates]
        words = sorted({w for parts in parsed for w in parts if w[0] not in "[]{"})
        self.words = [w.encode() for w in words]
        ids = {w: i for i, w in enumerate(words)}
        # arcs[state]: (word or ANY, next); free[state]: states reached without a word.
        self.arcs, self.free, self.final = [], [], {}
        self.start = self._state()
        for index, parts in enumerate(parsed):
            at = self._state()
            self.free[self.start].append(at)
            opened = []
            for part in parts:
                if part == "[[":
                    opened.append(at)
                elif part == "]]":
                    self.free[opened.pop()].append(at)
                elif part[0] == "{":
                    skipped = [at]
                    for _ in range(int(part[2:-2])):
                        new = self._state()
                        self.arcs[at].append((ANY, new))
                        at = new
                        skipped.append(at)
                    for state in skipped[:-1]:
                        self.free[state].append(at)
                else:
                    new = self._state()
                    self.arcs[at].append((ids[part], new))
                    at = new
            self.final[at] = index
        self.steps = {}
        self.first = self._closed({self.start})
        #: Words that a match can start with; a template must start with a word of its own
        #: for its matches to be looked for from there.
        self.starts = np.zeros(len(words) + 1, bool)
        for state in self.first:
            for word, _ in self.arcs[state]:
                if word != ANY:
                    self.starts[word] = True

    def _state(self):
        self.arcs.append([])
        self.free.append([])
        return len(self.arcs) - 1

    def _closed(self, states):
        todo, seen = list(states), set(states)
        while todo:
            for state in self.free[todo.pop()]:
                if state not in seen:
                    seen.add(state)
                    todo.append(state)
        return frozenset(seen)

    def step(self, states, word):
        found = self.steps.get((states, word))
        if found is None:
            found = self._closed({n for s in states for w, n in self.arcs[s] if w in (word, ANY)})
            found = self.steps[states, word] = (found, tuple(self.final[s] for s in found if s in self.final))
        return found

    def run(self, words):
        """(template, number of words) of every match that begins with the first of the words.

        ``words`` yields word numbers, -2 for others; no more are taken than templates reach.
        """
        states, taken = self.first, 0
        for word in words:
            states, ended = self.step(states, word)
            taken += 1
            for template in ended:
                yield template, taken
            if not states:
                return


def _words(data, starts, known, hashes, rolling):
    """Per text the number of its words, and places and numbers of the words that templates hold."""
    counts = np.zeros(len(starts) - 1, np.int64)
    rows, places, numbers = [], [], []
    for first, last, begin, end in slices(data, starts, limit=1 << 20, breaks=~_CLASS):
        piece = SMALL[data[begin:end]]
        bounds = np.clip(starts[first : last + 1], begin, end) - begin
        here, after, owner = find_words(piece, bounds, _CLASS)
        mine = np.bincount(owner, minlength=last - first)
        number = np.arange(len(here)) - (np.cumsum(mine) - mine)[owner] + counts[first:last][owner]
        counts[first:last] += mine
        sums = rolling.totals(piece)
        value = rolling.span(sums, here, after)
        hit = np.searchsorted(hashes, value)
        hit[hit == len(hashes)] = 0
        same = np.flatnonzero(hashes[hit] == value)
        rows.append(owner[same] + first)
        places.append(number[same])
        numbers.append(known[hit[same]])
    join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return counts, join(rows), join(places), join(numbers)


def _following(places, numbers, at, end, count):
    """Word numbers of a text of ``count`` words from the known word ``at`` on, -2 for unknown ones."""
    for place in range(int(places[at]), count):
        if at < end and places[at] == place:
            yield int(numbers[at])
            at += 1
        else:
            yield -2


def scan_licenses(docs, id="doc_id", text="text", templates=TEMPLATES):
    """Rows (id, n_words, n_base, first_word, last_word, base_labels, labels, spans, score).

    A template's text is matched word by word, lower-cased: words outside ``[[ ]]`` and
    ``{{ }}`` are mandatory and must match exactly, in order and without others between
    them. Templates of kind ``text`` hold the whole wording of short licenses and of the notices
    of long ones, so a text with a changed, added or missing condition is none of them. Those
    of kind ``base`` are plain phrases; n_base counts all their places,
    first_word and last_word bound their starts (null without any). ``labels`` has the labels
    of all templates found, ``spans`` each match as (label, kind, first word, words), the
    longest of a template at a start. The score is the share of words that lie in matches.

    A null or empty text has no words, empty labels and score 0. Repeated rows give repeated
    results. The automaton runs only from words that a template starts with, over word
    numbers; a text of any length is cut into words slice by slice.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(tuple(templates))
    kind = docs.schema[id].dataType.simpleString()

    def scan(batches):
        chosen = shared.value
        automata, rolling = Automata(chosen), Rolling()
        joined = np.frombuffer(b"".join(automata.words), np.uint8)
        edges = np.cumsum([0, *map(len, automata.words)])
        hashes = rolling.span(rolling.totals(joined), edges[:-1], edges[1:])
        known = np.argsort(hashes)
        hashes = hashes[known]
        for batch in batches:
            data, starts = utf8(batch.column(1))
            counts, rows, places, numbers = _words(data, starts, known, hashes, rolling)
            found = [[] for _ in range(batch.num_rows)]
            begins = np.flatnonzero(automata.starts[numbers]) if len(numbers) else []
            ends = np.searchsorted(rows, rows, side="right") if len(rows) else []
            for at in begins:
                row, place = int(rows[at]), int(places[at])
                best = dict(automata.run(_following(places, numbers, int(at), int(ends[at]), int(counts[row]))))
                found[row] += [(place, template, length) for template, length in best.items()]
            yield _result(batch.column(0), counts, found, chosen)

    return docs.select(id, text).mapInArrow(
        scan,
        f"`{id}` {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, spans array<struct<label:string,kind:string,word:long,words:int>>, score double",
    )


def _result(ids, counts, found, templates):
    n_base, first, last, base, labels, spans, score = [], [], [], [], [], [], []
    for count, hits in zip(counts.tolist(), found):
        hits.sort()
        starts = [place for place, t, _ in hits if templates[t][1] == "base"]
        n_base.append(len(starts))
        first.append(min(starts, default=None))
        last.append(max(starts, default=None))
        base.append(",".join(sorted({templates[t][0] for _, t, _ in hits if templates[t][1] == "base"})))
        labels.append(",".join(sorted({templates[t][0] for _, t, _ in hits})))
        spans.append([{"label": templates[t][0], "kind": templates[t][1], "word": p, "words": n} for p, t, n in hits])
        covered, edge = 0, 0
        for place, _, length in hits:
            covered += max(0, place + length - max(edge, place))
            edge = max(edge, place + length)
        score.append(covered / count if count else 0.0)
    long = pa.int64()
    kind = pa.list_(pa.struct([("label", pa.string()), ("kind", pa.string()), ("word", long), ("words", pa.int32())]))
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(counts, long), pa.array(n_base, long), pa.array(first, long), pa.array(last, long),
         pa.array(base, pa.string()), pa.array(labels, pa.string()), pa.array(spans, kind), pa.array(score, pa.float64())],
        ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "spans", "score"],
    )
