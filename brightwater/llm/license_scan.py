"""License scans by template markup.

A template is wording with marked regions: ``[[...]]`` may be missing, ``<<n>>`` stands for up to
n words of any kind (names, years). It is compiled to a token automaton, and a text is
accepted where the automaton runs from some word to its end, that is where all mandatory
wording stands exactly, in order, with nothing but the marked regions in between. The longest
run of mandatory words serves as an anchor: documents without it are passed over in one
vectorised comparison, and the automaton starts only around anchors.

Base phrases need their words to stand consecutively; they are counted at every place.

Nulls: a null text counts as empty; a null id is returned as it is. Repeated rows are documents
of their own; overlapping places all count. An empty table gives no rows. Other columns are
never looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import FOLD, NOT_ALNUM, Segments, batches

# Phrases and labels of the base scan.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

_COPYRIGHT = "[[copyright [[c]] <<12>>]] [[all rights reserved]]"
_MIT_DISCLAIMER = ("the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a "
                   "particular purpose and noninfringement in no event shall the <<8>> be liable for any claim damages or other liability whether in an action of contract tort or otherwise "
                   "arising from out of or in connection with the software or the use or other dealings in the software")
_BSD_DISCLAIMER = ("this software is provided by <<8>> as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a "
                   "particular purpose are disclaimed in no event shall <<10>> be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to "
                   "procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or "
                   "tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage")
_BSD_CLAUSES = ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met [[1]] [[a]] redistributions of source code must retain "
                "the above copyright notice this list of conditions and the following disclaimer [[2]] [[b]] redistributions in binary form must reproduce the above copyright notice this list of conditions "
                "and the following disclaimer in the documentation and or other materials provided with the distribution")
# Templates by label. [[...]] is optional (titles, copyright blocks, bullets), <<n>> stands for up to n words (names, years).
TEMPLATES = {
    "mit": [
        "[[released]] [[licensed]] under [[the terms of]] the mit license",
        "[[the]] [[mit license]] [[mit]] " + _COPYRIGHT + " permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software "
        "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense "
        "and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions "
        "the above copyright notice and this permission notice [[including the next paragraph]] shall be included in all copies or substantial portions of the software " + _MIT_DISCLAIMER,
    ],
    "apache-2": [
        "licensed under the apache license version 2 [[0]] [[the license]]",
        _COPYRIGHT + " licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at "
        "[[https]] [[http]] www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
        "without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
    ],
    "gpl-2": ["licensed under [[the terms of]] the gnu general public license [[as published by the free software foundation]] [[either]] version 2",
              "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation [[either]] version 2 [[of the license]]"],
    "gpl-3": ["licensed under [[the terms of]] the gnu general public license [[as published by the free software foundation]] [[either]] version 3",
              "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation [[either]] version 3 [[of the license]] "
              "[[or at your option any later version]]"],
    "agpl-3": ["under the terms of the gnu affero general public license as published by the free software foundation [[either]] version 3"],
    "lgpl": ["under [[the terms of]] the gnu <<1>> lesser general public license"],
    "mpl-2": ["this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at <<8>>"],
    "cc-by": ["licensed under [[a]] [[the]] creative commons attribution <<2>> international license"],
    "cc-by-nc": ["licensed under [[a]] [[the]] cc by nc [[4 0]]"],
    "cc0": ["dedicated to the public domain <<6>> cc0",
            "the person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law"],
    "bsd-2": ["[[bsd 2 clause license]] " + _COPYRIGHT + " " + _BSD_CLAUSES + " " + _BSD_DISCLAIMER],
    "bsd-3": ["[[bsd 3 clause license]] " + _COPYRIGHT + " " + _BSD_CLAUSES + " [[3]] [[c]] neither the <<12>> may be used to endorse or promote products derived from this software without specific prior "
              "written permission " + _BSD_DISCLAIMER],
    "isc": [
        "[[isc license]] " + _COPYRIGHT + " permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is hereby granted provided that "
        "the above copyright notice and this permission notice appear in all copies the software is provided as is and <<4>> disclaims all warranties with regard to this software including all implied "
        "warranties of merchantability and fitness in no event shall <<4>> be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or "
        "profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software",
    ],
    "zlib": [
        _COPYRIGHT + " this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software "
        "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions "
        "[[1]] the origin of this software must not be misrepresented you must not claim that you wrote the original software if you use this software in a product an acknowledgment in the product "
        "documentation would be appreciated but is not required [[2]] altered source versions must be plainly marked as such and must not be misrepresented as being the original software "
        "[[3]] this notice may not be removed or altered from any source distribution",
    ],
    "boost": [
        "[[boost software license version 1 0]] [[august 17th 2003]] permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation "
        "covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the "
        "software is furnished to do so all subject to the following",
    ],
    "unlicense": [
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a "
        "compiled binary for any purpose commercial or non commercial and by any means",
    ],
    "all-rights-reserved": ["copyright [[c]] <<6>> all rights reserved"],
}

_PART = re.compile(r"\[\[|\]\]|<<(\d+)>>|([^\s\[\]<>]+)")


def word_hash(words: list[str]) -> list[int]:
    """The hashes that batches of text give these words."""
    raw = np.frombuffer(" ".join(words).encode(), np.uint8)
    return Segments(raw, np.array([0, len(raw)]), NOT_ALNUM).hashes().tolist()


class Automaton:
    """States 0..n; an arc takes a given word or any word, or none at all."""

    def __init__(self, label: str, template: str):
        self.label = label
        self.take: list[dict[int, int]] = [{}]
        self.any: list[int | None] = [None]
        self.free: list[list[int]] = [[]]
        mandatory, run, runs, opened, now, before = [], [], [], [], 0, 0
        self.longest_before = 0
        for m in _PART.finditer(template):
            if m[0] == "[[":
                opened.append(now)
                runs.append((run, before)), (run := [])
            elif m[0] == "]]":
                self.free[opened.pop()].append(now)
                run = []
            elif m[1]:
                runs.append((run, before)), (run := [])
                first, n = now, int(m[1])
                for _ in range(n):
                    self.any[now] = self._state()
                    now = self.any[now]
                end = self._state()
                for s in [*range(first, first + 1), *range(first + 1, now + 1)]:
                    self.free[s].append(end)
                now, before = end, before + n
            else:
                h = word_hash([m[2]])[0]
                nxt = self._state()
                self.take[now][h] = nxt
                now, before = nxt, before + 1
                if not opened:
                    run.append(h)
                    runs.append((list(run), before))
        self.final = now
        self.anchor, upto = max(runs, key=lambda r: (len(r[0]), -r[1]))
        self.before = upto - len(self.anchor)
        self._closed: dict[frozenset[int], frozenset[int]] = {}
        self.starts = {h for s in self._close(frozenset([0])) for h in self.take[s]}
        self._steps: dict[tuple[frozenset[int], int], frozenset[int]] = {}

    def _state(self) -> int:
        self.take.append({}), self.any.append(None), self.free.append([])
        return len(self.take) - 1

    def _close(self, states: frozenset[int]) -> frozenset[int]:
        if states not in self._closed:
            todo, seen = list(states), set(states)
            while todo:
                for s in self.free[todo.pop()]:
                    if s not in seen:
                        seen.add(s), todo.append(s)
            self._closed[states] = frozenset(seen)
        return self._closed[states]

    def accepts(self, words: list[int], at: int) -> int | None:
        """The end of the longest match that starts at a word, or None."""
        states, end = self._close(frozenset([0])), None
        for k in range(at, len(words)):
            if self.final in states:
                end = k
            key = (states, words[k])
            if key not in self._steps:
                if len(self._steps) > 50_000:
                    self._steps = {}
                step = {self.take[s][words[k]] for s in states if words[k] in self.take[s]} | {self.any[s] for s in states if self.any[s] is not None}
                self._steps[key] = self._close(frozenset(step))
            states = self._steps[key]
            if not states:
                return end
        return len(words) if self.final in states else end


def places_of(run: list[int], hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Where the words stand consecutively within a document."""
    n = len(hashes) - len(run) + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    hit = (hashes[:n] == np.uint64(run[0])) & (doc[:n] == doc[len(run) - 1:])
    for k, h in enumerate(run[1:], 1):
        hit &= hashes[k:n + k] == np.uint64(h)
    return np.flatnonzero(hit)


class Scanner:
    def __init__(self, phrases: dict[str, str], templates: dict[str, list[str]]):
        self.phrases = [(word_hash(p.split()), label) for p, label in phrases.items()]
        self.automata = [Automaton(label, t) for label, ts in templates.items() for t in ts]

    def scan(self, texts: pa.Array) -> Iterator[tuple]:
        """For each row: words, base places, first and last base place, base labels, found [(label, from, to)]."""
        for i, j, data, bounds in batches(texts):
            seg = Segments(FOLD[data], bounds, NOT_ALNUM)
            hashes, per = seg.hashes(), seg.per_doc()
            start = np.concatenate([[0], np.cumsum(per)])
            base: dict[int, list[tuple[int, str, int]]] = {}
            for run, label in self.phrases:
                for at in places_of(run, hashes, seg.doc).tolist():
                    d = int(seg.doc[at])
                    base.setdefault(d, []).append((at - int(start[d]), label, len(run)))
            found: dict[int, set[tuple[str, int, int]]] = {}
            for a in self.automata:
                for at in places_of(a.anchor, hashes, seg.doc).tolist():
                    d = int(seg.doc[at])
                    low = max(int(start[d]), at - a.before)
                    words = hashes[low:min(int(start[d + 1]), at + len(a.take))].tolist()  # no match is longer than all words and regions
                    for s in range(at - low + 1):
                        if words[s] in a.starts and (end := a.accepts(words, s)) is not None and end > at - low:
                            found.setdefault(d, set()).add((a.label, s + low - int(start[d]), end + low - int(start[d])))
                            break
            for d in range(j - i):
                mine = base.get(d, [])
                yield int(per[d]), mine, sorted(found.get(d, ()))


def license_scan(docs: DataFrame, phrases: dict[str, str] = BASE_PHRASES, templates: dict[str, list[str]] = TEMPLATES,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches.

    score: the share of a document's words that lie in places of phrases or templates. matches:
    label, from_word and to_word (after the last) of each accepted template.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    match = T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("from_word", T.LongType()), T.StructField("to_word", T.LongType())]))
    longs = ["n_words", "n_base", "first_word", "last_word"]
    schema = T.StructType([T.StructField(id_col, rows.schema["id"].dataType), *[T.StructField(c, T.LongType()) for c in longs],
                           T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("matches", match)])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, templates)
        for b in it:
            cols: list[list] = [[] for _ in range(8)]
            for n_words, base, found in scanner.scan(b.column("text")):
                at = [p for p, _, _ in base]
                names = {label for _, label, _ in base}
                covered = set().union(*[range(p, p + n) for p, _, n in base], *[range(s, e) for _, s, e in found])
                for col, value in zip(cols, [n_words, len(base), min(at, default=None), max(at, default=None), ",".join(sorted(names)),
                                             ",".join(sorted(names | {label for label, _, _ in found})), len(covered) / n_words if n_words else 0.0,
                                             [{"label": label, "from_word": s, "to_word": e} for label, s, e in found]], strict=True):
                    col.append(value)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct([("label", pa.string()), ("from_word", pa.int64()), ("to_word", pa.int64())]))]
            yield pa.RecordBatch.from_arrays([b.column("id"), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], schema.names)

    return rows.mapInArrow(run, schema)
