"""License scan: matching statistics from a suffix automaton of license texts, chained into spans.

A generalised suffix automaton holds all templates, word by word. A file is streamed through it: at
each word, the automaton's state and a length say which longest run of words ending there occurs in
a template. Runs that cannot grow are matches; for each template, matches of several words whose
places follow one another in the file and in the template are chained into a span, and a span that
covers enough of the template gives its label, unless all it covers are words that another template has too
and this one has others: a notice that stops before "nc" does not tell BY-NC from BY-SA. Where another
template has all the words, it is pairs of neighbouring words that have to tell the two apart ("GNU General" is in
no notice of the GNU Affero General Public License). Short phrases, and templates too short for a match, have to be whole.

Only words that some template has can be part of a match, so runs of such words are cut out of a
batch by arrays first, and only those go through the automaton.

The templates are a bounded parameter; the automaton travels with the tasks.

Defined cases: a null text is empty; a text without words has no label and score 0; every row is
scanned, repeated ones alike; overlapping places of a phrase all count; of equally long chains of a template the first
in the file is its span. A very long text is streamed by one task, with some 50 bytes a word. The score is the best
share of a template, and 0.5 at least where a phrase stands. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm.words import LETTERS_AND_DIGITS, LOWER, pieces, words_of

#: words of a match that may be part of a chain
LEAST_MATCH = 4
#: words of a file that may lie between two matches of a chain
GAP = 30
#: share of a template that a chain has to cover to give its label
COVERED = 0.5

# fixed values: the phrases of the contract and their labels
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# fixed values: well-known license notices, as they stand at the head of files, and one-line statements
TEMPLATES = {
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files (the \"Software\"), to deal in the Software without restriction,"
        " including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,"
        " and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,"
        " subject to the following conditions: The above copyright notice and this permission notice shall be"
        " included in all copies or substantial portions of the Software."
        " THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT"
        " LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO"
        " EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER"
        " IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR"
        " THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
        " compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,"
        " software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR"
        " CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing"
        " permissions and limitations under the License."
    ),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License as published by the Free Software Foundation, either version 3 of the License,"
        " or (at your option) any later version. This program is distributed in the hope that it will be useful,"
        " but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A"
        " PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser"
        " General Public License as published by the Free Software Foundation; either version 2.1 of the License,"
        " or (at your option) any later version. This library is distributed in the hope that it will be useful,"
        " but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A"
        " PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."
    ),
    "agpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero"
        " General Public License as published by the Free Software Foundation, either version 3 of the License, or"
        " (at your option) any later version. This program is distributed in the hope that it will be useful, but"
        " WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR"
        " PURPOSE. See the GNU Affero General Public License for more details."
    ),
    "epl": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public"
        " License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met: Redistributions of source code must retain the above copyright"
        " notice, this list of conditions and the following disclaimer. Redistributions in binary form must"
        " reproduce the above copyright notice, this list of conditions and the following disclaimer in the"
        " documentation and/or other materials provided with the distribution."
    ),
    "bsd-3-clause": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or"
        " promote products derived from this software without specific prior written permission."
    ),
    "bsd-disclaimer": (
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED"
        " WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A"
        " PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR"
        " ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED"
        " TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)"
        " HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING"
        " NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE"
        " POSSIBILITY OF SUCH DAMAGE."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted, provided that the above copyright notice and this permission notice appear in all"
        " copies."
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the"
        " MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,"
        " publish, use, compile, sell, or distribute this software, either in source code form or as a compiled"
        " binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "cc-by": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ),
    "cc-by-nc": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa": "Licensed under CC BY-SA 4.0.",
}


class SuffixAutomaton:
    """All runs of words of several templates: states with links, longest lengths and transitions."""

    def __init__(self, templates: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        #: (template, number of its words up to here) pairs that end in the state itself
        ends: list[list[tuple[int, int]]] = [[]]
        for number, words in enumerate(templates):
            last = 0
            for place, word in enumerate(words, 1):
                last = self._grow(last, word, ends)
                ends[last].append((number, place))
        # a state's places are also places of the states it links to
        self.ends = ends
        for state in sorted(range(len(self.link)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.ends[self.link[state]] = sorted({*self.ends[self.link[state]], *self.ends[state]})

    def _grow(self, last: int, word: int, ends: list) -> int:
        if word in self.next[last]:
            old = self.next[last][word]
            return old if self.length[old] == self.length[last] + 1 else self._split(last, word, old, ends)
        state = self._state(self.length[last] + 1, {}, ends)
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at < 0:
            self.link[state] = 0
        else:
            old = self.next[at][word]
            self.link[state] = old if self.length[old] == self.length[at] + 1 else self._split(at, word, old, ends)
        return state

    def _state(self, length: int, after: dict[int, int], ends: list) -> int:
        self.next.append(after)
        self.link.append(0)
        self.length.append(length)
        ends.append([])
        return len(self.link) - 1

    def _split(self, at: int, word: int, old: int, ends: list) -> int:
        """A state of its own for the shorter of the runs that ``old`` stands for."""
        state = self._state(self.length[at] + 1, dict(self.next[old]), ends)
        self.link[state], self.link[old] = self.link[old], state
        while at >= 0 and self.next[at].get(word) == old:
            self.next[at][word] = state
            at = self.link[at]
        return state

    def statistics(self, words: list[int]) -> Iterator[tuple[int, int]]:
        """(state, length) of the longest run of a template that ends at each word."""
        state, length = 0, 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            else:
                state, length = 0, 0
            yield state, length


def _places(row: Sequence, known: set) -> int:
    """The places of what is not known, as bits."""
    return sum(1 << place for place, what in enumerate(row) if what not in known)


class Scanner:
    """The automaton of the templates and phrases, over the hashes of their words."""

    def __init__(self, templates: Mapping[str, str | Sequence[str]], phrases: Mapping[str, str]):
        """A label may have one template or several."""
        wordings = {label: [own] if isinstance(own, str) else list(own) for label, own in templates.items()}
        texts = [*(text for own in wordings.values() for text in own), *phrases]
        joined = "".join(texts).encode()
        edges = np.cumsum([0, *(len(text.encode()) for text in texts)])
        words = words_of(np.frombuffer(joined, np.uint8), edges, LETTERS_AND_DIGITS, LOWER)
        self.known = np.unique(words.hashes)
        ids = np.searchsorted(self.known, words.hashes)
        rows = [ids[words.first[i] : words.first[i + 1]].tolist() for i in range(len(texts))]
        self.labels = [label for label, own in wordings.items() for _ in own]
        self.sizes = [len(row) for row in rows[: len(self.labels)]]
        #: shortest run of known words that can hold a phrase or a match
        self.least = min([LEAST_MATCH, *(len(row) for row in rows if row)])
        #: template -> for each other one that lacks words of it, or else pairs of words, their places as bits
        self.telling: list[tuple[list[int], list[int]]] = []
        for number, row in enumerate(rows[: len(self.labels)]):
            words_of_it, pairs_of_it = set(), set()
            for other, own in enumerate(rows[: len(self.labels)]):
                if other == number or self.labels[other] == self.labels[number]:
                    continue
                mask = _places(row, set(own))
                if mask:
                    words_of_it.add(mask)
                else:
                    pairs_of_it.add(_places(list(zip(row, row[1:])), set(zip(own, own[1:]))))
            self.telling.append((sorted(words_of_it), sorted(pairs_of_it - {0})))
        self.phrase_labels = list(phrases.values())
        self.automaton = SuffixAutomaton(rows)
        #: state -> (phrase, its length) of the phrases that a match of that length in the state ends with
        self.phrases_at: dict[int, list[tuple[int, int]]] = {}
        #: the same for templates shorter than a match: (state of the template, its length)
        self.short_at: dict[int, list[tuple[int, int]]] = {}
        whole, short = {}, {}
        for number, row in enumerate(rows, -len(self.labels)):
            if not row or (number < 0 and len(row) >= LEAST_MATCH):
                continue
            for state, _ in self.automaton.statistics(row):
                pass
            if number < 0:
                short[state] = [(state, len(row))]
            else:
                whole.setdefault(state, []).append((number, len(row)))
        for ends, wanted in ((self.phrases_at, whole), (self.short_at, short)):
            for state in range(len(self.automaton.link)):
                at, found = state, []
                while at > 0:
                    found += wanted.get(at, [])
                    at = self.automaton.link[at]
                if found:
                    ends[state] = found

    def run(self, words: list[int], start: int, places: list, matches: list) -> None:
        """Adds the phrases' (start, phrase) and the long matches of one run of known words."""
        held = (0, 0)
        at = start
        for state, length in self.automaton.statistics(words):
            if length <= held[1] and held[1] >= LEAST_MATCH:
                matches.append((at - held[1], held[1], held[0]))
            held = (state, length)
            for phrase, size in self.phrases_at.get(state, ()):
                if length >= size:
                    places.append((at - size + 1, phrase))
            for own, size in self.short_at.get(state, ()):
                if length >= size:
                    matches.append((at - size + 1, size, own))
            at += 1
        if held[1] >= LEAST_MATCH:
            matches.append((at - held[1], held[1], held[0]))

    def chain(self, matches: list[tuple[int, int, int]], covered: float) -> tuple[dict[int, tuple], float]:
        """Template -> (share of its words that its best chain covers, first and end word in the file), best share.

        Only chains that cover a share of ``covered`` and tell the template from the others are returned.
        """
        by_template: dict[int, set] = {}
        for first, size, state in matches:
            for template, end in self.automaton.ends[state]:
                if template < len(self.labels) and size >= min(LEAST_MATCH, self.sizes[template]):
                    by_template.setdefault(template, set()).add((first, end - size, size))
        best, top = {}, 0.0
        for template, parts in by_template.items():
            ordered = sorted(parts)
            telling_words, telling_pairs = self.telling[template]
            covers: list[tuple[int, int, int, int]] = []
            for at, (first, place, size) in enumerate(ordered):
                own, own_pairs = ((1 << size) - 1) << place, ((1 << size - 1) - 1) << place
                cover, begin, places, pairs = size, first, own, own_pairs
                for before in range(at - 1, -1, -1):
                    first0, place0, size0 = ordered[before]
                    if first - first0 > GAP + self.sizes[template]:
                        break
                    overlap = max(0, first0 + size0 - first, place0 + size0 - place)
                    if first0 < first and place0 < place and first - first0 - size0 <= GAP and overlap < size:
                        if covers[before][0] + size - overlap > cover:
                            cover, begin = covers[before][0] + size - overlap, covers[before][1]
                            places, pairs = covers[before][2] | own, covers[before][3] | own_pairs
                covers.append((cover, begin, places, pairs))
                share = min(1.0, cover / self.sizes[template])
                top = max(top, share)
                tells = all(places & mask for mask in telling_words) and all(pairs & mask for mask in telling_pairs)
                if share >= covered and share > best.get(template, (0.0,))[0] and tells:
                    best[template] = (share, begin, first + size)
        return best, top


def _scan_rows(scanner: Scanner, covered: float):
    labels = scanner.labels

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, data, offsets in pieces(batch.column("text")):
                words = words_of(data, offsets, LETTERS_AND_DIGITS, LOWER)
                at = np.minimum(np.searchsorted(scanner.known, words.hashes), len(scanner.known) - 1)
                known = np.flatnonzero(scanner.known[at] == words.hashes)
                text = words.text_of()[known]
                cut = np.flatnonzero((np.diff(known) != 1) | (np.diff(text) != 0)) + 1
                edges = np.concatenate([[0], cut, [len(known)]])
                long_ = np.flatnonzero(np.diff(edges) >= scanner.least)
                found: dict[int, tuple[list, list]] = {}
                for low, high in zip(edges[long_].tolist(), edges[long_ + 1].tolist(), strict=True):
                    row = int(text[low])
                    places, matches = found.setdefault(row, ([], []))
                    first = int(known[low] - words.first[row])
                    scanner.run(at[known[low:high]].tolist(), first, places, matches)
                count = end - begin
                n_base, first_word, last_word = [0] * count, [None] * count, [None] * count
                base, every, score, spans = [""] * count, [""] * count, [0.0] * count, [[] for _ in range(count)]
                for row, (places, matches) in found.items():
                    good, share = scanner.chain(matches, covered) if matches else ({}, 0.0)
                    base_set = {scanner.phrase_labels[phrase] for _, phrase in places}
                    if places:
                        n_base[row] = len(places)
                        first_word[row], last_word[row] = min(places)[0], max(places)[0]
                    spans[row] = [
                        {"label": labels[t], "share": c[0], "first": c[1], "end": c[2]} for t, c in sorted(good.items())
                    ]
                    base[row] = ",".join(sorted(base_set))
                    every[row] = ",".join(sorted(base_set | {labels[t] for t in good}))
                    score[row] = max(share, 0.5) if base_set else share
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(begin, count),
                        pa.array(words.counts(), pa.int64()),
                        pa.array(n_base, pa.int64()),
                        pa.array(first_word, pa.int64()),
                        pa.array(last_word, pa.int64()),
                        pa.array(base, pa.string()),
                        pa.array(every, pa.string()),
                        pa.array(score, pa.float64()),
                        pa.array(spans, _SPANS),
                    ],
                    ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"],
                )

    return rows


_SPANS = pa.list_(
    pa.struct([("label", pa.string()), ("share", pa.float64()), ("first", pa.int64()), ("end", pa.int64())])
)
SCANNED = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string,"
    " score double, spans array<struct<label: string, share: double, first: bigint, end: bigint>>"
)


def scan_licenses(
    docs: DataFrame,
    templates: Mapping[str, str | Sequence[str]] = TEMPLATES,
    phrases: Mapping[str, str] = PHRASES,
    covered: float = COVERED,
) -> DataFrame:
    """Phrases, labels, score and the covered spans (in words) of every document."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(_scan_rows(Scanner(templates, phrases), covered), SCANNED)


def op10_licenses(spark, sf_dir):
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("spans")
