"""License scans: matching statistics against a generalised suffix automaton of licence texts, chained into spans."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tallywatch.llm import common

# The phrases every scan looks for, with their labels.
BASE_PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

# Public licence texts and notices, lower case, as label and text.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("no-warranty", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("rights-reserved", "all rights reserved"),
]

#: Shortest run of words that counts as a piece of a template; whole templates count however short.
LEAST_MATCH = 4
#: Words of a template that a text may leave out or change between two chained pieces.
MOST_GAP = 12
#: Share of a template that a chain must cover to give its label.
LEAST_COVERAGE = 0.6

_WORD_BYTES = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_SPACED = bytes(b if b in _WORD_BYTES else 0x20 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) runs of digits, letters and all that is not ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_SPACED).split()


@dataclass
class Automaton:
    """All word runs of all templates as one automaton; a state's ``ends`` are the places where its runs end."""

    words: dict[bytes, int]
    lengths: list[int]
    labels: list[str]
    next: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    longest: list[int] = field(default_factory=lambda: [0])
    ends: list[set] = field(default_factory=lambda: [set()])
    phrases: list[tuple] = field(default_factory=list)
    runs: list[list] = field(default_factory=list)

    @classmethod
    def build(cls, templates: Iterable[tuple[str, str]], phrases: Iterable[tuple[str, str]]) -> Automaton:
        texts = [(label, words_of(text)) for label, text in templates]
        texts += [(label, words_of(text)) for text, label in phrases]
        words = {w: i for i, w in enumerate(dict.fromkeys(w for _, text in texts for w in text), 1)}
        made = cls(words, [len(t) for _, t in texts], [label for label, _ in texts])
        for k, (_, text) in enumerate(texts):
            last = 0
            for at, word in enumerate(text):
                last = made._extended(last, words[word])
                made.ends[last].add((k, at))
        made._spread_ends()
        made._mark_runs([[words[w] for w in text] for _, text in texts])
        made._mark_phrases([(words_of(p), label) for p, label in phrases])
        return made

    def _state(self, longest: int, moves: dict, link: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.longest.append(longest)
        self.ends.append(set())
        return len(self.next) - 1

    def _split(self, before: int, word: int, state: int) -> int:
        """The part of ``state`` whose runs are no longer than those after ``before``, as a state of its own."""
        part = self._state(self.longest[before] + 1, dict(self.next[state]), self.link[state])
        self.link[state] = part
        while before >= 0 and self.next[before].get(word) == state:
            self.next[before][word] = part
            before = self.link[before]
        return part

    def _extended(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            return known if self.longest[known] == self.longest[last] + 1 else self._split(last, word, known)
        new = self._state(self.longest[last] + 1, {}, 0)
        before = last
        while before >= 0 and word not in self.next[before]:
            self.next[before][word] = new
            before = self.link[before]
        if before >= 0:
            state = self.next[before][word]
            self.link[new] = state if self.longest[state] == self.longest[before] + 1 else self._split(before, word, state)
        return new

    def _spread_ends(self) -> None:
        for s in sorted(range(1, len(self.next)), key=lambda s: -self.longest[s]):
            if self.link[s] > 0:
                self.ends[self.link[s]] |= self.ends[s]
        self.ends = [sorted(x) for x in self.ends]

    def _mark_runs(self, texts: list[list[int]]) -> None:
        """``runs`` of a state: (template, length, ends, words after them) of each template's longest run that ends there.

        A template that has the state's own run is listed with length 0: that of the run in the text. The others come from the
        suffixes behind the state's links. Runs too short to count are left out.
        """
        self.runs = []
        for s in range(len(self.next)):
            listed: list[tuple] = []
            known: set[int] = set()
            at = s
            while at > 0:
                places: dict[int, list[int]] = {}
                for k, place in self.ends[at]:
                    if k not in known:
                        places.setdefault(k, []).append(place)
                for k, where in places.items():
                    if self.longest[at] >= min(LEAST_MATCH, self.lengths[k]):
                        after = frozenset(texts[k][p + 1] for p in where if p + 1 < len(texts[k]))
                        listed.append((k, 0 if at == s else self.longest[at], tuple(where), after))
                known |= places.keys()
                at = self.link[at]
            self.runs.append(listed)

    def _mark_phrases(self, phrases: list[tuple[list[bytes], str]]) -> None:
        own: dict[int, list] = {}
        for words, label in phrases:
            state = 0
            for w in words:
                state = self.next[state][self.words[w]]
            own.setdefault(state, []).append((len(words), label))
        self.phrases = [()] * len(self.next)
        for s in sorted(range(1, len(self.next)), key=lambda s: self.longest[s]):
            self.phrases[s] = (*own.get(s, ()), *self.phrases[self.link[s]])

    def statistics(self, text: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """(position, state, length) of the longest template run that ends at each known word."""
        state = length = 0
        known, moves, link, longest = self.words.get, self.next, self.link, self.longest
        for at, word in enumerate(text):
            w = known(word)
            if w is None:
                state = length = 0
                continue
            while state and w not in moves[state]:
                state = link[state]
                length = longest[state]
            if w in moves[state]:
                state = moves[state][w]
                length += 1
                yield at, state, length


def _matches(automaton: Automaton, text: list[bytes], found: dict[str, list]) -> Iterator[tuple[int, int, int, tuple[int, ...]]]:
    """Each template's longest matches that it can't make longer on the right, as (end, template, length, ends in the template).

    A run goes on in one template and stops in another; each template's matches are those it would have alone. Base phrases
    go to ``found``.
    """
    for at, state, length in automaton.statistics(text):
        for size, label in automaton.phrases[state]:
            if length >= size:
                found.setdefault(label, []).append(at - size + 1)
        if runs := automaton.runs[state]:
            after = automaton.words.get(text[at + 1]) if at + 1 < len(text) else None
            for k, size, places, goes_on in runs:
                size = size or length
                if after not in goes_on and size >= min(LEAST_MATCH, automaton.lengths[k]):
                    yield at, k, size, places


def scan(automaton: Automaton, text: list[bytes]) -> tuple[dict[str, list[int]], list[tuple[int, int, int, float]]]:
    """Starts of the base phrases by label, and spans (template, first word, last word, covered share)."""
    found: dict[str, list[int]] = {}
    chains: dict[int, list[int]] = {}  # by template: first word, last word, last template word, words covered
    spans: list[tuple[int, int, int, float]] = []

    def close(k: int) -> None:
        first, last, _, covered = chains.pop(k)
        if covered >= LEAST_COVERAGE * automaton.lengths[k]:
            spans.append((k, first, last, covered / automaton.lengths[k]))

    for end, k, length, places in _matches(automaton, text, found):
        seen = False
        for place in places:
            chain = chains.get(k)
            if chain:
                start, new = end - length + 1, place - chain[2]
                if place > chain[2] and start - chain[1] <= MOST_GAP and place - length - chain[2] <= MOST_GAP:
                    chains[k] = [chain[0], end, place, chain[3] + min(length, new)]
                    seen = True
                    continue
                if seen:
                    continue
                close(k)
            chains[k] = [end - length + 1, end, place, length]
            seen = True
    for k in list(chains):
        close(k)
    return found, sorted(spans, key=lambda s: (s[1], s[2], s[0]))


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans array<struct<label: string, first: long, last: long, covered: double>>"
)
_SPAN = pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("covered", pa.float64())])
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(_SPAN)),
])


def scan_documents(docs: DataFrame, templates=TEMPLATES, phrases=BASE_PHRASES) -> DataFrame:
    """One row per document: places of the base phrases, labels, covered template spans and the best covered share.

    Whole texts are read word by word on a narrow map, without a shuffle. A null text is empty; every row of the input,
    repeated or with a null doc_id, gives one row; an empty table gives none; other columns are ignored.
    """
    automaton = Automaton.build(templates, phrases)

    def row(doc_id: int, text: str | None) -> tuple:
        words = words_of(text)
        found, spans = scan(automaton, words)
        places = [p for starts in found.values() for p in starts]
        labels = set(found) | {automaton.labels[k] for k, *_ in spans}
        score = max((covered for *_, covered in spans), default=0.0)
        return (
            doc_id, len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(found)),
            ",".join(sorted(labels)), min(1.0, score),
            [{"label": automaton.labels[k], "first": a, "last": b, "covered": c} for k, a, b, c in spans],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from common.arrow_batches((row(*x) for x in common.arrow_rows(batches, ["doc_id", "text"])), _ARROW)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_documents(common.table(spark, sf_dir, "documents")).drop("spans")
