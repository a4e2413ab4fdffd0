"""License scans with a generalised suffix automaton of license words.

One automaton holds all templates and phrases as word sequences.  Streaming a
text through it gives matching statistics: at each word, the longest run of
words ending there that stands in some template.  A phrase occurs where the
state or one of its suffix links ends that phrase.  Runs that cannot grow and
have ``least_run`` words or more are chained per template in reading order
into spans; a span that covers enough of its template gives the template's
label.

Cases: a null or empty text has no words, labels or spans and score 0; a text
may carry several labels; repeated rows give repeated results; very long texts
are streamed whole; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import pick, text_groups

#: Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Notices of well-known licenses and their labels.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
                   "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
]

_SEPARATORS = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def license_words(text: str | None) -> list[bytes]:
    """Runs of digits, a-z and characters beyond ASCII, after lower-casing A-Z."""
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_SEPARATORS).split()


@dataclass
class Scan:
    n_words: int = 0
    places: list[tuple[str, int]] = field(default_factory=list)           # (phrase label, first word)
    spans: list[tuple[str, int, int, float]] = field(default_factory=list)  # (label, first word, end, share covered)


class LicenseAutomaton:
    def __init__(self, templates: list[tuple[str, str]] = TEMPLATES, phrases: dict[str, str] = PHRASES,
                 least_run: int = 3, least_share: float = 0.6, most_gap: int = 8):
        self.least_run, self.least_share, self.most_gap = least_run, least_share, most_gap
        self.templates = [(label, license_words(text)) for label, text in templates]
        self.phrases = [(label, license_words(text)) for text, label in phrases.items()]
        self.ids: dict[bytes, int] = {}
        for _, words in self.templates + self.phrases:
            for w in words:
                self.ids.setdefault(w, len(self.ids) + 1)
        self.next: list[dict[int, int]] = [{}]
        self.link, self.longest = [-1], [0]
        self.ends: list[list[tuple[int, int]]] = [[]]  # (template, words before the end), own ends only
        for t, (_, words) in enumerate(self.templates + self.phrases):
            last = 0
            for k, w in enumerate(words):
                last = self._extend(last, self.ids[w])
                self.ends[last].append((t, k + 1))
        self._spread_ends()
        self.phrase_at: list[list[tuple[str, int]]] = [[] for _ in self.next]
        for label, words in self.phrases:
            state = 0
            for w in words:
                state = self.next[state][self.ids[w]]
            self.phrase_at[state].append((label, len(words)))

    def _extend(self, last: int, word: int) -> int:
        """Append a word after the state of the sequence so far."""
        if word in self.next[last]:
            onto = self.next[last][word]
            return onto if self.longest[onto] == self.longest[last] + 1 else self._clone(last, word, onto)
        state = self._new(self.longest[last] + 1, {})
        at = last
        while at != -1 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at == -1:
            self.link[state] = 0
        else:
            onto = self.next[at][word]
            self.link[state] = onto if self.longest[onto] == self.longest[at] + 1 else self._clone(at, word, onto)
        return state

    def _new(self, longest: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(0)
        self.longest.append(longest)
        self.ends.append([])
        return len(self.next) - 1

    def _clone(self, at: int, word: int, onto: int) -> int:
        copy = self._new(self.longest[at] + 1, dict(self.next[onto]))
        self.link[copy], self.link[onto] = self.link[onto], copy
        while at != -1 and self.next[at].get(word) == onto:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def _spread_ends(self) -> None:
        """A state also ends where the states that link to it end."""
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.longest[s]):
            if self.link[state] > 0:
                self.ends[self.link[state]] += self.ends[state]
        self.ends = [sorted(set(e)) for e in self.ends]

    def scan(self, text: str | None) -> Scan:
        words = license_words(text)
        out = Scan(len(words))
        ids = np.fromiter(map(self.ids.get, words, repeat(0)), np.int64, len(words))
        known = np.flatnonzero((ids > 0) & (np.append(ids[1:], 0) > 0))  # followed by another known word
        if not len(known):
            return out
        runs = []
        breaks = np.flatnonzero(np.diff(known) > 1) + 1
        for part in np.split(known, breaks):
            runs += self._stream(ids[part[0]:part[-1] + 2].tolist(), int(part[0]), out.places)
        self._chain(runs, out.spans)
        return out

    def _stream(self, ids: list[int], at: int, places: list[tuple[str, int]]) -> list[tuple[int, int, int]]:
        """Matching statistics over known words; returns the runs that cannot grow: (end, length, state)."""
        state, length, runs = 0, 0, []
        for i, w in enumerate(ids):
            before = (at + i, length, state)
            while state and w not in self.next[state]:
                state = self.link[state]
                length = self.longest[state]
            if w in self.next[state]:
                state = self.next[state][w]
                length += 1
            if before[1] >= self.least_run and length <= before[1]:
                runs.append(before)
            up = state
            while up > 0:
                for label, size in self.phrase_at[up]:
                    if length >= size:
                        places.append((label, at + i + 1 - size))
                up = self.link[up]
        if length >= self.least_run:
            runs.append((at + len(ids), length, state))
        return runs

    def _chain(self, runs: list[tuple[int, int, int]], spans: list[tuple[str, int, int, float]]) -> None:
        """Join runs that follow one another in the text and in a template."""
        chains: dict[int, list[list[int]]] = {}  # by template: [first word, end, template end, words covered]
        for end, length, state in runs:
            for t, stop in self.ends[state]:
                if t >= len(self.templates):
                    continue
                best = None
                for c in reversed(chains.get(t, [])):
                    if end - length - c[1] > self.most_gap:
                        break
                    fresh = min(stop - c[2], end - c[1], length)
                    if fresh > 0 and stop > c[2] and (best is None or c[3] > best[0][3]):
                        best = (c, fresh)
                if best is None:
                    chains.setdefault(t, []).append([end - length, end, stop, length])
                else:
                    c, fresh = best
                    chains[t].append([c[0], end, stop, c[3] + fresh])
                    if len(chains[t]) > 64:  # chains that ended far behind cannot grow
                        chains[t] = [x for x in chains[t] if end - x[1] <= self.most_gap or self._share(t, x) >= self.least_share]
        found: dict[tuple[str, int], tuple[int, float]] = {}
        for t, own in chains.items():
            for c in own:
                share = self._share(t, c)
                if share >= self.least_share:
                    key = (self.templates[t][0], c[0])
                    if key not in found or found[key][1] < share:
                        found[key] = (c[1], share)
        spans += sorted((label, begin, end, share) for (label, begin), (end, share) in found.items())

    def _share(self, t: int, chain: list[int]) -> float:
        return min(1.0, chain[3] / len(self.templates[t][1]))


def license_scan(docs: DataFrame, automaton: LicenseAutomaton | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, and the spans (label, first word, end, share)."""
    machine = automaton or LicenseAutomaton()
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # a fixed set of templates

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
        span = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("share", pa.float64())])
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(span)]
        for part, texts in text_groups(batches):
            rows = []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), texts, strict=True):
                s = shared.value.scan(text)
                base = {label for label, _ in s.places}
                starts = [at for _, at in s.places]
                rows.append((doc_id, s.n_words, len(starts), min(starts, default=None), max(starts, default=None),
                             ",".join(sorted(base)), ",".join(sorted(base | {x[0] for x in s.spans})),
                             1.0 if base else max((x[3] for x in s.spans), default=0.0),
                             [dict(zip(("label", "first_word", "end_word", "share"), x, strict=True)) for x in s.spans]))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return pick(docs, "doc_id", "text").mapInArrow(
        run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
             "score double, spans array<struct<label string, first_word long, end_word long, share double>>")
