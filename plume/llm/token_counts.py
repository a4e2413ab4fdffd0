"""Token counts by prefix dynamic programming.

For every prefix of a word the program keeps the last token and the exact
number of tokens; a text's counts are the running sums over its words.  So a
table answers "how many tokens has this prefix" and "where must this text be
cut for a budget" without encoding anything again.

Cases: a null or empty text has 0 tokens; special strings of the vocabulary
inside a text count as one token; repeated rows give repeated results; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import MergeTable, fold, merge_table
from .common import pick, text_groups
from .words import WordCache, cut, segments

_CACHES: dict[str, WordCache] = {}


def _cache(path: str) -> WordCache:
    if path not in _CACHES:
        table = merge_table(path)
        _CACHES[path] = WordCache(lambda words: [table.prefix_counts(w.encode(), every=False)[0] for w in words])
    return _CACHES[path]


def count_texts(texts: list[str | None], path: str) -> np.ndarray:
    """Exact token count of each text."""
    table = merge_table(path)
    parts, owner = [], []
    out = np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        for k, s in enumerate(segments(t or "", table.special_split)):
            if k % 2:
                out[i] += 1
            elif s:
                parts.append(fold(s))
                owner.append(i)
    if parts:
        values, which, bounds = _cache(path).lookup(parts, joins_space=False)
        running = np.concatenate([[0], np.cumsum(np.array(values, np.int64)[which])])
        np.add.at(out, owner, running[bounds[1:]] - running[bounds[:-1]])
    return out


@dataclass
class PrefixTable:
    """Token counts at every prefix of one text in the vocabulary's normal form (``text``)."""

    text: str
    starts: np.ndarray   # of words and special strings
    ends: np.ndarray
    running: np.ndarray  # tokens before each of them, and in all
    table: MergeTable
    special: set[int]    # places of special strings

    def count(self, length: int) -> int:
        """Tokens of ``text[:length]``."""
        k = int(np.searchsorted(self.ends, length, side="right"))
        total = int(self.running[k])
        if k < len(self.starts) and self.starts[k] < length:
            total += self._within(self.text[self.starts[k]:length])
        return total

    def _within(self, part: str) -> int:
        joined, starts, ends, _, _ = cut([part], joins_space=False)
        return sum(self.table.prefix_counts(joined[a:b].encode(), every=False)[0] for a, b in zip(starts, ends, strict=True))

    def longest_within(self, budget: int) -> int:
        """The largest length such that ``text[:length]`` has at most ``budget`` tokens.

        Counts never fall from word to word, so it lies in the first word that
        goes beyond the budget; there the counts of the word's prefixes, each
        stored by the program, give it.  A special string is taken whole.
        """
        k = int(np.searchsorted(self.running, budget, side="right")) - 1
        if k < 0:
            return 0
        if k >= len(self.starts):
            return len(self.text)
        start, end = int(self.starts[k]), int(self.ends[k])
        if k in self.special:
            return start
        word, left = self.text[start:end], budget - int(self.running[k])
        counts = self._prefixes(word)
        inside = max((n for n, c in enumerate(counts, 1) if c <= left), default=0)
        return start + inside

    def _prefixes(self, word: str) -> list[int]:
        """Tokens of word[:1], ..., word[:n]; a contraction's prefixes are cut anew, as its letters alone are a word."""
        if word[0] == "'" and len(word) > 1:
            return [self._within(word[:n]) for n in range(1, len(word) + 1)]
        by_byte = self.table.prefix_counts(word.encode())
        return [by_byte[at - 1] for at in np.cumsum([len(c.encode()) for c in word]).tolist()]


def prefix_table(text: str | None, path: str) -> PrefixTable:
    table = merge_table(path)
    starts, ends, counts, special, at, whole = [], [], [], set(), 0, []
    for k, s in enumerate(segments(text or "", table.special_split)):
        s = s if k % 2 else fold(s)
        whole.append(s)
        if k % 2:
            special.add(len(starts))
            starts.append(at)
            ends.append(at + len(s))
            counts.append(1)
        elif s:
            _, a, b, _, _ = cut([s], joins_space=False)
            values, which, _ = _cache(path).lookup([s], joins_space=False)
            starts += (a + at).tolist()
            ends += (b + at).tolist()
            counts += [values[i] for i in which.tolist()]
        at += len(s)
    running = np.concatenate([[0], np.cumsum(np.array(counts, np.int64))]).astype(np.int64)
    return PrefixTable("".join(whole), np.array(starts, np.int64), np.array(ends, np.int64), running, table, special)


def truncated(docs: DataFrame, vocabulary: str, budgets: list[int]) -> DataFrame:
    """doc_id, budget, n_chars, n_tokens, text: the longest beginning of each text with at most ``budget`` tokens, a row a budget.

    ``n_tokens`` counts that beginning, and ``text`` is it in the vocabulary's
    normal form.  All budgets are answered from one prefix table of the text;
    nothing is encoded.  Blanks that follow cost no token and belong to it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_groups(batches):
            rows = []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), texts, strict=True):
                table = prefix_table(text, vocabulary)
                for budget in budgets:
                    n = table.longest_within(budget)
                    rows.append((doc_id, budget, n, table.count(n), table.text[:n]))
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                                 ["doc_id", "budget", "n_chars", "n_tokens", "text"])

    return pick(docs, "doc_id", "text").mapInArrow(run, "doc_id long, budget long, n_chars long, n_tokens long, text string")


def token_counts(docs: DataFrame, vocabulary: str, limit: int) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit) of every whole text.

    ``vocabulary`` is the path of a word-level BPE file, the same on every node.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_groups(batches):
            counts = count_texts(texts, vocabulary)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([len(t.encode()) if t else 0 for t in texts], pa.int64()),
                 pa.array(counts, pa.int64()), pa.array(counts > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return pick(docs, "doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
