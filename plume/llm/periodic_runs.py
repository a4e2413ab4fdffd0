"""Periodic runs of words by an enhanced suffix array.

A run is a maximal stretch of words with smallest period q.  Its last square
(two periods, where the word after breaks the period) is a *branching tandem*:
the suffixes at its two halves share exactly q words, so both lie in the LCP
interval of depth q, in different children.  For every LCP interval the
suffixes of all but the largest child are tested: is the suffix one depth
ahead, or behind, in the same interval (its rank, ISA[i +- depth], between the
interval's bounds) and in another child?  A third period in front is one more
rank look-up.  The branching squares found are rotated to the left as long as
the word before equals the word one period on, and what belongs to one run is
merged.  Intervals are bounds in the arrays; no suffix tree is built.

The arrays are numpy: suffixes are ranked by prefix doubling, the rank levels
give the LCP values.  Words are numbered within their document, so one array
serves a whole batch of documents.  Every ``_GRAM`` consecutive words of a
long enough run occur twice in its document; the words outside such repeats
are replaced by one mark before sorting, which loses no run.

Cases: a null or empty text has no words, no run and an empty collapsed text;
a null doc_id is never edited by the query; ties go to the smaller start, then
the smaller period; repeated rows give repeated results; an empty table gives
an empty result; very long texts are taken whole; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import pick, text_groups

LEAST_LENGTH = 24
LEAST_PERIODS = 3
_GRAM = 8  # runs of 24 words and three periods hold each of their 8-grams twice


def _pairs(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Dense numbers of the pairs (left, right), in the order of the pairs."""
    return np.unique(left.astype(np.int64) << 32 | right, return_inverse=True)[1]


def _ahead(ranks: np.ndarray, step: int) -> np.ndarray:
    """Rank plus one of the place ``step`` on; 0 beyond the end."""
    out = np.zeros(len(ranks), np.int64)
    if step < len(ranks):
        out[:len(ranks) - step] = ranks[step:] + 1
    return out


def _repeated(words: np.ndarray) -> np.ndarray:
    """Whether each word lies in some ``_GRAM`` consecutive words that occur twice."""
    grams, step = words, 1
    while step < _GRAM:
        grams = pd.factorize(grams.astype(np.int64) << 32 | _ahead(grams, step))[0]
        step *= 2
    twice = np.flatnonzero(np.bincount(grams, minlength=1)[grams] > 1)
    cover = np.zeros(len(words) + _GRAM, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + _GRAM, -1)
    return np.cumsum(cover)[:len(words)] > 0


def suffix_ranks(words: np.ndarray) -> list[np.ndarray]:
    """Ranks of the first 1, 2, 4, ... words of each suffix, up to where all differ."""
    levels, step = [np.unique(words, return_inverse=True)[1]], 1
    while len(words) and levels[-1].max() + 1 < len(words):
        levels.append(_pairs(levels[-1], _ahead(levels[-1], step)))
        step *= 2
    return levels


def _shared(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of words that the suffixes at ``a`` and ``b`` have in common."""
    n = len(levels[0])
    length = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + length, b + length
        inside = (x < n) & (y < n)
        same = inside & (levels[k][np.minimum(x, n - 1)] == levels[k][np.minimum(y, n - 1)])
        length += same * (1 << k)
    return length


def lcp_intervals(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(depth, first rank, last rank) of the LCP intervals, and the interval that each place of ``lcp`` splits.

    ``lcp[m]`` belongs to ranks m - 1 and m; ``lcp[0]`` is not used.
    """
    depth, first, last = [], [], []
    splits = np.zeros(len(lcp), np.int64)
    open_: list[int] = []
    values = lcp.tolist()
    for m in range(1, len(values)):
        v, left = values[m], m - 1
        while open_ and depth[open_[-1]] > v:
            left = first[open_[-1]]
            last[open_.pop()] = m - 1
        if not open_ or depth[open_[-1]] < v:
            open_.append(len(depth))
            depth.append(v)
            first.append(left)
            last.append(-1)
        splits[m] = open_[-1]
    for k in open_:
        last[k] = len(values) - 1
    return np.array(depth, np.int64), np.array(first, np.int64), np.array(last, np.int64), splits


def branching_cubes(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, d): words[i:i+2d] is a square that one more period precedes and the next word breaks."""
    levels = suffix_ranks(words)
    rank = levels[-1]
    order = np.argsort(rank)
    lcp = np.concatenate([[0], _shared(levels, order[:-1], order[1:])])
    depth, first, last, splits = lcp_intervals(lcp)

    # children of every interval: from its first rank, or a split, to the next split or its last rank
    at = np.arange(1, len(words))
    owner = np.concatenate([np.arange(len(depth)), splits[1:]])
    begin = np.concatenate([first, at])
    by = np.lexsort((begin, owner))
    owner, begin = owner[by], begin[by]
    end = np.append(begin[1:], 0)
    closing = np.append(owner[1:] != owner[:-1], True)
    end[closing] = last[owner[closing]] + 1
    size = end - begin
    largest = np.zeros(len(owner), bool)
    largest[pd.Series(size).groupby(owner).idxmax().to_numpy()] = True
    use = ~largest & (depth[owner] > 0)
    owner, begin, end, size = owner[use], begin[use], end[use], size[use]

    # every suffix of the smaller children
    total = int(size.sum())
    child = np.repeat(np.arange(len(size)), size)
    ranks = np.arange(total) - np.repeat(np.cumsum(size) - size, size) + begin[child]
    s, d = order[ranks], depth[owner[child]]
    low, high, child_low, child_high = first[owner[child]], last[owner[child]], begin[child], end[child]
    n = len(words)

    def rank_at(place: np.ndarray) -> np.ndarray:
        return np.where((place >= 0) & (place < n), rank[np.clip(place, 0, n - 1)], -1)

    def inside(r: np.ndarray) -> np.ndarray:
        return (r >= low) & (r <= high)

    def other(r: np.ndarray) -> np.ndarray:
        return inside(r) & ((r < child_low) | (r >= child_high))

    front = other(rank_at(s + d)) & inside(rank_at(s - d))
    back = other(rank_at(s - d)) & inside(rank_at(s - 2 * d))
    found = np.unique(np.stack([np.concatenate([s[front], (s - d)[back]]), np.concatenate([d[front], d[back]])]), axis=1)
    return found[0], found[1]


def _rotated(words: np.ndarray, i: int, d: int) -> int:
    """Start of the run whose square begins at ``i``: the word before equals the word one period on."""
    step = 64
    while i > 0:
        k = min(step, i)
        differ = np.flatnonzero(words[i - k:i] != words[i - k + d:i + d])
        if len(differ):
            return i - k + int(differ[-1]) + 1
        i, step = i - k, step * 2
    return 0


def runs_of(texts: list[list], least_length: int = LEAST_LENGTH, least_periods: int = LEAST_PERIODS) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each word list, by start, then period."""
    if least_length < LEAST_LENGTH or least_periods < LEAST_PERIODS:
        raise ValueError(f"runs of at least {LEAST_LENGTH} words and {LEAST_PERIODS} periods are found")
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    flat = [w for t in texts for w in t]
    if len(flat) < least_length:
        return out
    doc = np.repeat(np.arange(len(texts)), sizes)
    codes = np.empty(len(flat), object)
    codes[:] = flat
    words = pd.factorize(pd.factorize(codes)[0].astype(np.int64) << 32 | doc)[0]  # equal words of two documents differ
    places = np.flatnonzero(_repeated(words))
    if not len(places):
        return out
    # a mark of its own after each stretch of what is left
    stretch_end = np.append((np.diff(places) > 1) | (np.diff(doc[places]) > 0), True)
    new = np.arange(len(places)) + np.cumsum(stretch_end) - stretch_end
    text = np.empty(len(places) + int(stretch_end.sum()), np.int64)
    origin = np.zeros(len(text), np.int64)
    text[new], origin[new] = words[places], places
    marks = new[stretch_end] + 1
    text[marks] = len(flat) + np.arange(len(marks))

    first_word = np.cumsum(sizes) - sizes
    at, periods = branching_cubes(text)
    by = np.lexsort((at, periods))
    ends: dict[int, list[tuple[int, int]]] = {}
    for i, d in zip(at[by].tolist(), periods[by].tolist(), strict=True):
        same_end = ends.setdefault(i + 2 * d, [])
        if any(d % q == 0 and start <= i for q, start in same_end):
            continue  # the square of a multiple of that run's period
        start = _rotated(text, i, d)
        same_end.append((d, start))
        length = i + 2 * d - start
        if length >= max(least_length, least_periods * d):
            k = int(doc[origin[start]])
            out[k].append((int(origin[start] - first_word[k]), length, d))
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in out]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length / period; ties: smallest start, then period."""
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that some run holds after its first period."""
    cover = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        cover[start + period] += 1
        cover[start + length] -= 1
    return [w for w, c in zip(words, np.cumsum(cover).tolist(), strict=False) if not c] if runs else words


def looped(words: list, doc_id: int | None) -> list:
    """The query's edited words: those of every tenth document (by crc32 of the id) repeat a stretch to the end."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


_SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
           "runs_sha256 string, collapsed_sha256 string")
_TEXTS = ", runs array<struct<start: long, length: long, period: long>>, collapsed string"


def periodic_runs(docs: DataFrame, edit: Callable[[list, int | None], list] | None = None, texts_too: bool = False) -> DataFrame:
    """doc_id, number of runs, the strongest run, digests of all runs and of the collapsed text of every document.

    ``edit`` changes a document's words before the search; ``texts_too`` adds
    the runs themselves and the collapsed text.
    """
    schema = _SCHEMA + (_TEXTS if texts_too else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for part, texts in text_groups(batches):
            ids = part.column("doc_id").to_pylist()
            words = [(t or "").encode().split() for t in texts]
            if edit:
                words = [edit(w, i) for w, i in zip(words, ids, strict=True)]
            rows = []
            for doc_id, own, runs in zip(ids, words, runs_of(words), strict=True):
                best = strongest(runs)
                kept = b" ".join(collapsed(own, runs))
                row = {"doc_id": doc_id, "n_runs": len(runs),
                       "runs_sha256": sha("".join([f"{s},{n},{q}\n" for s, n, q in runs]).encode()),
                       "collapsed_sha256": sha(kept)}
                if best:
                    row |= dict(zip(("start", "length", "period"), best, strict=True), exponent_milli=1000 * best[1] // best[2])
                if texts_too:
                    row |= {"runs": [{"start": s, "length": n, "period": q} for s, n, q in runs], "collapsed": kept.decode()}
                rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW_TEXTS if texts_too else _ARROW)

    return pick(docs, "doc_id", "text").mapInArrow(run, schema)


_ARROW = pa.schema([*[(c, pa.int64()) for c in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli")],
                    ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])
_ARROW_TEXTS = _ARROW.append(pa.field("runs", pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])))) \
    .append(pa.field("collapsed", pa.string()))
