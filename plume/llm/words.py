"""Vectorized pre-tokenization and a bounded cache of encoded words.

A tokenizer's work on natural text repeats: most words of a batch have been
seen.  Texts are cut into words with array operations over code points, equal
words of a batch are grouped by a hash and then compared, and only words missing from the
worker's cache reach the encoder.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from functools import lru_cache

import numpy as np
import pandas as pd

SPACE, LETTER, DIGIT, OTHER, STOP = range(5)
_STOP_CODE = 0x110000
_APOSTROPHE = ord("'")


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of every code point: white space, letter, number, other."""
    import regex

    every = "".join(map(chr, range(_STOP_CODE)))
    out = np.full(_STOP_CODE + 1, OTHER, np.uint8)
    for kind, pattern in ((SPACE, r"\p{White_Space}+"), (LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+")):
        for m in regex.finditer(pattern, every):
            out[m.start():m.end()] = kind
    out[_STOP_CODE] = STOP
    return out


_PRIME = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_PRIME, _INVERSE)):
            row = np.full(n, base, np.uint64)
            row[0] = 1
            _POWERS[k] = np.multiply.accumulate(row)
    return _POWERS


def _word_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of codes[start:end] for every word."""
    up, down = _powers(len(codes) + 1)
    v = codes.astype(np.uint64)
    v *= np.uint64(0xBF58476D1CE4E5B9)
    v ^= v >> np.uint64(31)
    v *= np.uint64(0x94D049BB133111EB)
    v ^= v >> np.uint64(29)
    v *= up[:len(v)]
    total = np.zeros(len(v) + 1, np.uint64)
    np.cumsum(v, out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return h ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def cut(texts: list[str], joins_space: bool) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of ``texts``: (joined text, starts, ends, code points, first word of each text and the end).

    ``joins_space`` False: runs of letters, single numbers and runs of other
    characters; white space is dropped.  True: runs of letters, numbers or
    others with one space before them, and runs of white space.  Both split off
    the English contractions 's 't 're 've 'm 'll 'd.
    """
    joined = "\n".join(texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    stops = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))) - 1
    codes[stops] = _STOP_CODE
    kind = _classes()[codes]
    begin = np.empty(len(kind), bool)
    begin[0] = True
    np.not_equal(kind[1:], kind[:-1], out=begin[1:])
    begin[stops] = True
    if joins_space:
        after = np.flatnonzero((kind[1:] != SPACE) & (kind[1:] != STOP) & (kind[:-1] == SPACE)) + 1
        begin[after - 1] = True
        begin[after[codes[after - 1] == 32]] = False
    else:
        begin[kind == DIGIT] = True
    at = np.flatnonzero((codes == _APOSTROPHE) & begin)
    at = at[kind[at + 1] == LETTER]  # a text ends with a stop, so at + 1 exists
    if len(at):
        c1 = codes[at + 1]
        c2 = codes[np.minimum(at + 2, len(codes) - 1)]
        one = np.isin(c1, [ord(c) for c in "stmd"])
        two = (np.isin(c1, [ord("r"), ord("v")]) & (c2 == ord("e"))) | ((c1 == ord("l")) & (c2 == ord("l")))
        begin[at[one | two] + 1] = False
        begin[at[one] + 2] = True
        begin[at[two] + 3] = True
    starts = np.flatnonzero(begin)
    ends = np.append(starts[1:], len(codes))
    first = kind[starts]
    keep = (first != STOP) if joins_space else (first != STOP) & (first != SPACE)
    starts, ends = starts[keep], ends[keep]
    bounds = np.concatenate([[0], np.searchsorted(starts, stops)])
    return joined, starts, ends, codes, bounds


def _distinct(joined: str, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each word's distinct word, a word of each number).

    Words are grouped by their hash and compared, character by character, with
    the first of their group; those that differ from it are told apart by their text.
    """
    which, distinct = pd.factorize(_word_hashes(codes, starts, ends))
    first = np.empty(len(distinct), np.int64)
    first[which[::-1]] = np.arange(len(which) - 1, -1, -1)
    sizes, like = ends - starts, first[which]
    differs = sizes != sizes[like]
    sizes = np.where(differs, 0, sizes)
    within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    unequal = codes[np.repeat(starts, sizes) + within] != codes[np.repeat(starts[like], sizes) + within]
    if unequal.any():
        differs[np.repeat(np.arange(len(starts)), sizes)[unequal]] = True
    odd = np.flatnonzero(differs)
    if len(odd):
        numbers: dict[str, int] = {}
        more = []
        for i in odd.tolist():
            word = joined[starts[i]:ends[i]]
            if word not in numbers:
                numbers[word] = len(first) + len(more)
                more.append(i)
            which[i] = numbers[word]
        first = np.concatenate([first, np.array(more, np.int64)])
    return which, first


class WordCache:
    """Encoded words by text, filled by ``encode_many``; emptied when ``limit`` words are kept.

    Words longer than ``longest`` characters are encoded each time they occur,
    which keeps the memory bounded.
    """

    def __init__(self, encode_many: Callable[[list[str]], Iterable], limit: int = 400_000, longest: int = 48):
        self.encode_many, self.limit, self.longest = encode_many, limit, longest
        self.kept: dict[str, object] = {}

    def values(self, words: list[str]) -> list:
        if len(self.kept) > self.limit:
            self.kept.clear()
        out = list(map(self.kept.get, words))
        missing = [i for i, v in enumerate(out) if v is None]
        if missing:
            for i, v in zip(missing, self.encode_many([words[i] for i in missing]), strict=True):
                out[i] = v
                if len(words[i]) <= self.longest:
                    self.kept[words[i]] = v
        return out

    def lookup(self, texts: list[str], joins_space: bool) -> tuple[list, np.ndarray, np.ndarray]:
        """(values of the distinct words, index of each word's value, first word of each text and the end)."""
        joined, starts, ends, codes, bounds = cut(texts, joins_space)
        if not len(starts):
            return [], np.empty(0, np.int64), bounds
        which, first = _distinct(joined, codes, starts, ends)
        words = [joined[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
        return self.values(words), which, bounds


def segments(text: str, special: re.Pattern | None) -> list[str]:
    """The text's stretches between special strings, and those strings (at odd places)."""
    return special.split(text) if special else [text]


def special_pattern(contents: Iterable[str]) -> re.Pattern | None:
    found = sorted(contents, key=len, reverse=True)
    return re.compile("(" + "|".join(map(re.escape, found)) + ")") if found else None
