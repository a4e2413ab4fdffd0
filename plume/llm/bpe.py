"""Byte-pair merges of a public vocabulary file: two exact ways to encode a word.

``MergeTable.encode_many`` keeps a segment tree over the ranks of adjacent
pairs: the root is the leftmost pair of lowest rank, a merge changes three
leaves and their ancestors, and the word is done when the root has no pair.
Many words advance together, one merge each per step.

``MergeTable.prefix_counts`` is a dynamic program over prefixes: the encoding
of a prefix is the encoding of a shorter one and one last token, and of the
tokens that end there only one agrees with its predecessor.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import numpy as np

from .words import special_pattern

_NONE = np.int64(1) << np.int64(62)
_NEVER = 1 << 60
_MEMO = 1_000_000


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class MergeTable:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        model = data["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.special: dict[str, int] = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.special_split: re.Pattern | None = special_pattern(self.special)
        self.names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        chars = byte_characters()
        self.inside = np.array([self.vocab[c] for c in chars], np.int64)
        self.last = np.array([self.vocab[c + self.suffix] for c in chars], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([self.vocab[a] for a, _ in pairs], np.int64)
        right = np.array([self.vocab[b] for _, b in pairs], np.int64)
        self.made = np.array([self.vocab[a + b] for a, b in pairs], np.int64)
        self.size = max(self.names) + 1
        key = left * self.size + right
        order = np.argsort(key, kind="stable")
        self._keys, self._ranks = key[order], order.astype(np.int64)
        self.rank_of = {int(k): r for r, k in enumerate(key)}
        self.parts = {int(t): (int(a), int(b), r) for r, (t, a, b) in enumerate(zip(self.made, left, right, strict=True))}
        self._agree: dict[int, bool] = {}

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or ``_NEVER``."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where((self._keys[at] == key) & (left >= 0) & (right >= 0), self._ranks[at], _NEVER)

    # --- segment tree -----------------------------------------------------

    def encode_many(self, words: list[bytes]) -> list[np.ndarray]:
        """Token ids of every word (each a non-empty byte string of one pre-token)."""
        out: list[np.ndarray] = [np.empty(0, np.int64)] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        width = 1 << np.ceil(np.log2(np.maximum(sizes, 2))).astype(np.int64)
        for w in np.unique(width):
            members = np.flatnonzero((width == w) & (sizes > 0))
            step = max(1, 1_000_000 // int(w))
            for i in range(0, len(members), step):
                self._encode_equal(words, members[i:i + step], sizes, int(w), out)
        return out

    def _encode_equal(self, words, members, sizes, w: int, out) -> None:
        n, lens = len(members), sizes[members]
        sym = np.full((n, w + 1), -1, np.int64)
        filled = np.arange(w + 1)[None, :] < lens[:, None]
        sym[filled] = self.inside[np.frombuffer(b"".join(words[m] for m in members), np.uint8)]
        rows = np.arange(n)
        ends = np.fromiter((words[m][-1] for m in members), np.int64, n)
        sym[rows, lens - 1] = self.last[ends]
        after = np.where(filled, np.arange(1, w + 2)[None, :], w)
        after[rows, lens - 1] = w
        before = np.tile(np.arange(-1, w), (n, 1))
        tree = np.full((n, 2 * w), _NONE, np.int64)
        rank = self.ranks(sym[:, :-1], sym[:, 1:])
        tree[:, w:] = np.where(rank < _NEVER, rank * w + np.arange(w)[None, :], _NONE)
        node = w // 2
        while node >= 1:
            tree[:, node:2 * node] = np.minimum(tree[:, 2 * node:4 * node:2], tree[:, 2 * node + 1:4 * node:2])
            node //= 2
        live = rows
        while True:
            top = tree[live, 1]
            going = top < _NONE
            live, top = live[going], top[going]
            if not len(live):
                break
            at, merged = top % w, self.made[top // w]
            gone = after[live, at]
            beyond = after[live, gone]
            prior = before[live, at]
            sym[live, at] = merged
            sym[live, gone] = -1
            after[live, at] = beyond
            before[live, beyond] = at  # column w is a dump for "no successor"
            follow = self.ranks(merged, sym[live, beyond])
            tree[live, w + gone] = _NONE
            tree[live, w + at] = np.where(follow < _NEVER, follow * w + at, _NONE)
            has = prior >= 0
            led = self.ranks(sym[live[has], prior[has]], merged[has])
            tree[live[has], w + prior[has]] = np.where(led < _NEVER, led * w + prior[has], _NONE)
            for r, leaf in ((live, gone), (live, at), (live[has], prior[has])):
                node = (leaf + w) >> 1
                for _ in range(w.bit_length() - 1):
                    tree[r, node] = np.minimum(tree[r, 2 * node], tree[r, 2 * node + 1])
                    node >>= 1
        kept = sym >= 0
        flat, ends = sym[kept], np.cumsum(kept.sum(1))
        for m, part in zip(members.tolist(), np.split(flat, ends[:-1]), strict=True):
            out[m] = part

    # --- prefix dynamic program -------------------------------------------

    @lru_cache(maxsize=1)  # noqa: B019 - one table lives as long as its worker
    def _tokens(self) -> tuple[dict[bytes, int], dict[bytes, int], int]:
        """Tokens by their bytes, inside a word and at its end; only those that encode to themselves."""
        back = {c: b for b, c in enumerate(byte_characters())}
        inside, last = {}, {}
        for text, i in self.vocab.items():
            end = bool(self.suffix) and text.endswith(self.suffix)
            raw = bytes(back[c] for c in (text[:-len(self.suffix)] if end else text))
            if self._is_own(i):
                (last if end else inside)[raw] = i
        if not self.suffix:
            last = inside
        return inside, last, max(map(len, list(inside) + list(last)))

    def _is_own(self, token: int) -> bool:
        """True if a merge sequence leads to the token: each pair it was made of survives to its merge."""
        if token not in self.parts:
            return True
        a, b, r = self.parts[token]
        return self._is_own(a) and self._is_own(b) and self._first_cross(a, b) == r

    def _right_edge(self, token: int) -> list[tuple[int, int]]:
        """The last pieces of a token from its last byte up to itself, with the rank that made each."""
        chain = [(token, self.parts[token][2] if token in self.parts else -1)]
        while token in self.parts:
            token = self.parts[token][1]
            chain.append((token, self.parts[token][2] if token in self.parts else -1))
        return chain[::-1]

    def _left_edge(self, token: int) -> list[tuple[int, int]]:
        chain = [(token, self.parts[token][2] if token in self.parts else -1)]
        while token in self.parts:
            token = self.parts[token][0]
            chain.append((token, self.parts[token][2] if token in self.parts else -1))
        return chain[::-1]

    def _first_cross(self, one: int, two: int) -> int:
        """Rank of the first merge across the border of two adjacent tokens, or ``_NEVER``.

        The pieces that touch the border grow in the order of their merges'
        ranks.  A merge across happens if its rank comes before the next merge
        on either side; of equal ranks the leftmost goes first.
        """
        left, right = self._right_edge(one), self._left_edge(two)
        i = j = 0
        while True:
            grow_left = left[i + 1][1] if i + 1 < len(left) else _NEVER
            grow_right = right[j + 1][1] if j + 1 < len(right) else _NEVER
            cross = self.rank_of.get(left[i][0] * self.size + right[j][0], _NEVER)
            if cross < grow_left and cross <= grow_right and cross < _NEVER:
                whole = i + 1 == len(left) and j + 1 == len(right)
                return cross if whole else -1
            if grow_left == grow_right == _NEVER:
                return _NEVER
            if grow_left <= grow_right:
                i += 1
            else:
                j += 1

    def agrees(self, one: int, two: int) -> bool:
        """True if the encoding of the two tokens' bytes is just these two tokens."""
        key = one * self.size + two
        found = self._agree.get(key)
        if found is None:
            if len(self._agree) > _MEMO:
                self._agree.clear()
            found = self._agree[key] = self._first_cross(one, two) == _NEVER
        return found

    def prefix_counts(self, word: bytes, every: bool = True) -> list[int]:
        """Token counts of word[:1], ..., word[:n], each as a whole word; ``every`` False: of the whole word only."""
        inside, last, longest = self._tokens()
        n = len(word)
        if not every and word in last:
            return [1]
        tail, count, out = [-1] * (n + 1), [0] * (n + 1), []
        for j in range(1, n + 1):
            low = max(0, j - longest)
            if every or j == n:
                for i in range(low, j):
                    t = last.get(word[i:j])
                    if t is not None and (i == 0 or self.agrees(tail[i], t)):
                        out.append(count[i] + 1)
                        break
            if j < n:
                for i in range(low, j):
                    t = inside.get(word[i:j])
                    if t is not None and (i == 0 or self.agrees(tail[i], t)):
                        tail[j], count[j] = t, count[i] + 1
                        break
        return out


@lru_cache(maxsize=4)
def merge_table(path: str) -> MergeTable:
    return MergeTable(path)


def fold(text: str) -> str:
    """The word vocabulary's normal form: NFC, then each character's lower case (no final-sigma rule)."""
    if not text.isascii():
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        if "Σ" in text:
            text = text.replace("Σ", "σ")
    return text.lower()
