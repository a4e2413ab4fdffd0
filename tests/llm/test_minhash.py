"""MinHash near-duplicates against all pairs of full sets."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from llm_rows import base_rows, make, mixed, no_docs  # noqa: F401  fixtures

from plume.llm import minhash, queries


def brute_set(text, size=2):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", lower) if x]
    return frozenset(" ".join(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def expected(rows, size=2):
    sets = [brute_set(t, size) for _, t, _, _ in rows]
    distinct = sorted({s for s in sets if s}, key=len)
    root = {s: s for s in distinct}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s
    for k, a in enumerate(distinct):
        for b in distinct[k + 1:]:
            if 100 * len(a) < 80 * len(b):
                break
            common = len(a & b)
            if 100 * common >= 80 * (len(a) + len(b) - common):
                x, y = find(a), find(b)
                root[x] = y
    least = {}
    for (i, *_), s in zip(rows, sets, strict=True):
        if s and i is not None:
            r = find(s)
            least[r] = min(i, least.get(r, i))
    out = []
    for (i, *_), s in zip(rows, sets, strict=True):
        c = least.get(find(s)) if s else i
        out.append((i, len(s), c, i is not None and i == c))
    return Counter(out)


def near_copies(base_rows, seed, copies, most):
    rng = random.Random(seed)
    rows = []
    for n, (_, text, lang, source) in enumerate(base_rows[:14]):
        words = (text or "").split(" ")
        for k in range(copies):
            copy = list(words)
            for _ in range(int(len(copy) * most * rng.random())):
                copy[rng.randrange(len(copy))] = f"w{rng.randrange(9999)}"
            rows.append((800_000 + n * 1000 + k, " ".join(copy), lang, source))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates(spark, mixed, base_rows, seed):
    rows = mixed[0] + near_copies(base_rows, seed, 25, 0.12)
    got = minhash.near_duplicates(make(spark, rows).repartition(5), shingle=2).collect()
    want = expected(rows)
    assert Counter(tuple(r) for r in got) == want
    groups = Counter(c for _, _, c, _ in want)
    assert max(groups.values()) > 5 and len(groups) < len(rows) - 100


def test_chain(spark):
    """Every text is similar to its neighbours only; the links must join them all."""
    words = [f"w{k}" for k in range(400)]
    rows = [(5000 - k, " ".join(words[4 * k:4 * k + 60]), "en", "s") for k in range(80)]
    got = minhash.near_duplicates(make(spark, rows), shingle=2).collect()
    assert Counter(tuple(r) for r in got) == expected(rows)
    assert len({r.component_id for r in got}) < 15


def test_short_and_other_shingles(spark):
    rng = random.Random(5)
    rows = [(k, " ".join(rng.choice("ABcd") for _ in range(rng.randrange(0, 9))), "en", "s") for k in range(300)]
    assert Counter(tuple(r) for r in minhash.near_duplicates(make(spark, rows), shingle=2).collect()) == expected(rows)
    rows = [(k, " ".join(rng.choice("ABcdef") for _ in range(rng.randrange(0, 12))), "en", "s") for k in range(200)]
    assert Counter(tuple(r) for r in minhash.near_duplicates(make(spark, rows)).collect()) == expected(rows, 5)


def test_wide_groups(spark, base_rows):
    rows = near_copies(base_rows, 9, 30, 0.25)
    got = minhash.near_duplicates(make(spark, rows).repartition(4), shingle=2).collect()
    assert Counter(tuple(r) for r in got) == expected(rows)


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    for size in (20, 300, 5000):
        errors = []
        for _ in range(20):
            common = rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2)
            a, b = (np.sort(np.append(common, rng.integers(0, 1 << 63, size // 4, dtype=np.uint64) * np.uint64(2) + np.uint64(1))) for _ in "ab")
            errors.append((minhash.sketch(a) == minhash.sketch(b)).mean() - size / (size + 2 * (size // 4)))
        assert abs(np.mean(errors)) < 0.05
    one = np.array([7], np.uint64)
    assert (minhash.sketch(one) == 7).all()


def test_empty_and_null(spark, no_docs):
    assert minhash.near_duplicates(no_docs).count() == 0
    rows = [(1, None, "en", "s"), (2, " ", "en", "s"), (None, "", None, None), (None, "a b c", None, None), (None, "a b c", None, None)]
    got = minhash.near_duplicates(make(spark, rows), shingle=2).collect()
    assert Counter(tuple(r) for r in got) == Counter(
        [(1, 0, 1, True), (2, 0, 2, True), (None, 0, None, False), (None, 2, None, False), (None, 2, None, False)])


def test_whole_table(spark, base_rows):
    from llm_rows import SF
    got = queries.op12_minhash_near_dedup(spark, SF).collect()
    assert Counter(tuple(r) for r in got) == expected(base_rows)
