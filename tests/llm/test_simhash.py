"""SimHash fingerprints, Golay keys and components against brute force."""

import random
from collections import Counter

import numpy as np
import xxhash

from llm_rows import base_rows, make, mixed, no_docs  # noqa: F401  fixtures

from plume.llm import simhash
from plume.llm.graph import components


def brute_fingerprint(text, size=3):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = np.array([xxhash.xxh64_intdigest(s, seed=42) for s in shingles], np.uint64)
    return sum(1 << b for b in range(64) if 2 * int((hashes >> np.uint64(b) & np.uint64(1)).sum()) > len(hashes))


def brute_components(prints):
    """prints: {row: fingerprint}; returns root per row."""
    values = sorted(set(prints.values()))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v
    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {r: find(v) for r, v in prints.items()}


def expected(rows):
    prints = {k: brute_fingerprint(t) for k, (_, t, _, _) in enumerate(rows)}
    roots = brute_components(prints)
    least = {}
    for k, (i, _, _, _) in enumerate(rows):
        if i is not None:
            least[roots[k]] = min(i, least.get(roots[k], i))
    return Counter((i, f"{prints[k]:016x}", least.get(roots[k])) for k, (i, _, _, _) in enumerate(rows))


def near_copies(base_rows):
    rng = random.Random(1)
    rows = []
    for n, (_, text, lang, source) in enumerate(base_rows[:12]):
        words = (text or "").split(" ")
        for k in range(12):
            copy = list(words)
            for _ in range(k % 4):
                copy[rng.randrange(len(copy))] = f"w{rng.randrange(99)}"
            rows.append((800_000 + n * 100 + k, " ".join(copy), lang, source))
    return rows


def test_near_duplicates(spark, mixed, base_rows):
    rows = mixed[0] + near_copies(base_rows)
    got = simhash.near_duplicates(make(spark, rows), shingle=3).collect()
    want = expected(rows)
    assert Counter(tuple(r) for r in got) == want
    assert len({c for _, _, c in want}) < len(rows) - 20  # there are links


def test_one_of_each(spark, mixed, base_rows):
    rows = mixed[0] + near_copies(base_rows)
    docs = make(spark, rows)
    got = simhash.one_of_each(docs, shingle=3)
    assert got.columns == docs.columns
    prints = {k: brute_fingerprint(t) for k, (_, t, _, _) in enumerate(rows)}
    roots = brute_components(prints)
    groups = {}
    for k, (i, _, _, _) in enumerate(rows):
        groups.setdefault(roots[k], []).append((i is None, i or 0))
    want = Counter(None if min(g)[0] else min(g)[1] for g in groups.values())
    assert Counter(r.doc_id for r in got.collect()) == want


def test_every_link_within_three_bits_is_found(spark):
    rng = random.Random(2)
    centre = [rng.getrandbits(64) for _ in range(40)]
    prints = set(centre)
    for c in centre:
        for _ in range(25):
            x = c
            for b in rng.sample(range(64), rng.randint(1, 4)):
                x ^= 1 << b
            prints.add(x)
    prints |= {0, 1, 2, (1 << 64) - 1, (1 << 63)}
    signed = [x - (1 << 64) if x >= 1 << 63 else x for x in prints]
    for most in (0, 1, 2, 3):
        found = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), most).collect()}
        u = np.array(sorted(signed), np.int64)
        apart = np.bitwise_count(u.view(np.uint64)[:, None] ^ u.view(np.uint64)[None, :])
        i, j = np.nonzero(np.triu(apart <= most, 1))
        assert found == set(zip(u[i].tolist(), u[j].tolist(), strict=True))


def test_the_code_is_perfect():
    words = np.arange(1 << 23, dtype=np.int64)[::97]
    nearest = words ^ simhash._ERRORS[simhash._syndromes(words)]
    assert (simhash._syndromes(nearest) == 0).all()
    assert np.bitwise_count(words ^ nearest).max() == 3
    assert len(set(simhash._ERRORS.tolist())) == 2048


def test_a_segment_and_its_neighbour_share_an_index():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 22, 500)
    near = simhash._nearby(words, 22)
    assert set((near >= 0).sum(axis=1).tolist()) <= {1, 2, 3, 4, 5, 6}
    for b in range(22):
        other = simhash.codeword_index(words ^ (1 << b))
        assert (near == other[:, None]).any(axis=1).all()


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(path + star, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(200)}


def test_no_documents(spark, no_docs):
    assert simhash.near_duplicates(no_docs, 3).collect() == []
    assert simhash.one_of_each(no_docs, 3).collect() == []
