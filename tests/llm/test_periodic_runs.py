"""Periodic runs against a search over all periods and starts."""

import hashlib
import random
import zlib
from collections import Counter
from fractions import Fraction

import pytest

from llm_rows import base_rows, make, mixed, no_docs, odd_rows  # noqa: F401  fixtures

from plume.llm import periodic_runs, queries


def brute_runs(w):
    n, out = len(w), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            smaller = any(q % p == 0 and all(w[x] == w[x + p] for x in range(i, i + length - p)) for p in range(1, q))
            if length >= max(24, 3 * q) and not smaller:
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def edited(text, doc_id):
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if x]
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    out = []
    for i, text, _, _ in rows:
        w = edited(text, i)
        runs = brute_runs(w)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        kept = [x for k, x in enumerate(w) if not any(s + q <= k < s + n for s, n, q in runs)]
        out.append((i, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                    sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(kept))))
    return Counter(out)


def test_random_words():
    rng = random.Random(3)
    for _ in range(400):
        texts = []
        for _ in range(rng.randrange(1, 5)):
            w = []
            for _ in range(rng.randrange(5)):
                base = [rng.choice("abc"[:rng.randrange(1, 4)]) for _ in range(rng.randrange(1, 12))]
                w += (base * rng.randrange(1, 12))[:rng.randrange(1, 80)]
            texts.append(w)
        assert periodic_runs.runs_of(texts) == [brute_runs(w) for w in texts]


@pytest.mark.parametrize("n", [200, 400])
def test_fibonacci_words(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    assert periodic_runs.runs_of([list(b[:n])]) == [brute_runs(b[:n])]


def test_long_runs():
    base = [f"w{k}" for k in range(999)]
    assert periodic_runs.runs_of([["y"] * 50_000, base * 40, base]) == [[(0, 50_000, 1)], [(0, 39_960, 999)], []]
    assert periodic_runs.runs_of([["y"] * 23, ["y"] * 24, base[:8] * 3, base[:9] * 2 + base[:8]]) == [[], [(0, 24, 1)], [(0, 24, 8)], []]


def test_equal_ratio_ties():
    assert periodic_runs.strongest([(50, 30, 10), (10, 30, 10), (10, 60, 20)]) == (10, 30, 10)
    assert periodic_runs.strongest([]) is None
    with pytest.raises(ValueError):
        periodic_runs.runs_of([["a"]], least_length=10)


def test_documents(spark, mixed, no_docs):
    rows, docs = mixed
    short = [r for r in rows if r[1] is None or len(r[1]) < 15_000]
    looped = [(k, " ".join(f"v{(k * j) % 61}" for j in range(40 + k)), "en", "s") for k in range(600)]
    got = periodic_runs.periodic_runs(make(spark, short + looped), edit=periodic_runs.looped).collect()
    want = expected(short + looped)
    assert Counter(tuple(r) for r in got) == want
    assert sum(r[1] > 0 for r in want) > 40
    assert periodic_runs.periodic_runs(docs).count() == len(rows)
    assert periodic_runs.periodic_runs(no_docs).count() == 0


def test_texts(spark):
    text = "start " + "one two three " * 10 + "end"
    r = periodic_runs.periodic_runs(make(spark, [(1, text, "en", "s"), (None, text, None, None)]), texts_too=True).collect()
    assert [x.collapsed for x in r] == ["start one two three end"] * 2
    assert tuple(r[0].runs[0]) == (1, 30, 3)


def test_whole_table(spark):
    from llm_rows import SF
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 6000").collect()]
    got = {r.doc_id: tuple(r) for r in queries.op11_periodic_runs(spark, SF).collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert Counter(got[r[0]] for r in rows) == expected(rows)
