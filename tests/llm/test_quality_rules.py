"""Counts against brute force, the robust estimate against numpy."""

import random
import re
from collections import Counter, defaultdict

import numpy as np

from llm_rows import base_rows, make, mixed, no_docs  # noqa: F401  fixtures

from plume.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n, len(lines))


def test_counts(spark, mixed):
    rows, docs = mixed
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                  for r in q.quality(docs).collect())
    assert got == Counter((i, *brute(t)[:6]) for i, t, _, _ in rows)


def test_overlapping_windows(spark):
    texts = ["a a a a a", "a b c a b c", "a b c x a b c a b", "x y", "a b a b a b z", "p q r s p q r t q r s"]
    got = {r.doc_id: r.n_repeat_words for r in q.quality(make(spark, [(k, t, "en", "s") for k, t in enumerate(texts)])).collect()}
    assert got == {k: brute(t)[4] for k, t in enumerate(texts)}


def _vector(counts):
    n, chars, symbols, dup, repeats, _, lines = counts
    angle = lambda a, b: np.arcsin(np.sqrt(min(1.0, a / b))) if b else 0.0
    return [np.log(chars / n) if n else 0.0, np.log1p(symbols / n) if n else 0.0, angle(repeats, n), angle(dup, lines)]


def _grid(d):
    return np.floor(np.log1p(d) * 1000 + 0.5)


def brute_mcd(x, core=0.75, steps=4):
    """Mean and covariance with floors, by the steps of the operator."""
    floor = np.array(list(q.FLOORS.values()))
    dist = lambda m, c: np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
    fit = lambda part: (part.mean(0), np.cov(part.T, bias=True) + np.diag(floor ** 2))
    mean, cov = np.median(np.round(x, 4), axis=0), np.diag(floor ** 2)
    for _ in range(steps):
        d = _grid(dist(mean, cov))
        mean, cov = fit(x[d <= np.percentile(d, 100 * core)])
    d = dist(mean, cov)
    scale = max(1.0, np.expm1(np.percentile(_grid(d), 50) / 1000) / q.CHI_MEDIAN)
    mean, cov = fit(x[d <= scale * q.CHI_REWEIGHT])
    return dist(mean, cov)


def _corpus():
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    rows = []
    for k in range(420):
        lang, source = [("en", "s1"), ("en", "s2"), ("fr", None), ("en", "few")][0 if k < 150 else 1 if k < 290 else 2 if k < 410 else 3]
        words = [rng.choice(vocabulary) for _ in range(rng.randint(60, 300))]
        if k % 25 == 0:
            words = [w + "###" for w in words]
        rows.append((k, " ".join(words), lang, source))
    return rows


def test_verdict_equals_a_plain_estimate(spark):
    rows = _corpus()
    got = {r.doc_id: r for r in q.quality(make(spark, rows).repartition(5)).collect()}
    vectors = {i: _vector(brute(t)) for i, t, _, _ in rows}
    groups = defaultdict(list)
    for i, _, lang, source in rows:
        groups[(lang, source)].append(i)
    for (lang, source), ids in groups.items():
        pool = ids if source != "few" else [i for i, _, x, _ in rows if x == lang]
        d2 = dict(zip(pool, brute_mcd(np.array([vectors[i] for i in pool])), strict=True))
        for i in ids:
            assert np.isclose(got[i].d2, d2[i], rtol=1e-6, atol=1e-9)
            assert got[i].kept == (d2[i] <= 40)
    assert [i for i, r in got.items() if not r.kept] == [i for i in got if i % 25 == 0]


def test_single_statistics_reject(spark):
    rng = random.Random(9)
    fresh = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    rows = [(k, "\n".join(fresh(10) for _ in range(20)), "en", "s") for k in range(200)]
    phrase = fresh(45)
    rows.append((1000, f"{phrase} {fresh(110)} {phrase}", "en", "s"))                        # 45 % repeated words
    line = "one line"
    rows.append((1001, "\n".join([line] * 41 + [fresh(30) for _ in range(9)]), "en", "s"))    # 80 % duplicate lines
    rows.append((1002, f"{fresh(85)} {' '.join(phrase.split()[:15])} {fresh(85)} {' '.join(phrase.split()[:15])}", "en", "s"))  # 15 %: ordinary
    assert [round(brute(t)[4] / brute(t)[0], 2) for _, t, _, _ in rows[-3:]] == [0.45, 0.23, 0.15] and brute(rows[-2][1])[3] == 40
    got = {r.doc_id: r for r in q.quality(make(spark, rows)).collect()}
    assert not got[1000].base_failed and not got[1000].kept
    assert not got[1001].base_failed and not got[1001].kept
    assert sorted(i for i, r in got.items() if not r.kept) == [1000, 1001]


def test_small_groups_are_judged_too(spark):
    rows = [(k, " ".join(f"w{j * k}" for j in range(1, 80)), "zz", "tiny") for k in range(1, 9)]
    got = q.quality(make(spark, rows)).collect()
    assert all(r.kept and r.d2 is not None for r in got) and len(got) == 8


def test_same_verdict_in_small_and_large_groups(spark):
    rng = random.Random(12)
    fresh = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    clean = [(k, "\n".join(fresh(10) for _ in range(20)), "en", "s") for k in range(300)]
    odd = (1000, "\n".join(["short"] * 60 + [fresh(20) for _ in range(10)]), "en", "s")
    for n in (40, 300):
        got = {r.doc_id: r for r in q.quality(make(spark, [*clean[:n], odd])).collect()}
        assert [i for i, r in got.items() if not r.kept] == [1000] and not got[1000].base_failed
    # few rows of a language: judged by all documents; few of a source: by its language
    mixed_in = [(2000 + k, t, lang, source) for k, (lang, source) in enumerate([("xx", "s"), ("en", "few"), (None, None)])
                for t in (odd[1],)]
    got = {r.doc_id: r for r in q.quality(make(spark, [*clean, *mixed_in])).collect()}
    assert sorted(i for i, r in got.items() if not r.kept) == [2000, 2001, 2002]


def test_equal_hashes_are_told_apart(spark, monkeypatch):
    texts = ["a b c d e f", "a b c a b c", "ab c d a bc d", "q q q q", " ".join(f"w{k % 40}" for k in range(100))]
    monkeypatch.setattr(q.F, "xxhash64", lambda *columns: q.F.lit(7).cast("long"))
    got = {r.doc_id: r.n_repeat_words for r in q.quality(make(spark, [(k, t, "en", "s") for k, t in enumerate(texts)])).collect()}
    assert got == {k: brute(t)[4] for k, t in enumerate(texts)}


def test_salted_joins_give_the_same(spark, monkeypatch):
    docs = make(spark, _corpus()).repartition(3)
    want = {r.doc_id: (r.kept, round(r.d2, 9)) for r in q.quality(docs).collect()}
    monkeypatch.setattr(q, "MOST_BROADCAST", 0)
    assert {r.doc_id: (r.kept, round(r.d2, 9)) for r in q.quality(docs).collect()} == want


def test_kept_rows_come_back_whole(spark, mixed):
    docs = mixed[1]
    kept = Counter(r.doc_id for r in q.quality(docs).where("kept").collect())
    got = q.kept_documents(docs)
    assert got.schema == docs.schema and Counter(r.doc_id for r in got.collect()) == kept


def test_no_documents(spark, no_docs):
    assert q.quality(no_docs).collect() == []


def test_no_python_in_the_plan(spark, mixed):
    plan = q.quality(mixed[1])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
