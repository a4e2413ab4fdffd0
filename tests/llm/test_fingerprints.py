"""Fingerprints: edits and neighbours against brute force, likeness against exact similarity."""

import hashlib
import re
from collections import Counter

import numpy as np

from llm_rows import base_rows, make, mixed, no_docs  # noqa: F401  fixtures

from plume.llm import fingerprints as fp

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall((text or "").lower())
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def in_order(rows):
    """Descending doc_id, nulls last, ties by text."""
    return sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))


def expected(rows):
    out = []
    ranked = in_order(rows)
    for k, (i, t, _, _) in enumerate(ranked):
        t, after = t or "", ranked[(k + 1) % len(ranked)][1] or ""
        half = len(t) // 2
        out.append((i, t, t[:len(t) - half] + after[:half], after))
    return out


def test_edits_and_neighbours(spark, mixed):
    rows, docs = mixed
    got = fp.fingerprint_edits(docs).collect()
    want = expected(rows)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == Counter((i, len(t), digest(e)) for i, t, e, _ in want)
    near = {(i, digest(e)): (jaccard(shingles(t), shingles(e)), jaccard(shingles(t), shingles(a))) for i, t, e, a in want}
    errors = np.array([[r.near_edited - near[r.doc_id, r.edited_sha256][0], r.near_next - near[r.doc_id, r.edited_sha256][1]] for r in got])
    assert np.abs(errors).max() < 0.25 and np.abs(errors).mean() < 0.05 and abs(errors.mean()) < 0.02


def test_any_number_of_ranges_gives_the_same_neighbours(spark, mixed):
    rows, docs = mixed
    own = docs.selectExpr("doc_id", "coalesce(text, '') AS text").selectExpr("*", "CAST(length(text) AS BIGINT) AS n_chars")
    want = Counter((i, t, a) for i, t, _, a in expected(rows))
    for parts in (1, 2, 7, 500):
        assert Counter((r.doc_id, r.text, r.next_text) for r in fp.with_next(own, ["text"], parts).collect()) == want


def test_equal_texts_have_equal_fingerprints(spark, mixed):
    by_text = {}
    for r in fp.with_fingerprint(mixed[1].select("doc_id", "text").na.fill(""), "text", "f").collect():
        by_text.setdefault(r.text, set()).add(tuple(r.f))
    assert all(len(v) == 1 for v in by_text.values())
    assert len({next(iter(v)) for v in by_text.values()}) > 0.95 * len(by_text)


def test_likeness_is_unbiased(spark):
    rng = np.random.default_rng(3)
    rows, exact = [], []
    for k in range(150):
        words = [f"w{x}" for x in rng.integers(0, 10**6, 200)]
        other = list(words)
        other[int(200 * k / 150):] = [f"v{x}" for x in rng.integers(0, 10**6, 200 - int(200 * k / 150))]
        rows.append((k, " ".join(words), " ".join(other)))
        exact.append(jaccard(shingles(rows[-1][1]), shingles(rows[-1][2])))
    docs = spark.createDataFrame(rows, "doc_id long, a string, b string")
    both = fp.with_fingerprint(fp.with_fingerprint(docs, "a", "fa"), "b", "fb")
    got = [r.near for r in both.select("doc_id", fp.likeness(both.fa, both.fb).alias("near")).orderBy("doc_id").collect()]
    error = np.array(got) - exact
    assert abs(error.mean()) < 0.01 and error.std() < 0.06


def test_one_document_is_its_own_neighbour(spark):
    r, = fp.fingerprint_edits(make(spark, [(7, "abcdef", "en", "s")])).collect()
    assert (r.n_chars, r.edited_sha256, r.near_next) == (6, hashlib.sha256(b"abcabc").hexdigest(), 1.0)


def test_only_rows_without_id(spark):
    rows = [(None, "one two", "en", "s"), (None, "three", "en", "s"), (None, None, "en", "s")]
    got = Counter((r.n_chars, r.edited_sha256) for r in fp.fingerprint_edits(make(spark, rows)).collect())
    assert got == Counter((len(t), hashlib.sha256(e.encode()).hexdigest()) for _, t, e, _ in expected(rows))


def test_no_documents(spark, no_docs):
    assert fp.fingerprint_edits(no_docs).collect() == []


def test_no_python_in_the_plan(spark, mixed):
    plan = fp.fingerprint_edits(mixed[1])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
