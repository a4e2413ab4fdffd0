"""Context trees against a plain one, and held-out accuracy."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from llm_rows import SF, base_rows, make, mixed, no_docs  # noqa: F401  fixtures

from plume.llm import language


def plain_trees(texts, order):
    follow = defaultdict(Counter)
    for t in texts:
        data = b"\n" * order + t.encode()
        for i in range(order, len(data)):
            for k in range(order + 1):
                follow[data[i - k:i]][data[i]] += 1
    return follow


def plain_bits(follow, text, order):
    data, bits = b"\n" * order + text.encode(), 0.0
    for i in range(order, len(data)):
        for k in range(order, -1, -1):
            seen = follow.get(data[i - k:i])
            if seen:
                whole = sum(seen.values()) + len(seen)
                if data[i] in seen:
                    bits -= math.log2(seen[data[i]] / whole)
                    break
                bits -= math.log2(len(seen) / whole)
        else:
            bits += 8
    return bits


def test_code_lengths(spark, base_rows):
    rows = [r for r in base_rows if r[1]][:60]
    model = language.learn(make(spark, rows), F.lit(True), order=3)
    assert model.languages == sorted({r[2] for r in rows})
    for j, lang in enumerate(model.languages):
        follow = plain_trees([t for _, t, x, _ in rows if x == lang], 3)
        for text in ("Und the new words é", "\x00\x01zzz", "", base_rows[70][1][:400]):
            assert math.isclose(model.score([text.encode()])[0, j], plain_bits(follow, text, 3), rel_tol=1e-4, abs_tol=1e-3)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = language.predict_held_out(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang_pred <> 'und'")
    assert found.where("lang = lang_pred").count() >= 0.95 * found.count() > 0


def test_lang_of_held_out_rows_is_not_used(spark, base_rows):
    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    one = make(spark, base_rows)
    other = make(spark, [(i, t, "xx" if held(i) else lang, "yy") for i, t, lang, _ in base_rows])
    assert sorted(map(tuple, language.predict_held_out(one).collect())) == sorted(map(tuple, language.predict_held_out(other).collect()))


def test_odd_rows(spark, mixed):
    rows, docs = mixed
    got = Counter((r.doc_id, r.held_out, r.lang_pred == "und") for r in language.predict_held_out(docs).collect())
    want = Counter((i, i is not None and zlib.crc32(str(i).encode()) % 3 == 1, not any(map(str.isalpha, t or ""))) for i, t, _, _ in rows)
    assert got == want


def test_scores_are_shares(spark, mixed):
    assert all(0 <= r.score <= 1 for r in language.predict_held_out(mixed[1]).collect())


def test_nothing_to_learn_from(spark, no_docs):
    assert language.predict_held_out(no_docs).collect() == []
    docs = make(spark, [(1, "words", None, "s"), (2, None, None, None)])
    assert {(r.lang_pred, r.score) for r in language.predict_held_out(docs).collect()} == {("und", 0.0)}


def test_repeated_rows_are_learnt_once(spark, base_rows):
    rows = [r for r in base_rows if r[1]][:40]
    once = language.learn(make(spark, rows), F.lit(True), order=2)
    often = language.learn(make(spark, rows + rows[:5] * 30), F.lit(True), order=2)
    assert all((a == b).all() for a, b in zip(once.grams + once.lengths, often.grams + often.lengths, strict=True))


def test_the_sample_has_its_bound(spark, base_rows):
    rows = [(i, t, "en", "s") for i, t, _, _ in base_rows if t]
    few = language.learn(make(spark, rows), F.lit(True), order=2, rows_per_language=3)
    every = language.learn(make(spark, rows), F.lit(True), order=2)
    assert len(few.grams[2]) < len(every.grams[2])


def test_sample_is_the_smallest_hashes(spark):
    """The rows learnt from are those with a language's smallest hashes, however the search is cut; repeats count once."""
    rng = random.Random(21)
    texts = {lang: ["".join(rng.choice(letters) for _ in range(rng.randint(5, 30))) for _ in range(400)]
             for lang, letters in (("aa", "abc "), ("bb", "xyz "))}
    rows = [(k + 1000 * (lang == "bb"), t, lang, "s") for lang, own in texts.items() for k, t in enumerate(own)]
    docs = make(spark, rows + rows[:50]).repartition(4)
    hashed = docs.selectExpr("lang", "text", "xxhash64(doc_id, octet_length(text)) h").distinct().collect()
    for most in (1, 30, 400, 1000):
        want = {lang: {r.text for r in sorted((r for r in hashed if r.lang == lang), key=lambda r: r.h)[:most]} for lang in texts}
        small = [r for r in rows if r[1] in want[r[2]]]
        model = language.learn(docs, F.lit(True), rows_per_language=most)
        plain = language.learn(make(spark, small), F.lit(True), rows_per_language=1000)
        probe = [t for own in texts.values() for t in own[:20]]
        assert model.languages == ["aa", "bb"]
        assert np.array_equal(model.score([p.encode() for p in probe]), plain.score([p.encode() for p in probe]))
