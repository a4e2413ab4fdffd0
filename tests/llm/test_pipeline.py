"""The pipeline's stages against the operators' own results."""

import base64
import random
from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from llm_rows import SF, base_rows, make, mixed, no_docs  # noqa: F401  fixtures

from plume.llm import language, quality_rules, queries, secrets, simhash
from plume.llm.common import written

KEPT_TABLES = 4


@pytest.fixture(scope="module")
def steps(spark, mixed):
    """What each stage was given and what it returned."""
    docs, out = mixed[1], []
    for name, stage in corpus_pipeline.STAGES:
        result = written(stage(spark, docs, SF), "test")
        out.append((name, docs, result))
        docs = result
    return out


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_stages_keep_the_columns(steps):
    assert [n for n, _, _ in steps] == ["quality_rules", "language_id", "simhash_near_dedup", "secret_scan", "best_fit_packing"]
    for _, docs, result in steps[:KEPT_TABLES]:
        assert result.columns == docs.columns and dict(result.dtypes) == dict(docs.dtypes)


def test_quality_stage(steps):
    _, docs, result = steps[0]
    assert ids(result) == Counter(r.doc_id for r in quality_rules.quality(docs).where("kept").collect())


def test_language_stage(steps):
    _, docs, result = steps[1]
    found = language.identify(docs, language.learn(docs, F.lit(True)))
    assert ids(result) == ids(found.where("lang_pred <> 'und' AND score >= 0.5"))


def test_language_stage_fills_and_rejects(spark, base_rows):
    rows = [r for r in base_rows if r[1] and len(r[1]) > 200][:60]
    en = next(t for _, t, lang, _ in rows if lang == "en")
    docs = make(spark, [*rows, (10**6, en, None, "s"), (10**6 + 1, "123 456", "en", "s"), (10**6 + 2, None, "en", "s")])
    got = {r.doc_id: r.lang for r in corpus_pipeline.STAGES[1][1](spark, docs, SF).collect()}
    assert got[10**6] == "en" and 10**6 + 1 not in got and 10**6 + 2 not in got and len(got) == len(rows) + 1


def test_language_stage_rejects_what_is_no_learnt_language(spark, base_rows):
    rng = random.Random(3)
    clean = [r for r in base_rows if r[1] and r[2] and len(r[1]) > 200][:120]
    noise = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(300)) for _ in range(20)]
    words = "мороз и солнце день чудесный ещё ты дремлешь друг прелестный пора красавица проснись открой сомкнуты негой взоры".split()
    russian = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(20)]
    blobs = [base64.b64encode(rng.randbytes(300)).decode() for _ in range(20)]
    bad = [(10**6 + i, t, None, "s") for i, t in enumerate(noise + russian + blobs)]
    got = {r.doc_id for r in corpus_pipeline.STAGES[1][1](spark, make(spark, [*clean, *bad]), SF).collect()}
    assert got == {r[0] for r in clean}
    unlabelled = make(spark, [(i, t, None, s) for i, t, _, s in clean])  # nothing to learn from: nothing to reject by
    assert corpus_pipeline.STAGES[1][1](spark, unlabelled, SF).count() == len(clean)


def test_near_duplicate_stage(steps):
    _, docs, result = steps[2]
    found = simhash.near_duplicates(docs, 3).select("component_id").distinct()
    assert ids(result) == Counter(r.component_id for r in found.collect())


def test_secret_stage(steps):
    _, docs, result = steps[3]
    want = Counter((r.doc_id, secrets.redact(r.text)) for r in docs.collect())
    assert Counter((r.doc_id, r.text) for r in result.collect()) == want
    assert all(r.n_chars == len(r.text) for r in result.collect())


def test_packing_stage(steps):
    _, docs, result = steps[4]
    assert set(ids(result)) == set(ids(docs))
    assert result.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0


def test_quality_stage_judges_rows_with_the_same_id_apart(spark):
    good = " ".join(f"word{k} other{k * 7}" for k in range(60))
    docs = make(spark, [(1, good, "en", "s"), (1, "too short", "en", "s"), (None, good, None, None), (None, None, None, None)])
    kept = corpus_pipeline.STAGES[0][1](spark, docs, SF)
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter([(1, good), (None, good)])


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    docs = queries.documents(spark, SF)
    assert 0 < out.select("doc_id").distinct().count() < docs.count()


def test_no_documents(spark, no_docs):
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "test")
    assert docs.collect() == []


def test_every_operator_is_registered(spark):
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 14))
