"""Documents for the operators' tests."""

import random

import pytest
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

SF = "/root/testdata/sf0.001"

#: documents, and columns whose names clash with the operators' own
SCHEMA = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
    StructField("source", StringType()), StructField("n_chars", LongType()),
    *[StructField(c, StringType()) for c in ("fingerprint", "fp", "uid", "kept", "lang_pred", "piece", "spans", "range", "w")],
    StructField("score", DoubleType())])


def make(spark, rows):
    """rows: (doc_id, text, lang, source)."""
    full = [(i, t, lang, s, None if t is None else len(t), *["x"] * 9, 0.5) for i, t, lang, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def odd_rows():
    rng = random.Random(7)
    words = ["the", "and", "haus", "l'eau", "it's", "naïve", "Σας", "x1y", "3.14", "日本", "\U0001f600", "é"]
    long = " ".join(rng.choice(words) + str(rng.randrange(500)) for _ in range(30_000))
    return [
        (900001, None, "en", "odd"), (900002, "", "en", "odd"), (900003, " \t\n\x0b\f\r ", None, None),
        (900004, long, "en", "odd"), (900005, "one two", "fr", None), (900006, "...!!! 123 ''s", "en", "odd"),
        (900007, "same text here again", "en", "odd"), (900007, "same text here again", "en", "odd"),
        (900008, "same text here again", "en", "odd"), (900008, "another text, same id", "de", "odd"),
        (None, "no id at all", "en", "odd"), (None, "no id at all", "en", "odd"), (None, None, None, None),
        (900009, "a<|endoftext|>b <|startoftext|> c's<|endoftext|>", "en", "odd"),
        (900010, " wide space\u0085é combining\nline\nline\n\nline", "en", "odd"),
        (-5, "negative id", "en", "odd"), (900011, "日本語のテキスト", "ja", "odd"),
        (900012, " ".join(["again and"] * 60), "en", "odd"), (900013, "y" * 20_000, "en", "odd"),
    ]


@pytest.fixture(scope="session")
def base_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return [(r.doc_id, r.text, r.lang, r.source) for r in docs.orderBy("doc_id").collect()]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Odd rows alone."""
    return make(spark, odd_rows())


@pytest.fixture(scope="session")
def mixed(spark, base_rows):
    """(rows, DataFrame): the small table with odd rows among it."""
    rows = base_rows[:120] + odd_rows()
    return rows, make(spark, rows).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return make(spark, [])


