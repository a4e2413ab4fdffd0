"""Reference-shaped inputs derived from the driver tables.

The original project reads inputs that are not in the driver data (an app
review CSV and three warehouse exports).  These builders derive tables of
the same shape from the driver tables, always with Spark, so that their size
grows with the data.  The recipes are synthetic (see FIXTURES.md); they only
exercise the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import spread
from .tables import table

# Offsets of the synthetic recipes (our choices).
LINE_ID_FACTOR = 100_000
REVIEW_EPOCH = "2024-01-01"


def review_file(spark: SparkSession, sf_dir: str, even: bool = False) -> DataFrame:
    """Raw review 'file': one row per line of ``documents.text``.

    Columns use the spellings of a downloaded review file (``Translated_Review``,
    ``Sentiment``, ``Rating``, ``App``) so the ingestion step has to
    standardize them; ``rid`` identifies the source line and
    ``ingestion_timestamp`` spreads the rows over 30 days.

    The labels join happens before the lines are exploded, so it moves one
    row per document; the text is split inside the row (no shuffle).
    ``even`` deals the documents over partitions of equal size for a CPU-heavy
    stage: one row per document moves, not one per line with its columns, and
    the join takes the labels as hash tables, so no text is sorted.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    # Only a toxic or quality label changes the outcome (other rows fall to the
    # doc_id rules either way), so the lookup side keeps just those rows: a
    # smaller side that AQE can broadcast instead of moving document text.
    labels = (table(spark, sf_dir, "labels").where((F.col("toxic") == 1) | (F.col("quality") == 1))
              .select("doc_id", "quality", "toxic"))
    if even:
        docs, labels = spread(docs, "doc_id"), labels.hint("shuffle_hash")
    d = docs.join(labels, "doc_id", "left")
    doc = F.col("doc_id")
    sentiment = (F.when(F.col("toxic") == 1, "Negative").when(F.col("quality") == 1, "Positive")
                 .when(doc % 3 == 0, " negative ").when(doc % 17 == 5, "unknown")
                 .otherwise("NEUTRAL"))
    base = (F.when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 3)
            .when(doc % 3 == 0, 1).otherwise(2))
    lines = d.select(
        "doc_id", F.col("source").alias("App"), sentiment.alias("Sentiment"), base.alias("_base"),
        F.posexplode(F.split("text", "\n", -1)).alias("line_no", "Translated_Review"))
    rid = F.col("doc_id") * LINE_ID_FACTOR + F.col("line_no")
    rating = F.when(rid % 50 == 7, F.lit("N/A")).otherwise(
        (F.col("_base") + rid % 3 + F.when(rid % 20 == 0, 0.5).otherwise(0.0)).cast("string"))
    ts = F.date_add(F.lit(REVIEW_EPOCH).cast("date"), (F.col("doc_id") % 30).cast("int")) \
        .cast("timestamp_ntz")
    return lines.select(
        rid.alias("rid"), "Translated_Review", "Sentiment", rating.alias("Rating"), "App",
        ts.alias("ingestion_timestamp"))


REVIEW_FILE_SQL = f"""
review_docs AS (
  SELECT d.doc_id, d.source, string_split(d.text, chr(10)) AS parts,
    CASE WHEN l.toxic = 1 THEN 'Negative' WHEN l.quality = 1 THEN 'Positive'
         WHEN d.doc_id % 3 = 0 THEN ' negative ' WHEN d.doc_id % 17 = 5 THEN 'unknown'
         ELSE 'NEUTRAL' END AS sentiment_raw,
    CASE WHEN l.toxic = 1 THEN 1 WHEN l.quality = 1 THEN 3 WHEN d.doc_id % 3 = 0 THEN 1
         ELSE 2 END AS base
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
),
review_lines AS (
  SELECT doc_id, source, sentiment_raw, base,
         unnest(range(len(parts))) AS line_no, unnest(parts) AS line
  FROM review_docs
),
review_file AS (
  SELECT doc_id * {LINE_ID_FACTOR} + line_no AS rid, line AS review_text_raw,
         sentiment_raw,
         CASE WHEN (doc_id * {LINE_ID_FACTOR} + line_no) % 50 = 7 THEN 'N/A'
              ELSE CAST(CAST(base + (doc_id * {LINE_ID_FACTOR} + line_no) % 3
                   + CASE WHEN (doc_id * {LINE_ID_FACTOR} + line_no) % 20 = 0 THEN 0.5 ELSE 0.0 END
                   AS DOUBLE) AS VARCHAR) END AS rating_raw,
         source AS app_raw,
         CAST(DATE '{REVIEW_EPOCH}' + CAST(doc_id % 30 AS INTEGER) AS TIMESTAMP) AS ingestion_timestamp
  FROM review_lines
)"""
