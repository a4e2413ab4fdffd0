"""Readers and writers.

Everything goes through Spark's distributed readers and writers: no file
content passes through the driver.  Paths may be any Hadoop-compatible URI;
partition housekeeping uses the Hadoop FileSystem API (metadata only).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import ntz_lit

# ---- A1 / A2: review CSV -----------------------------------------------------

REVIEW_CSV_SCHEMA = T.StructType([
    T.StructField("Translated_Review", T.StringType()),
    T.StructField("Sentiment", T.StringType()),
    T.StructField("Rating", T.StringType()),
    T.StructField("App", T.StringType()),
])

_CSV_OPTIONS = {"header": "true", "multiLine": "true", "escape": '"', "quote": '"',
                "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_reviews_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A1: CSV with header, quoted multi-line fields, RFC-4180 quote doubling.

    A fixed schema (all text) instead of inference: inference costs a full
    extra pass and would guess types per file.  Every value stays text; the
    NA spellings are mapped to NULL during ingestion.
    """
    return (spark.read.schema(schema or REVIEW_CSV_SCHEMA).options(**_CSV_OPTIONS)
                 .option("mode", "PERMISSIVE").csv(path))


def write_csv(df: DataFrame, path: str) -> None:
    """A2: CSV with header, same quoting as the reader, whitespace kept."""
    df.write.mode("overwrite").options(**_CSV_OPTIONS).csv(path)


# ---- A3 / A4 / A7 / A8 / A14 / A15: catalog ----------------------------------

def ensure_namespace(spark: SparkSession, name: str) -> None:
    """A4."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def materialize(df: DataFrame, name: str, kind: str = "table", path: str | None = None) -> DataFrame:
    """``view`` registers a lazy temp view; ``table`` writes
    (create or replace) and returns the table."""
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if kind != "table":
        raise ValueError(kind)
    w = df.write.mode("overwrite").format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return spark.table(name)


def load_csv_table(spark: SparkSession, path: str, table: str, schema: T.StructType,
                   timestamp_format: str | None = None, table_path: str | None = None) -> DataFrame:
    """Truncating bulk load of CSV file(s) (globs allowed) into a table."""
    r = spark.read.schema(schema).option("header", "true")
    if timestamp_format:
        r = r.option("timestampFormat", timestamp_format)
    return materialize(r.csv(path), table, "table", table_path)


def read_table(spark: SparkSession, name: str, columns=None) -> DataFrame:
    """Read a table with only the needed columns (pruned at the scan)."""
    df = spark.table(name)
    return df.select(*columns) if columns else df


# ---- A5 / A6: day-partitioned raw table ----------------------------------------

def write_raw_reviews(df: DataFrame, path: str) -> None:
    """A5: truncating load, partitioned by ingestion day, clustered by (sentiment, rating).

    Rows are rebalanced by day: a large day is written by as many tasks as its
    size asks for, small days share tasks.  Inside each task rows are sorted by
    the clustering keys so Parquet min/max statistics can skip row groups.
    Days of an earlier load do not survive, whatever the session's overwrite mode.
    """
    out = df.withColumn("ingestion_date", F.to_date("ingestion_timestamp"))
    (out.hint("rebalance", "ingestion_date")
        .sortWithinPartitions("ingestion_date", "sentiment", "rating")
        .write.mode("overwrite").option("partitionOverwriteMode", "static")
        .partitionBy("ingestion_date").parquet(path))


def read_raw_reviews(spark: SparkSession, path: str, since: dt.date | None = None) -> DataFrame:
    """Read the partitioned table; a date bound prunes partitions at planning time."""
    df = spark.read.parquet(path)
    return df.where(F.col("ingestion_date") >= F.lit(since)) if since else df


def expire_partitions(spark: SparkSession, path: str, as_of: dt.date, days: int = 90) -> list[str]:
    """Delete ``ingestion_date=`` partitions older than ``days`` before ``as_of``.

    Partition expiry is directory housekeeping: the folders are listed and
    removed through the Hadoop FileSystem API, no rows are read.
    """
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    cutoff = as_of - dt.timedelta(days=days)
    removed = []
    if not fs.exists(root):
        return removed
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("ingestion_date="):
            day = dt.date.fromisoformat(name.split("=", 1)[1])
            if day < cutoff:
                fs.delete(st.getPath(), True)
                removed.append(name)
    return sorted(removed)


# ---- A11 / A12 / A13 / A16 ------------------------------------------------------

def export_parquet(df: DataFrame, path: str, partition_by=None) -> None:
    """Parquet export (overwrite)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def refresh(spark: SparkSession, table: str, partitioned: bool = False) -> None:
    """Refresh cached metadata (and discover new partitions) of an external table."""
    if partitioned:
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    spark.catalog.refreshTable(table)


STATISTICAL_RESULTS_SCHEMA = T.StructType([
    T.StructField("analysis_type", T.StringType()),
    T.StructField("metric_name", T.StringType()),
    T.StructField("metric_value", T.DoubleType()),
    T.StructField("description", T.StringType()),
    T.StructField("analysis_timestamp", T.TimestampNTZType()),
])


def save_statistical_results(results: DataFrame, path: str, analysis_ts: dt.datetime) -> DataFrame:
    """Results with the fixed schema, truncating write; the time is an argument."""
    df = results.select("analysis_type", "metric_name", F.col("metric_value").cast("double"), "description",
                        ntz_lit(analysis_ts).alias("analysis_timestamp"))
    df.write.mode("overwrite").parquet(path)
    return results.sparkSession.read.schema(STATISTICAL_RESULTS_SCHEMA).parquet(path)


def store_failures(failing: DataFrame, path: str) -> None:
    """Keep failing rows as a table for inspection; those of a whole suite
    (``quality.stored_failures``) in one folder per test."""
    w = failing.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if {"model", "column_name", "test_name"} <= set(failing.columns):
        w = w.partitionBy("model", "column_name", "test_name")
    w.parquet(path)
