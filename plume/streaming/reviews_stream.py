"""Structured Streaming over review files (ST1-ST4).

The batch column functions are reused unchanged on the stream; state lives
in the streaming checkpoint (shared folder), and every sink write is
idempotent per micro-batch id so a retried batch after an executor or
driver failure leaves the same result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import epoch_micros, rnd
from ..operators import ingest
from ..sources.store import remove_folder, versions

KEY = ["review_text", "rating", "sentiment"]


def _instant(ts_ntz: str):
    """TIMESTAMP_NTZ read as UTC -> TIMESTAMP instant, independent of the session zone."""
    return F.timestamp_micros(epoch_micros(ts_ntz))


def _ntz(ts_col):
    """TIMESTAMP instant -> TIMESTAMP_NTZ in UTC, independent of the session zone."""
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(
        secs=(F.unix_micros(ts_col) / F.lit(1_000_000)).cast("decimal(18,6)"))


def review_stream(spark: SparkSession, source: str, schema: T.StructType, files_per_batch: int = 1) -> DataFrame:
    """ST1 source: Parquet review files picked up as they arrive, ingested.

    ``event_time`` is the ingestion time as an instant (watermarks need
    TIMESTAMP, the files carry TIMESTAMP_NTZ).
    """
    raw = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source))
    return ingest.ingest_reviews(raw).withColumn("event_time", _instant("ingestion_timestamp"))


def sentiment_windows(reviews: DataFrame, delay: str = "1 day", width: str = "1 day") -> DataFrame:
    """ST2: reviews per (tumbling window, sentiment) with a watermark.

    Rows arriving within ``delay`` of the newest event time are always
    counted; window state older than the watermark is evicted, after which
    later rows for it are not guaranteed to count (Spark's one-sided
    watermark guarantee)."""
    return (reviews.withWatermark("event_time", delay)
                   .groupBy(F.window("event_time", width).alias("w"), "sentiment")
                   .agg(F.count(F.lit(1)).alias("reviews"))
                   .select(_ntz(F.col("w.start")).alias("window_start"), _ntz(F.col("w.end")).alias("window_end"),
                           "sentiment", "reviews"))


def stream_dedup(reviews: DataFrame, delay: str = "1 day") -> DataFrame:
    """ST4: drop repeats of (text, rating, sentiment) within the watermark.

    Unlike the batch dedup (newest row wins) the stream keeps the *first*
    row it sees; the state of a key expires once the watermark passes it.
    The state holds the text's SHA-256, not the text.
    """
    hashed = ["text_sha256", *[k for k in KEY if k != "review_text"]]
    return (reviews.withColumn("text_sha256", F.sha2("review_text", 256)).withWatermark("event_time", delay)
                   .dropDuplicatesWithinWatermark(hashed).drop("text_sha256"))


WINDOW_KEYS = ("window_start", "window_end", "sentiment")
KEPT_VERSIONS = 3


def upsert_batches(sink: str, spikes_sink: str | None = None, keys: tuple[str, ...] = WINDOW_KEYS, value: str = "reviews"):
    """foreachBatch writer of a compacted, versioned count table.

    A micro-batch merges its updated rows into the newest version before its
    own and writes the result as ``version=<batch id>``: it reads one row per
    key and its own rows, however many batches went before.  A replayed batch
    starts from the same predecessor and overwrites its version, so it gives
    the same one.  The last ``KEPT_VERSIONS`` stay, for replays and readers.
    With ``spikes_sink`` the negative-share flags (ST3) of the new version are
    written as a version of their own.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = [v for v in versions(spark, sink) if v < batch_id]
        rows = batch.select(*keys, value, F.lit(1).alias("_new"))
        if earlier:
            rows = rows.unionByName(_version(spark, sink, earlier[-1]).select(*keys, value, F.lit(0).alias("_new")))
        rows.groupBy(*keys).agg(F.max_by(value, "_new").alias(value)).write.mode("overwrite").parquet(f"{sink}/version={batch_id}")
        if spikes_sink:
            negative_spikes(_version(spark, sink, batch_id)).write.mode("overwrite").parquet(f"{spikes_sink}/version={batch_id}")
        for v in earlier[:1 - KEPT_VERSIONS]:
            for folder in filter(None, (sink, spikes_sink)):
                remove_folder(spark, f"{folder}/version={v}")
    return write


def _version(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """A version of the table in ``folder``, by default the newest complete one."""
    return spark.read.parquet(f"{folder}/version={versions(spark, folder)[-1] if version is None else version}")


def latest_spikes(spark: SparkSession, spikes_sink: str) -> DataFrame:
    """The spike flags as of the newest completed micro-batch."""
    return _version(spark, spikes_sink)


def latest_counts(spark: SparkSession, sink: str) -> DataFrame:
    """The window counts as of the newest completed micro-batch."""
    return _version(spark, sink)


def run_sentiment_windows(spark: SparkSession, source: str, schema: T.StructType, sink: str, checkpoint: str,
                          delay: str = "1 day", files_per_batch: int = 1,
                          spikes_sink: str | None = None) -> DataFrame:
    """ST1+ST2(+ST3) end to end with an available-now trigger (processes what
    is there, in micro-batches, then stops); returns the current window counts."""
    counts = sentiment_windows(review_stream(spark, source, schema, files_per_batch), delay)
    q = (counts.writeStream.outputMode("update").foreachBatch(upsert_batches(sink, spikes_sink))
               .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return latest_counts(spark, sink)


def run_stream_dedup(spark: SparkSession, source: str, schema: T.StructType, sink: str, checkpoint: str,
                     delay: str = "1 day", files_per_batch: int = 1) -> DataFrame:
    """ST1+ST4: deduplicated review stream appended to a Parquet sink."""
    d = stream_dedup(review_stream(spark, source, schema, files_per_batch), delay)
    q = (d.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
          .trigger(availableNow=True).start(sink))
    q.awaitTermination()
    return spark.read.parquet(sink)


def negative_spikes(window_counts: DataFrame, trailing: int = 7, factor: float = 1.5) -> DataFrame:
    """ST3: flag windows whose negative share exceeds ``factor`` x the mean
    share of the preceding ``trailing`` windows.  One row per window, so the
    ordered window runs over windows, not reviews."""
    w = window_counts.groupBy("window_start").agg(
        F.sum("reviews").alias("total"),
        F.sum(F.when(F.col("sentiment") == "Negative", F.col("reviews")).otherwise(0)).alias("negative"))
    share = F.col("negative") / F.col("total")
    prev = Window.orderBy("window_start").rowsBetween(-trailing, -1)
    out = w.withColumn("negative_share", share).withColumn("trailing_share", F.avg("negative_share").over(prev))
    return out.select("window_start", "total", "negative", rnd("negative_share", 6).alias("negative_share"),
                      rnd("trailing_share", 6).alias("trailing_share"),
                      F.coalesce(F.col("negative_share") > factor * F.col("trailing_share"), F.lit(False))
                      .alias("negative_spike"))
