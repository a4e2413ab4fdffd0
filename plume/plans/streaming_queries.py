"""Registered streaming queries: the review file is split into Parquet files
that an available-now stream ingests in micro-batches (one file each)."""

from __future__ import annotations

from pyspark.sql import types as T

from ..sources.fixtures import review_file
from ..sources.store import mark_done, table_bytes, written_once
from ..streaming import reviews_stream as S
from .reviews import _inputs

SOURCE_SCHEMA = T.StructType([
    T.StructField("rid", T.LongType()), T.StructField("Translated_Review", T.StringType()),
    T.StructField("Sentiment", T.StringType()), T.StructField("Rating", T.StringType()),
    T.StructField("App", T.StringType()), T.StructField("ingestion_timestamp", T.TimestampNTZType())])
LEAST_FILES = 8           # a small input still makes two micro-batches, so state is carried
BYTES_PER_FILE = 16 << 20  # of input; a task writes or reads one file, so its share stays the same from 128 MB on
MICRO_BATCHES = 16        # at most, per run; each takes an equal number of files
# The fixture's files mix all 30 days, so a watermark shorter than that would
# (correctly) drop rows as late; the registered runs use a delay covering the
# month so their totals equal the batch tables.  Tests exercise short delays.
DELAY = "31 days"


def _files(spark, d) -> int:
    """Files of the stream's source, from the size of its input."""
    return max(LEAST_FILES, sum(table_bytes(spark, p) for p in _inputs(d)) // BYTES_PER_FILE)


def _source(spark, d) -> str:
    def write(path: str) -> None:
        (review_file(spark, d).select(*[f.name for f in SOURCE_SCHEMA.fields])
         .repartition(_files(spark, d), "rid").write.mode("overwrite").parquet(path))
    return written_once(spark, "review_stream_source", _inputs(d), write)


def _run(spark, d, name, runner):
    src = _source(spark, d)

    def write(path: str) -> None:
        runner(spark, src, SOURCE_SCHEMA, f"{path}/sink", f"{path}/checkpoint", DELAY,
               max(LEAST_FILES // 2, _files(spark, d) // MICRO_BATCHES))
        mark_done(spark, path)
    return written_once(spark, name, _inputs(d), write, in_place=True)


def _windows_and_spikes(spark, src, schema, sink, checkpoint, delay, files_per_batch):
    base = sink.rsplit("/", 1)[0]
    return S.run_sentiment_windows(spark, src, schema, sink, checkpoint, delay, files_per_batch,
                                   spikes_sink=f"{base}/spikes")


def stream_sentiment_windows(spark, d):
    path = _run(spark, d, "stream_sentiment_windows", _windows_and_spikes)
    return S.latest_counts(spark, f"{path}/sink")


def stream_negative_spikes(spark, d):
    """ST3 as maintained by the stream itself (flags of the newest micro-batch)."""
    path = _run(spark, d, "stream_sentiment_windows", _windows_and_spikes)
    return S.latest_spikes(spark, f"{path}/spikes")


def stream_dedup(spark, d):
    path = _run(spark, d, "stream_dedup", S.run_stream_dedup)
    return spark.read.parquet(f"{path}/sink").select(*S.KEY)


QUERIES = {
    "stream_sentiment_windows": stream_sentiment_windows,
    "stream_negative_spikes": stream_negative_spikes,
    "stream_dedup": stream_dedup,
}
