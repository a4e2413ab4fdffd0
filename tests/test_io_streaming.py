"""Readers/writers and streaming on small inputs."""

import datetime as dt
import os

from pyspark.sql import functions as F

from plume.operators import ingest
from plume.sources import io
from plume.sources.store import versions
from plume.streaming import reviews_stream as S
from plume.plans.streaming_queries import SOURCE_SCHEMA


def test_csv_roundtrip_keeps_quotes_newlines_and_spaces(spark, tmp_dir):
    rows = [('He said "hi", then left', "Positive", "5", "a"), ("line1\nline2", " negative ", "1", None),
            ("  padded  ", "Neutral", "3", "b"), ("", "Positive", "4", "c")]
    df = spark.createDataFrame(rows, io.REVIEW_CSV_SCHEMA)
    io.write_csv(df, f"{tmp_dir}/csv")
    back = io.read_reviews_csv(spark, f"{tmp_dir}/csv")
    got = sorted((r.Translated_Review or "", r.Sentiment) for r in back.collect())
    assert got == sorted((r[0], r[1]) for r in rows)


def test_partitioned_write_and_expiry(spark, tmp_dir):
    rows = [(i, f"text {i}", "Positive", 4.0, "a", 6, 2, "Short", "Good", 1.0,
             dt.datetime(2024, 1, 1) + dt.timedelta(days=i * 40), "s") for i in range(4)]
    df = spark.createDataFrame(rows, "rid long, review_text string, sentiment string, rating double, "
                                     "app_name string, review_length long, review_word_count long, "
                                     "review_length_category string, rating_category string, "
                                     "sentiment_binary double, ingestion_timestamp timestamp_ntz, "
                                     "data_source string")
    path = f"{tmp_dir}/raw"
    io.write_raw_reviews(df, path)
    assert io.read_raw_reviews(spark, path, since=dt.date(2024, 3, 1)).count() == 2
    plan = io.read_raw_reviews(spark, path, since=dt.date(2024, 3, 1))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "ingestion_date" in plan
    removed = io.expire_partitions(spark, path, dt.date(2024, 5, 1), days=90)
    assert removed == ["ingestion_date=2024-01-01"]
    assert spark.read.parquet(path).count() == 3


def test_stream_files_stay_small_as_the_input_grows(spark, monkeypatch):
    from plume.plans import streaming_queries as Q
    for size in (1 << 30, 6 << 30, 1 << 40):
        monkeypatch.setattr(Q, "table_bytes", lambda spark, path, size=size: size // 2)
        assert size / Q._files(spark, "x") <= 17 << 20
    monkeypatch.setattr(Q, "table_bytes", lambda spark, path: 100)
    assert Q._files(spark, "x") == Q.LEAST_FILES


def _write_files(spark, tmp_dir, batches):
    """One Parquet file per batch, with increasing modification times (the
    file source takes files in arrival order)."""
    src = f"{tmp_dir}/src"
    os.makedirs(src)
    for i, rows in enumerate(batches):
        part = f"{tmp_dir}/part{i}"
        spark.createDataFrame(rows, SOURCE_SCHEMA).coalesce(1).write.parquet(part)
        f = [n for n in os.listdir(part) if n.endswith(".parquet")][0]
        dst = f"{src}/batch{i}.parquet"
        os.replace(f"{part}/{f}", dst)
        os.utime(dst, (1_700_000_000 + 100 * i, 1_700_000_000 + 100 * i))
    return src


def test_stream_windows_drop_late_rows(spark, tmp_dir):
    d = lambda day: dt.datetime(2024, 1, day, 12)
    b1 = [(1, "good app", "Positive", "5", "a", d(10)), (2, "bad app", "Negative", "1", "a", d(10))]
    b2 = [(3, "later app", "Positive", "5", "a", d(20))]
    b3 = [(6, "on time", "Negative", "1", "a", d(20))]  # a batch after the watermark has passed day 10: evicts it
    b4 = [(4, "late one", "Positive", "5", "a", d(10)), (5, "ok one", "Neutral", "3", "a", d(20))]
    src = _write_files(spark, tmp_dir, [b1, b2, b3, b4])
    out = S.run_sentiment_windows(spark, src, SOURCE_SCHEMA, f"{tmp_dir}/sink", f"{tmp_dir}/ckpt",
                                  delay="1 day", files_per_batch=1)
    got = {(r.window_start.day, r.sentiment): r.reviews for r in out.collect()}
    # The day-10 row of the last file is behind the watermark (day 19 12:00): it is not counted.
    assert got == {(10, "Positive"): 1, (10, "Negative"): 1, (20, "Positive"): 1, (20, "Neutral"): 1, (20, "Negative"): 1}
    spikes = {r.window_start.day: r for r in S.negative_spikes(out).collect()}
    assert spikes[20].negative_share == 0.333333 and spikes[10].negative == 1


def _counts(spark, rows):
    t = lambda day: f"TIMESTAMP_NTZ'2024-01-{day:02d} 00:00:00'"
    return spark.sql(" UNION ALL ".join(
        f"SELECT {t(d)} AS window_start, {t(d + 1)} AS window_end, '{s}' AS sentiment, CAST({n} AS BIGINT) AS reviews" for d, s, n in rows))


def test_a_batch_reads_its_predecessor_only(spark, tmp_dir):
    sink, spikes = f"{tmp_dir}/counts", f"{tmp_dir}/spikes"
    write = S.upsert_batches(sink, spikes)
    want, sizes = {}, []
    for b in range(12):
        rows = [(1 + b % 5, "Negative", 10 * b + 1), (20, "Positive", b + 1)]
        want.update({(d, s): n for d, s, n in rows})
        write(_counts(spark, rows), b)
        assert {(r.window_start.day, r.sentiment): r.reviews for r in S.latest_counts(spark, sink).collect()} == want
        files = [os.path.join(p, f) for p, _, fs in os.walk(sink) for f in fs if f.endswith(".parquet")]
        sizes.append(sum(map(os.path.getsize, files)))
    # what a batch can read is a few versions, and does not grow with the number of batches
    assert versions(spark, sink) == versions(spark, spikes) == [9, 10, 11]
    assert max(sizes[6:]) <= 1.2 * sizes[5]
    assert {r.window_start.day: r.total for r in S.latest_spikes(spark, spikes).collect()}[20] == 12


def test_a_replayed_batch_gives_the_same_version(spark, tmp_dir):
    sink = f"{tmp_dir}/counts"
    write = S.upsert_batches(sink)
    rows = lambda: {tuple(r) for r in S.latest_counts(spark, sink).collect()}
    write(_counts(spark, [(1, "Negative", 5), (2, "Positive", 7)]), 0)
    write(_counts(spark, [(1, "Negative", 6)]), 1)
    once = rows()
    write(_counts(spark, [(1, "Negative", 6)]), 1)
    assert rows() == once and len(once) == 2
    os.remove(f"{sink}/version=1/_SUCCESS")  # a batch that was cut off: its version is not read, and written again
    assert {r[3] for r in rows()} == {5, 7}
    write(_counts(spark, [(1, "Negative", 6)]), 1)
    assert rows() == once


def test_stream_dedup_keeps_first(spark, tmp_dir):
    d = lambda day: dt.datetime(2024, 1, day)
    b1 = [(1, "same text", "Positive", "5", "first", d(1))]
    b2 = [(2, "same text", "Positive", "5", "second", d(1)), (3, "new text", "Positive", "5", "x", d(1))]
    src = _write_files(spark, tmp_dir, [b1, b2])
    out = S.run_stream_dedup(spark, src, SOURCE_SCHEMA, f"{tmp_dir}/sink", f"{tmp_dir}/ckpt", delay="2 days")
    got = {r.review_text: r.app_name for r in out.collect()}
    assert got == {"same text": "first", "new text": "x"}


def test_catalog_sinks(spark, tmp_dir):
    from pyspark.sql import types as T
    from plume.operators import quality as Q
    io.ensure_namespace(spark, "plume_test")
    csv_dir = f"{tmp_dir}/orders_csv"
    with open(f"{tmp_dir}/o.csv", "w") as fh:
        fh.write("order_id,ts,amount\n1,2024-01-02 03:04:05,10.5\n2,2024-01-03 00:00:00,2.0\n")
    os.makedirs(csv_dir)
    os.replace(f"{tmp_dir}/o.csv", f"{csv_dir}/part1.csv")
    schema = T.StructType([T.StructField("order_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                           T.StructField("amount", T.DoubleType())])
    t = io.load_csv_table(spark, f"{csv_dir}/*.csv", "plume_test.orders", schema, "yyyy-MM-dd HH:mm:ss")
    assert t.count() == 2 and t.where("ts = TIMESTAMP_NTZ'2024-01-02 03:04:05'").count() == 1
    io.refresh(spark, "plume_test.orders")
    assert io.read_table(spark, "plume_test.orders", ["amount"]).columns == ["amount"]
    v = io.materialize(t.where("amount > 5"), "big_orders", "view")
    assert spark.sql("SELECT count(*) FROM big_orders").first()[0] == 1 and v.count() == 1
    res = spark.createDataFrame([("Hypothesis Test", "P-Value", 0.01, "d")],
                                "analysis_type string, metric_name string, metric_value double, description string")
    back = io.save_statistical_results(res, f"{tmp_dir}/stats", dt.datetime(2024, 1, 1))
    assert back.schema == io.STATISTICAL_RESULTS_SCHEMA and back.first().metric_value == 0.01
    io.export_parquet(t, f"{tmp_dir}/export", partition_by=["order_id"])
    assert spark.read.parquet(f"{tmp_dir}/export").where("order_id = 2").count() == 1
    io.store_failures(Q.not_null(t, "amount"), f"{tmp_dir}/fail")
    assert spark.read.parquet(f"{tmp_dir}/fail").count() == 0
