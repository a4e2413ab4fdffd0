"""End-to-end jobs on the smoke tables."""

from plume.plans import jobs, reviews, warehouse as W

from conftest import SF_SMALL


def test_run_reviews_writes_all_tables(spark, tmp_dir):
    paths = jobs.run_reviews(spark, SF_SMALL, tmp_dir)
    an = spark.read.parquet(paths["reviews_analyzed"])
    assert an.count() == reviews.analyzed(spark, SF_SMALL).count()
    assert "transformation_timestamp" in an.columns
    assert spark.read.parquet(paths["statistical_results"]).count() == 6
    assert spark.read.parquet(paths["raw_reviews"]).select("ingestion_date").distinct().count() > 1
    assert spark.read.parquet(paths["feeds/kpi_cards"]).count() == 1
    assert spark.read.parquet(paths["feeds/rating_by_sentiment"]).count() == 3


def test_run_warehouse_writes_marts_and_checks(spark, tmp_dir):
    res = jobs.run_warehouse(spark, SF_SMALL, tmp_dir)
    kpis = spark.read.parquet(f"{tmp_dir}/marts/fct_unified_business_kpis")
    assert kpis.count() == 364 and "created_at" in kpis.columns
    assert spark.read.parquet(f"{tmp_dir}/tests/results").count() == 37
    for model, column, test in res["failing_tests"]:
        assert spark.read.parquet(f"{tmp_dir}/tests/failures/model={model}/column_name={column}/test_name={test}").count() > 0
    assert spark.read.parquet(f"{tmp_dir}/run_summary").count() == 8
    dims = spark.read.parquet(f"{tmp_dir}/marts/dim_user_engagement")
    assert dims.count() == W.user_profiles(spark, SF_SMALL).count()


def test_concurrent_first_uses_build_once(spark):
    import threading
    import uuid
    from plume.sources.store import remove_folder, table_root
    old = spark.conf.get("spark.plume.tableNamespace", None)
    spark.conf.set("spark.plume.tableNamespace", f"conc-{uuid.uuid4().hex}")
    try:
        out, errs = [], []

        def run():
            try:
                out.append(reviews.analyzed(spark, SF_SMALL).count())
            except Exception as e:  # noqa: BLE001
                errs.append(e)
        threads = [threading.Thread(target=run) for _ in range(3)]
        [t.start() for t in threads]
        [t.join() for t in threads]
        assert not errs and len(set(out)) == 1
        remove_folder(spark, table_root(spark))
    finally:
        spark.conf.set("spark.plume.tableNamespace", old or "")


def test_expire_shared_removes_only_old_intermediates(spark):
    import os
    import time
    import uuid
    from plume.sources.store import expire_shared, remove_folder, shared, table_root
    old = spark.conf.get("spark.plume.tableNamespace", None)
    spark.conf.set("spark.plume.tableNamespace", f"exp-{uuid.uuid4().hex}")
    try:
        shared(spark.range(3))
        shared(spark.range(4))
        root = table_root(spark) + "/_shared"
        local = root.replace("file:", "")
        first = sorted(os.listdir(local))[0]
        past = time.time() - 3 * 86400
        os.utime(os.path.join(local, first), (past, past))
        assert expire_shared(spark, older_than_hours=24) == [first]
        assert len(os.listdir(local)) == 1
        remove_folder(spark, table_root(spark))
    finally:
        spark.conf.set("spark.plume.tableNamespace", old or "")


def test_a_half_written_table_is_built_again(spark, tmp_dir):
    import os
    import uuid
    from plume.sources.store import materialized, release_shared, remove_folder, shared, table_root, written_once
    old = spark.conf.get("spark.plume.tableNamespace", None)
    spark.conf.set("spark.plume.tableNamespace", f"half-{uuid.uuid4().hex}")
    try:
        src = f"{tmp_dir}/src"
        spark.range(5).write.parquet(src)
        build = lambda: materialized(spark, "t", [src], lambda: spark.read.parquet(src))
        assert build().count() == 5
        path = written_once(spark, "t", [src], lambda p: None).replace("file:", "")
        os.remove(f"{path}/_SUCCESS")  # a rename that was cut off
        for f in os.listdir(path):
            if f.endswith(".parquet"):
                os.remove(f"{path}/{f}")
        assert build().count() == 5
        spark.range(3).write.mode("append").parquet(src)  # appended in the same session
        assert build().count() == 8
        kept = shared(spark.range(2))
        folder = f"{table_root(spark)}/_shared".replace("file:", "")
        assert kept.count() == 2 and len(os.listdir(folder)) == 1
        release_shared(spark)
        assert os.listdir(folder) == []
        remove_folder(spark, table_root(spark))
    finally:
        spark.conf.set("spark.plume.tableNamespace", old or "")


def test_a_shared_folder_is_required_off_one_process():
    import pytest
    from plume.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key):
                raise KeyError(key)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_reloading_raw_reviews_truncates(spark, tmp_dir):
    import datetime as dt
    from plume.sources import io
    rows = lambda day: spark.createDataFrame([("a text", 5.0, "Positive", dt.datetime(2024, 1, day))],
                                             "review_text string, rating double, sentiment string, ingestion_timestamp timestamp_ntz")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        io.write_raw_reviews(rows(1).union(rows(2)), f"{tmp_dir}/raw")
        io.write_raw_reviews(rows(3), f"{tmp_dir}/raw")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [r.ingestion_timestamp.day for r in io.read_raw_reviews(spark, f"{tmp_dir}/raw").collect()] == [3]
