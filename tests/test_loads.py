"""Loads by header, stored failures, snapshots with untouched partitions."""

import datetime as dt
import os

import pytest
from pyspark.sql import types as T

from plume.operators import quality as Q
from plume.operators.quality import Test as Check
from plume.operators.warehouse import models as M
from plume.operators.warehouse import snapshot as S
from plume.sources import io, loads
from plume.sources.store import remove_folder

SCHEMA = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("day", T.DateType()), T.StructField("note", T.StringType())])


def _write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)


def test_columns_are_found_by_name_and_bad_rows_kept(spark, tmp_dir):
    _write(f"{tmp_dir}/in", "a.csv", 'id,day,note\n1,2024-01-02,"x, ""y"""\n2,,\n3,never,z\n,2024-01-02,z\n4,2024-01-02\n')
    _write(f"{tmp_dir}/in", "b.csv", "Note,extra,ID\nhi,0,5\n ,0,6\nhi,0,seven\na,b,8,more\n")
    _write(f"{tmp_dir}/in", "c.csv", "id,day,note\n")
    _write(f"{tmp_dir}/in", "_hidden.csv", "what\n1\n")
    got = loads.load_by_header(spark, f"{tmp_dir}/in/*.csv", SCHEMA, f"{tmp_dir}/table")
    day = dt.date(2024, 1, 2)
    assert sorted(map(tuple, got.rows.collect())) == [(1, day, 'x, "y"'), (2, None, None), (5, None, "hi"), (6, None, None)]
    rejects = got.rejects.collect()
    assert sorted(r.reason for r in rejects) == ["fields", "fields", "no id", "type of day", "type of id"]
    assert {r.raw for r in rejects} >= {"4,2024-01-02", "a,b,8,more", '{"id":"3","day":"never","note":"z"}'}
    assert {os.path.basename(r.file) for r in rejects} == {"a.csv", "b.csv"}
    # truncating: a second load replaces all
    again = loads.load_by_header(spark, f"{tmp_dir}/in/c.csv", SCHEMA, f"{tmp_dir}/table")
    assert again.rows.collect() == [] and again.rejects.collect() == []
    assert loads.load_by_header(spark, f"{tmp_dir}/none/*.csv", SCHEMA, f"{tmp_dir}/other").rows.count() == 0


def test_headers_are_checked_before_anything_is_written(spark, tmp_dir):
    _write(f"{tmp_dir}/in", "a.csv", "id,day\n1,2024-01-02\n")
    loads.load_by_header(spark, f"{tmp_dir}/in", SCHEMA, f"{tmp_dir}/table")
    for header in ("day,note", "id,ID,day"):
        _write(f"{tmp_dir}/in", "b.csv", f"{header}\n1,2,3\n")
        with pytest.raises(ValueError, match="b.csv"):
            loads.load_by_header(spark, f"{tmp_dir}/in", SCHEMA, f"{tmp_dir}/table")
        assert spark.read.parquet(f"{tmp_dir}/table").count() == 1


def test_times_of_any_session_zone(spark, tmp_dir):
    _write(f"{tmp_dir}/in", "a.csv", "order_id,customer_id,order_purchase_timestamp\n"
           "1,1,2024-03-10 02:30:00\n2,1,2024-11-03 01:30:00\n3,1,2024-02-30 01:30:00\n4,1,1955-01-01 00:00:01\n")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        load = loads.load_orders(spark, f"{tmp_dir}/in", f"{tmp_dir}/table")
        assert {r.order_id: str(r.order_purchase_timestamp) for r in load.rows.collect()} == {
            1: "2024-03-10 02:30:00", 2: "2024-11-03 01:30:00", 4: "1955-01-01 00:00:01"}
        assert [r.reason for r in load.rejects.collect()] == ["type of order_purchase_timestamp"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_stored_failures_in_one_scan(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (3, "c"), (3, "c"), (None, "b")], "k int, v string")
    tests = [Check("m", "k", "unique"), Check("m", "k", "not_null"), Check("m", "v", "accepted_values", ("a", "b")), Check("m", "v", "not_null"),
             Check("m", "k", "accepted_range", (), 0, 9)]
    out = Q.stored_failures({"m": df}, tests)
    want = {("k", "unique", '{"k":1}', 2), ("k", "unique", '{"k":3}', 2), ("k", "not_null", '{"k":null,"v":"b"}', 1),
            ("v", "accepted_values", '{"k":3,"v":"c"}', 2), ("v", "not_null", '{"k":1,"v":null}', 1)}
    assert {tuple(r)[1:] for r in out.collect()} == want
    plan = Q.stored_failures({"m": df}, tests)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1 and "partial_count" in plan
    assert Q.stored_failures({"m": df.where("false")}, tests).count() == 0
    io.store_failures(out, f"{tmp_dir}/f")
    assert spark.read.parquet(f"{tmp_dir}/f/model=m/column_name=k/test_name=unique").count() == 2
    # as many as the suite counts
    counts = {(r.column_name, r.test_name): r.failures for r in Q.run_suite({"m": df}, tests).collect()}
    for (column, test), n in counts.items():
        mine = [r for r in out.collect() if (r.column_name, r.test_name) == (column, test)]
        assert n == (len(mine) if test == "unique" else sum(r.n_records for r in mine))


def _state(spark, rows):
    return spark.createDataFrame([(k, v, None if t is None else dt.datetime(2024, 1, t)) for k, v, t in rows], "k string, v int, at timestamp_ntz")


def _rows(df):
    return sorted(map(str, df.collect()))


def _files(folder):
    return {os.path.join(p, f): os.stat(os.path.join(p, f)).st_mtime_ns for p, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet")}


def test_snapshot_writes_touched_buckets_alone(spark, tmp_dir):
    target, want, rows = f"{tmp_dir}/snap", None, {f"k{i}": (i, 1) for i in range(60)}
    for step in range(4):
        if step:
            rows |= {f"k{step}": (100 + step, 1 + step), f"new{step}": (0, 1), "k40": (step, 1)}  # k40 changes without a later time
            rows.pop(f"k{50 + step}")
        state = _state(spark, [(k, v, t) for k, (v, t) in rows.items()])
        before = _files(f"{target}/open")
        got = S.refresh_snapshot(state, target, "k", "at", buckets=16)
        want = spark.createDataFrame(M.snapshot_scd2(state, want, "k", "at").collect(), got.schema)
        assert _rows(got) == _rows(want)
        if step:
            after = _files(f"{target}/open")
            touched = {f.split("bucket=")[1].split("/")[0] for f in set(before) ^ set(after)}
            assert 1 <= len(touched) <= 2 and all(after[f] == before[f] for f in set(before) & set(after))
    before = _files(f"{target}/open")
    assert _rows(S.refresh_snapshot(state, target, "k", "at")) == _rows(want) and _files(f"{target}/open") == before


def test_snapshot_run_that_was_cut_off(spark, tmp_dir, monkeypatch):
    first, second, third = ([("a", 1, 1), ("b", 1, 1), (None, 1, 1)], [("a", 2, 2), ("b", 1, 1), (None, 2, 3), ("c", 1, None)],
                            [("a", 3, 4), ("b", 2, 5), (None, 2, 3), ("c", 2, 6)])
    S.refresh_snapshot(_state(spark, first), f"{tmp_dir}/whole", "k", "at", 4)
    S.refresh_snapshot(_state(spark, second), f"{tmp_dir}/whole", "k", "at")
    want = _rows(S.refresh_snapshot(_state(spark, third), f"{tmp_dir}/whole", "k", "at"))
    assert len(want) == 8  # a three times, b and null twice, c once (its null time moves nothing)
    for aside in (False, True):  # cut off before or after the new buckets were written aside; those in place are lost
        target = f"{tmp_dir}/cut{aside}"
        S.refresh_snapshot(_state(spark, first), target, "k", "at", 4)
        with monkeypatch.context() as m:
            if aside:
                m.setattr(S, "remove_folder", _raise)
            else:
                m.setattr(S, "_apply", _raise)
            with pytest.raises(RuntimeError):
                S.refresh_snapshot(_state(spark, second), target, "k", "at")
        if aside:
            for bucket in {f.split("bucket=")[1].split("/")[0] for f in _files(f"{target}/open")}:
                if any(r.bucket == int(bucket) for r in spark.read.parquet(f"{target}/aside/version=0").collect()):
                    remove_folder(spark, f"{target}/open/bucket={bucket}")
        assert _rows(S.refresh_snapshot(_state(spark, third), target, "k", "at")) == want


def _raise(*_):
    raise RuntimeError("lost")
