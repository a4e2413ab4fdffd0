"""Daily tables rebuilt by changed days."""

import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL

from plume.operators.warehouse import incremental as I
from plume.operators.warehouse import upstream as U
from plume.plans import warehouse as W
from plume.sources.tables import Tables


def _table(spark, rows):
    return spark.createDataFrame(rows, "day date, k long, v string")


def _totals(inputs):
    return inputs["facts"].groupBy(F.col("day").alias("date_key")).agg(F.sum("k").alias("total"), F.count("v").alias("named"))


def _files(target):
    return {os.path.join(p, f): os.stat(os.path.join(p, f)).st_mtime_ns for p, _, fs in os.walk(target) for f in fs if f.endswith(".parquet")}


def _days(files):
    return {f.split("date_key=")[1][:10] for f in files}


def test_only_changed_days_are_written(spark, tmp_dir):
    target = f"{tmp_dir}/totals"
    day = lambda n: dt.date(2024, 1, n)
    rows = [(day(1 + k % 6), k, None if k % 4 else "x") for k in range(60)]
    refresh = lambda rows, **kw: {tuple(r) for r in I.refresh_days({"facts": (_table(spark, rows), "day")}, _totals, target, **kw)
                                  .select("date_key", "total", "named").collect()}
    full = lambda rows: {tuple(r) for r in _totals({"facts": _table(spark, rows)}).collect()}
    assert refresh(rows) == full(rows)
    first = _files(target)
    assert refresh(rows[::-1]) == full(rows) and _files(target) == first  # the same rows in another order
    changed = [(d, k + 100 if k == 8 else k, v) for d, k, v in rows]
    assert refresh(changed) == full(changed)
    second = _files(target)
    assert _days(set(first) - set(second)) == _days(set(second) - set(first)) == {"2024-01-03"}
    assert all(second[f] == first[f] for f in set(first) & set(second))
    fewer = [r for r in changed if r[0] != day(5)] + [(day(9), 1, "new")]
    assert refresh(fewer) == full(fewer)
    assert _days(set(_files(target)) - set(second)) == {"2024-01-09"}
    swapped = [(d, k, "y" if v == "x" and k == 12 else v) for d, k, v in fewer]
    assert refresh(swapped) == full(swapped)
    assert refresh([]) == set()


def test_fingerprints_tell_nulls_and_repeats(spark):
    of = lambda rows: I.day_fingerprints({"t": (spark.createDataFrame(rows, "day date, a string, b string"), "day")}).collect()[0]["print"]
    d = dt.date(2024, 1, 1)
    prints = [of(rows) for rows in ([(d, "x", None)], [(d, None, "x")], [(d, "x", None)] * 2, [(d, None, None)], [(d, "", None)])]
    assert len(set(prints)) == 5


def test_a_dimension_counts_for_every_day(spark, tmp_dir):
    target = f"{tmp_dir}/totals"
    facts = _table(spark, [(dt.date(2024, 1, n), n, "x") for n in range(1, 4)])
    refresh = lambda names: I.refresh_days({"facts": (facts, "day")}, _totals, target, whole={"names": spark.createDataFrame(names, "n string")}).count()
    assert refresh([("a",)]) == 3
    before = _files(target)
    assert refresh([("a",)]) == 3 and _files(target) == before
    assert refresh([("b",)]) == 3 and not set(before) & set(_files(target))


def test_daily_sales_by_day(spark, tmp_dir):
    t, lines, target = Tables(spark, SF_SMALL), W.order_lines(spark, SF_SMALL), f"{tmp_dir}/sales"
    rows = lambda df: {tuple(r) for r in df.select(*U.DAILY_SALES_COLUMNS).collect()}
    one = W.refresh_daily_sales(t.orders, lines, t.customer, t.nation, t.part, target)
    assert rows(one) == rows(U.daily_sales(t.orders, t.lineitem, t.customer, t.nation, t.part))
    before = _files(target)
    some = t.orders.agg(F.to_date(F.min("o_orderdate"))).collect()[0][0]
    changed = lines.where(f"order_day <> DATE'{some}' OR l_quantity > 10").unionByName(lines.where(f"order_day = DATE'{some}'").limit(1))
    two = W.refresh_daily_sales(t.orders, changed, t.customer, t.nation, t.part, target)
    assert rows(two) == rows(U.daily_sales(t.orders, None, t.customer, t.nation, t.part, lines=changed))
    assert _days(set(_files(target)) ^ set(before)) == {str(some)}
