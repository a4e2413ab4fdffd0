"""Declarative tests: NULL handling per test type and the one-pass suite runner."""

import datetime as dt

from plume.operators import quality as Q


def test_suite_counts_failures(spark):
    df = spark.createDataFrame([(1, 5.0, "Good"), (1, -1.0, "Bad"), (None, None, None), (2, 101.0, "Good")],
                               "k long, x double, tier string")
    tests = [Q.Test("m", "k", "not_null"), Q.Test("m", "k", "unique"),
             Q.Test("m", "x", "accepted_range", (), 0, 100), Q.Test("m", "tier", "accepted_values", ("Good",))]
    got = {(r.column_name, r.test_name): (r.failures, r.status) for r in Q.run_suite({"m": df}, tests).collect()}
    assert got == {("k", "not_null"): (1, "FAIL"), ("k", "unique"): (1, "FAIL"),
                   ("x", "accepted_range"): (2, "FAIL"), ("tier", "accepted_values"): (1, "FAIL")}


def test_failing_rows_and_declared_count(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,)], "k long")
    assert Q.unique(df, "k").count() == 1          # NULLs are not duplicates
    assert Q.not_null(df, "k").count() == 2
    assert len(Q.DECLARED_TESTS) == 37
    assert sum(t.test == "not_null" for t in Q.DECLARED_TESTS) == 17
    assert sum(t.test == "unique" for t in Q.DECLARED_TESTS) == 6
    assert sum(t.test == "accepted_range" for t in Q.DECLARED_TESTS) == 11
    assert sum(t.test == "accepted_values" for t in Q.DECLARED_TESTS) == 3


def test_revenue_consistency_null_is_fail(spark):
    day = dt.date(2023, 5, 1)
    sales = spark.createDataFrame([(day, 100.0)], "date_key date, total_revenue double")
    kpis = spark.createDataFrame([(day, 150.0, False)], "date_key date, total_revenue double, "
                                                       "sales_data_available boolean")
    assert Q.revenue_consistency(sales, kpis, day).first().validation_result == "FAIL"
    kpis2 = spark.createDataFrame([(day, 150.0, True)], "date_key date, total_revenue double, "
                                                       "sales_data_available boolean")
    r = Q.revenue_consistency(sales, kpis2, day).first()
    assert (r.variance, r.validation_result) == (50.0, "PASS")
