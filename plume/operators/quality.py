"""Declarative data-quality tests and operational checks (Q1-Q10).

A test suite is data: (model, column, test and its parameters).  The runner checks every
not_null / accepted_values / accepted_range test of a model and its unique
key in one pass over the model (however many tests), and returns one row per
test.
Failing rows are available per test for storing (``store_failures``).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import count_if, rnd
from ..sources.store import shared


@dataclass(frozen=True)
class Test:
    model: str
    column: str
    test: str                       # not_null | unique | accepted_values | accepted_range
    values: tuple = ()
    min_value: float | None = None
    max_value: float | None = None
    inclusive: bool = True

    @property
    def name(self) -> str:
        return self.test


# ---- single tests: failing rows / keys (Q1-Q4) ------------------------------

def _fail_condition(t: Test) -> Column:
    c = F.col(t.column)
    if t.test == "not_null":
        return c.isNull()
    if t.test == "accepted_values":
        return c.isNotNull() & ~c.isin(*t.values)
    if t.test == "accepted_range":
        cond = F.lit(False)
        if t.min_value is not None:
            cond = cond | ((c < t.min_value) if t.inclusive else (c <= t.min_value))
        if t.max_value is not None:
            cond = cond | ((c > t.max_value) if t.inclusive else (c >= t.max_value))
        return c.isNotNull() & cond
    raise ValueError(f"not a row-level test: {t.test}")


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Q1: rows where the column is NULL."""
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Q2: values occurring more than once (NULLs ignored), with their count."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1"))


def accepted_values(df: DataFrame, column: str, values) -> DataFrame:
    """Q3: rows whose value is not accepted (NULLs pass)."""
    return df.where(_fail_condition(Test("", column, "accepted_values", tuple(values))))


def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None, inclusive=True) -> DataFrame:
    """Q4: rows outside the range (NULLs pass)."""
    return df.where(_fail_condition(Test("", column, "accepted_range", (), min_value, max_value, inclusive)))


def failing_rows(df: DataFrame, t: Test) -> DataFrame:
    return unique(df, t.column) if t.test == "unique" else df.where(_fail_condition(t))


# ---- suite runner (Q5) --------------------------------------------------------

ROW_COUNT = "row_count"


def run_suite(models: dict[str, DataFrame], tests: list[Test], with_counts: bool = False) -> DataFrame:
    """Q5: one row per test: model, column_name, test_name, failures, status.

    One pass per model: rows are grouped by the model's (first) ``unique``
    column, each group carrying its size and its failure count for every
    row-level test; a second, tiny aggregation sums those and counts the
    duplicated keys.  Further ``unique`` tests of the same model run as their
    own grouped counts.  ``with_counts`` adds one ``row_count`` row per model
    (status INFO) from the same pass.
    """
    parts: list[DataFrame] = []
    names = list(dict.fromkeys(t.model for t in tests))
    if with_counts:
        names += [m for m in models if m not in names]
    for model in names:
        df = models[model]
        row_tests = [t for t in tests if t.model == model and t.test != "unique"]
        uniq = [t for t in tests if t.model == model and t.test == "unique"]
        folded = uniq[0] if uniq else None
        flags = [F.sum(F.when(_fail_condition(t), 1).otherwise(0)).alias(f"f{i}") for i, t in enumerate(row_tests)]
        if folded is not None:
            k = F.col(folded.column)
            per_key = df.groupBy(folded.column).agg(F.count(F.lit(1)).alias("_c"), *flags)
            agg = per_key.agg(*[F.coalesce(F.sum(f"f{i}"), F.lit(0)).cast("long").alias(f"f{i}")
                                for i in range(len(row_tests))],
                              F.coalesce(F.sum("_c"), F.lit(0)).cast("long").alias("_rows"),
                              F.count(F.when(k.isNotNull() & (F.col("_c") > 1), 1)).alias("_dups"))
        else:
            agg = df.agg(*[count_if(_fail_condition(t)).alias(f"f{i}") for i, t in enumerate(row_tests)],
                         F.count(F.lit(1)).alias("_rows"), F.lit(0).cast("long").alias("_dups"))
        structs = [F.struct(F.lit(t.column).alias("column_name"), F.lit(t.test).alias("test_name"),
                            F.col(f"f{i}").alias("failures")) for i, t in enumerate(row_tests)]
        if folded is not None:
            structs.append(F.struct(F.lit(folded.column).alias("column_name"), F.lit("unique").alias("test_name"),
                                    F.col("_dups").alias("failures")))
        if with_counts:
            structs.append(F.struct(F.lit("*").alias("column_name"), F.lit(ROW_COUNT).alias("test_name"),
                                    F.col("_rows").alias("failures")))
        if structs:
            parts.append(agg.select(F.lit(model).alias("model"), F.inline(F.array(*structs))))
        for t in uniq[1:]:
            dup = unique(df, t.column).agg(F.count(F.lit(1)).alias("failures"))
            parts.append(dup.select(F.lit(model).alias("model"), F.lit(t.column).alias("column_name"),
                                    F.lit("unique").alias("test_name"), "failures"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", F.when(F.col("test_name") == ROW_COUNT, "INFO")
                          .when(F.col("failures") == 0, "PASS").otherwise("FAIL"))


def stored_failures(models: dict[str, DataFrame], tests: list[Test], keep: dict[str, list[str]] | None = None) -> DataFrame:
    """Model, column_name, test_name, failing, n_records for all tests, each model read once.

    A row gives one record per row-level test that it fails (``failing`` is the
    row as JSON, or its ``keep`` columns) and one per ``unique`` test (the
    value as JSON; nulls are not tested).  Records are counted by their test
    and content, so map tasks combine those of a hot value, and what a
    ``unique`` test holds only once goes.  Equal failing rows are one record
    with their number.
    """
    parts = []
    for model in dict.fromkeys(t.model for t in tests):
        df = models[model]
        as_json = lambda columns: F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false"})
        whole = as_json((keep or {}).get(model) or df.columns)
        records = [F.when(F.col(t.column).isNotNull() if t.test == "unique" else _fail_condition(t), F.struct(
            F.lit(t.column).alias("column_name"), F.lit(t.test).alias("test_name"),
            (as_json([t.column]) if t.test == "unique" else whole).alias("failing"))) for t in tests if t.model == model]
        parts.append(df.select(F.lit(model).alias("model"), F.inline(F.array_compact(F.array(*records)))))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    counted = every.groupBy("model", "column_name", "test_name", "failing").agg(F.count(F.lit(1)).alias("n_records"))
    return counted.where((F.col("test_name") != "unique") | (F.col("n_records") > 1))


# ---- the project's 37 declared tests -------------------------------------------

def _nn(m, c):
    return Test(m, c, "not_null")


def _uq(m, c):
    return Test(m, c, "unique")


def _rng(m, c, lo=None, hi=None):
    return Test(m, c, "accepted_range", (), lo, hi, True)


def _vals(m, c, *v):
    return Test(m, c, "accepted_values", tuple(v))


# fixed values: the declared tests of the three sources and three staging models
DECLARED_TESTS: list[Test] = [
    _nn("ext_redshift_daily_sales", "date_key"), _uq("ext_redshift_daily_sales", "date_key"),
    _nn("ext_redshift_daily_sales", "total_revenue"), _rng("ext_redshift_daily_sales", "total_revenue", 0),
    _nn("ext_redshift_daily_sales", "unique_customers"), _rng("ext_redshift_daily_sales", "unique_customers", 0),
    _nn("ext_bigquery_marketing_daily", "date_key"), _uq("ext_bigquery_marketing_daily", "date_key"),
    _nn("ext_bigquery_marketing_daily", "total_spend"), _rng("ext_bigquery_marketing_daily", "total_spend", 0),
    _rng("ext_bigquery_marketing_daily", "roas", 0),
    _nn("daily_product_engagement", "date_key"), _uq("daily_product_engagement", "date_key"),
    _nn("daily_product_engagement", "active_users"), _rng("daily_product_engagement", "active_users", 0),
    _nn("stg_redshift_sales", "date_key"), _uq("stg_redshift_sales", "date_key"),
    _nn("stg_redshift_sales", "total_revenue"), _rng("stg_redshift_sales", "total_revenue", 0),
    _nn("stg_redshift_sales", "has_revenue_data"), _vals("stg_redshift_sales", "has_revenue_data", True, False),
    _rng("stg_redshift_sales", "delivery_rate_pct", 0, 100),
    _nn("stg_bigquery_marketing", "date_key"), _uq("stg_bigquery_marketing", "date_key"),
    _nn("stg_bigquery_marketing", "total_spend"), _rng("stg_bigquery_marketing", "total_spend", 0),
    _nn("stg_bigquery_marketing", "roas_tier"),
    _vals("stg_bigquery_marketing", "roas_tier", "Excellent", "Good", "Break-even", "Poor"),
    _rng("stg_bigquery_marketing", "calculated_ctr", 0, 100),
    _nn("stg_snowflake_engagement", "date_key"), _uq("stg_snowflake_engagement", "date_key"),
    _nn("stg_snowflake_engagement", "active_users"), _rng("stg_snowflake_engagement", "active_users", 0),
    _nn("stg_snowflake_engagement", "engagement_quality"),
    _vals("stg_snowflake_engagement", "engagement_quality", "High", "Medium", "Low", "Very Low"),
    _nn("stg_snowflake_engagement", "engagement_score"), _rng("stg_snowflake_engagement", "engagement_score", 0, 100),
]


# ---- operational checks (Q6, Q7) -------------------------------------------------

def freshness(df: DataFrame, day: dt.date, name: str, date_col: str = "date_key") -> DataFrame:
    """Q6: PASS when the table has rows for ``day`` (the original used yesterday)."""
    return df.where(F.col(date_col) == F.lit(day)).agg(F.count(F.lit(1)).alias("rows_for_day")).select(
        F.lit(name).alias("table_name"), F.lit(day).alias("check_date"), "rows_for_day",
        F.when(F.col("rows_for_day") > 0, "PASS").otherwise("FAIL").alias("quality_check"))


def revenue_consistency(sales: DataFrame, kpis: DataFrame, day: dt.date, tolerance: float = 100.0) -> DataFrame:
    """|source revenue - KPI revenue| for one day; NULL variance fails.

    Reads ``total_revenue`` from the KPI table (the check's column name in the
    original does not exist there).  Two one-row aggregates, cross-joined.
    """
    a = sales.where(F.col("date_key") == F.lit(day)).agg(F.sum("total_revenue").alias("source_revenue"))
    b = (kpis.where((F.col("date_key") == F.lit(day)) & F.col("sales_data_available"))
             .agg(F.sum("total_revenue").alias("kpi_revenue")))
    v = F.abs(F.col("source_revenue") - F.col("kpi_revenue"))
    return a.crossJoin(b).select(
        F.lit("Revenue Consistency").alias("check_name"), F.lit(day).alias("check_date"),
        rnd("source_revenue", 4).alias("source_revenue"), rnd("kpi_revenue", 4).alias("kpi_revenue"),
        rnd(v, 4).alias("variance"),
        F.when(v < tolerance, "PASS").otherwise("FAIL").alias("validation_result"))


# ---- summaries (Q9, Q10) ------------------------------------------------------------

def run_summary(models: dict[str, DataFrame], tests: list[Test]) -> DataFrame:
    """Q9: row count per model plus test pass/fail counts and a quality score.

    Counts and row-level tests of a model come from one aggregation; the
    per-model rows are then folded over the small suite result.
    """
    suite = shared(run_suite(models, tests, with_counts=True))  # tiny; read twice
    counts = suite.where(F.col("test_name") == ROW_COUNT).select("model", F.col("failures").alias("row_count"))
    t = (suite.where(F.col("test_name") != ROW_COUNT).groupBy("model")
              .agg(F.count(F.lit(1)).alias("tests"), count_if(F.col("status") == "PASS").alias("tests_passed"),
                   F.sum("failures").alias("failing_records")))
    j = counts.join(t, "model", "left")
    return j.select("model", "row_count", F.coalesce("tests", F.lit(0)).alias("tests"),
                    F.coalesce("tests_passed", F.lit(0)).alias("tests_passed"),
                    F.coalesce("failing_records", F.lit(0)).alias("failing_records"),
                    rnd(F.when(F.col("tests") > 0, F.col("tests_passed") * 100.0 / F.col("tests")), 2)
                    .alias("quality_score"),
                    (F.coalesce(F.col("tests_passed"), F.lit(0)) < F.coalesce(F.col("tests"), F.lit(0)))
                    .alias("alert"))


def quality_indicators(analyzed: DataFrame, as_of: dt.date, min_n: int = 30) -> DataFrame:
    """Q10: dashboard data-quality indicators in one aggregation.

    Adequacy is Green / Yellow / Red by the smaller t-test group (>= 30,
    >= 15); freshness is days since the newest ingestion; completeness is the
    share of rows with every analysis field present.
    """
    s = F.col("sentiment")
    fields = ["review_text", "sentiment", "rating", "app_name", "review_length", "word_count"]
    complete = F.lit(True)
    for f_ in fields:
        complete = complete & F.col(f_).isNotNull()
    m = analyzed.agg(
        F.count(F.lit(1)).alias("n"), count_if(s == "Positive").alias("pos"),
        count_if(s == "Negative").alias("neg"), count_if(complete).alias("complete"),
        count_if(F.col("is_length_outlier")).alias("outliers"),
        F.max("ingestion_timestamp").alias("latest"))
    smaller = F.least("pos", "neg")
    return m.select(
        F.when(smaller >= min_n, "Green").when(smaller >= 15, "Yellow").otherwise("Red").alias("sample_size_adequacy"),
        F.to_date("latest").alias("last_updated"),
        F.datediff(F.lit(as_of), F.to_date("latest")).alias("days_since_update"),
        rnd(F.col("complete") * 100.0 / F.nullif(F.col("n"), F.lit(0)), 4).alias("pct_complete"),
        rnd(F.col("outliers") * 100.0 / F.nullif(F.col("n"), F.lit(0)), 4).alias("pct_outliers"),
        (smaller < min_n).alias("low_sample_warning"))
