"""Bulk loads, sinks and stored failures as round-trip queries: the given tables
are written as files the way the original receives them, then loaded back."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators import stats, transform
from ..operators.quality import Test
from ..operators.warehouse import upstream as U
from ..operators.warehouse.snapshot import refresh_snapshot
from ..sources import io, loads
from ..sources.store import shared, table_root
from ..sources.tables import Tables
from . import reviews, warehouse as W

#: One order in this many is written with a time in another format, one line item without a price.
BAD_EVERY = 97
RETENTION_AS_OF = dt.date(2024, 1, 25)
RETENTION_DAYS = 10
RESULTS_TS = dt.datetime(2024, 2, 1)


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{table_root(spark)}/{name}/{uuid.uuid4().hex}"


def _is_bad(column: str) -> Column:
    return F.col(column) % BAD_EVERY == 5


def _deliver(df: DataFrame, folder: str, second: list[str]) -> None:
    """Write rows as CSV in two folders; the second has its columns in another order, named in capitals."""
    half = F.pmod(F.xxhash64(*df.columns), F.lit(2))
    io.write_csv(df.where(half == 0), f"{folder}/a")
    io.write_csv(df.where(half == 1).select(*[F.col(c).alias(c.upper()) for c in second]), f"{folder}/b")


def orders_load(spark: SparkSession, d: str) -> DataFrame:
    """Every order, loaded from files of two layouts, or the reason of its rejection."""
    folder = _scratch(spark, "orders_load")
    when = F.date_format("o_orderdate", loads.TIMESTAMP_FORMAT), F.date_format("o_orderdate", "dd.MM.yyyy")
    orders = Tables(spark, d).orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), F.col("o_orderstatus").alias("order_status"),
        F.when(_is_bad("o_orderkey"), when[1]).otherwise(when[0]).alias("order_purchase_timestamp"),
        F.col("o_totalprice").alias("order_total"), F.col("o_orderpriority").alias("priority"))
    _deliver(orders, folder, ["priority", "order_total", "order_purchase_timestamp", "order_status", "customer_id", "order_id"])
    load = loads.load_orders(spark, f"{folder}/*", f"{folder}-table")
    return _with_rejects(load, ["order_id"])


def order_items_load(spark: SparkSession, d: str) -> DataFrame:
    """Every line item, loaded from files of two layouts, or the reason of its rejection."""
    folder = _scratch(spark, "order_items_load")
    items = Tables(spark, d).lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("order_item_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"), F.when(~_is_bad("l_orderkey"), F.col("l_extendedprice")).alias("price"),
        F.col("l_quantity").alias("quantity"))
    _deliver(items, folder, ["quantity", "price", "order_item_id", "product_id", "seller_id", "order_id"])
    load = loads.load_order_items(spark, f"{folder}/*", f"{folder}-table")
    return _with_rejects(load, ["order_id", "order_item_id"])


def marketing_load(spark: SparkSession, d: str) -> DataFrame:
    """A10: campaign rows by a wildcard over several files; a supplier's line items of a day stand for a campaign's."""
    folder = _scratch(spark, "marketing_load")
    rows = Tables(spark, d).lineitem.groupBy(F.to_date("l_shipdate").alias("date_key"), F.concat(F.lit("C"), "l_suppkey").alias("campaign_id")).agg(
        F.sum(F.col("l_quantity").cast("long")).alias("impressions"), F.count(F.lit(1)).alias("clicks"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("spend"))
    _deliver(rows, folder, ["spend", "clicks", "campaign_id", "date_key", "impressions"])
    return loads.load_marketing(spark, f"{folder}/*/*.csv", f"{folder}-table").rows


def _with_rejects(load: loads.Load, ids: list[str]) -> DataFrame:
    field = lambda c: F.coalesce(F.get_json_object("raw", f"$.{c}"), F.get_json_object("raw", f"$.{c.upper()}"))
    rejects = load.rejects.select("reason", *[field(c).cast(load.rows.schema[c].dataType).alias(c) for c in ids])
    return load.rows.withColumn("reason", F.lit(None).cast("string")).unionByName(rejects, allowMissingColumns=True)


def retained_raw_reviews(spark: SparkSession, d: str) -> DataFrame:
    """The days of the partitioned raw table that are left after partition expiry."""
    path = _scratch(spark, "retained_raw_reviews")
    io.write_raw_reviews(reviews.raw_reviews(spark, d), path)
    io.expire_partitions(spark, path, RETENTION_AS_OF, RETENTION_DAYS)
    return (io.read_raw_reviews(spark, path).groupBy("ingestion_date", "sentiment")
              .agg(F.count(F.lit(1)).alias("reviews"), F.sum("review_length").alias("total_length")))


def saved_results(spark: SparkSession, d: str) -> DataFrame:
    """The statistical results as written with their fixed schema."""
    results = stats.statistical_results(transform.ttest_data(reviews.analyzed(spark, d)), reviews.correlation(spark, d))
    return io.save_statistical_results(results, _scratch(spark, "saved_results"), RESULTS_TS)


#: Tests over the given tables of which most fail somewhere, and the columns stored of a failing row.
TABLE_TESTS = [
    Test("documents", "lang", "not_null"), Test("documents", "text", "unique"), Test("documents", "doc_id", "unique"),
    Test("documents", "n_chars", "accepted_range", (), 40, 10_000), Test("documents", "lang", "accepted_values", ("en", "de")),
    Test("orders", "o_custkey", "unique"), Test("orders", "o_orderkey", "unique"), Test("orders", "o_orderkey", "not_null"),
    Test("orders", "o_orderstatus", "accepted_values", ("F", "O")),
    Test("lineitem", "l_quantity", "accepted_range", (), 2, 49), Test("lineitem", "l_partkey", "unique"),
    Test("events", "event_type", "accepted_values", ("click", "view", "purchase")), Test("events", "user_id", "unique"),
]
STORED_COLUMNS = {"documents": ["doc_id", "lang", "source", "n_chars"], "orders": ["o_orderkey", "o_custkey", "o_orderstatus"],
                  "lineitem": ["l_orderkey", "l_linenumber"], "events": ["event_id", "event_type"]}


def stored_failures(spark: SparkSession, d: str) -> DataFrame:
    """Failing rows of tests over four tables, stored in one folder per test and read back."""
    path, t = _scratch(spark, "stored_failures"), Tables(spark, d)
    models = {name: getattr(t, name) for name in STORED_COLUMNS}
    io.store_failures(Q.stored_failures(models, TABLE_TESTS, STORED_COLUMNS), path)
    return spark.read.parquet(path).select("model", "column_name", "test_name", "failing", "n_records")


def profile_snapshot_runs(spark: SparkSession, d: str) -> DataFrame:
    """W9 as a kept table: a run on the state of 2024-01-20, one on the current state, and one that changes nothing."""
    early = Tables(spark, d).events.where(F.col("ts") < F.lit("2024-01-21").cast("timestamp_ntz"))

    def state(profiles: DataFrame) -> DataFrame:
        return profiles.select("user_id", "user_lifecycle_stage", "total_sessions",
                               F.col("last_login_date").cast("timestamp_ntz").alias("updated_timestamp"))
    target, now = _scratch(spark, "profile_snapshot_runs"), shared(state(W.user_profiles(spark, d)))
    refresh_snapshot(state(U.user_profiles(early, W.SNAPSHOT_AS_OF, W.P.session_gap_minutes)), target, "user_id", "updated_timestamp", 16)
    refresh_snapshot(now, target, "user_id", "updated_timestamp")
    return refresh_snapshot(now, target, "user_id", "updated_timestamp")


QUERIES = {
    "orders_load": orders_load,
    "order_items_load": order_items_load,
    "marketing_load": marketing_load,
    "retained_raw_reviews": retained_raw_reviews,
    "saved_results": saved_results,
    "stored_failures": stored_failures,
    "profile_snapshot_runs": profile_snapshot_runs,
}
