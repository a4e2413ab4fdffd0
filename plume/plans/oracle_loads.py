"""DuckDB oracle SQL for the loads, sinks and stored failures."""

from __future__ import annotations

from ..operators.quality import Test
from .loads import BAD_EVERY, RESULTS_TS, RETENTION_AS_OF, RETENTION_DAYS, STORED_COLUMNS, TABLE_TESTS
from .oracle_quality_feeds import _fail
from .oracle_reviews import SQL as REVIEWS
from .oracle_stats import SQL as STATS
from .oracle_warehouse import SQL as WAREHOUSE

_BAD_ORDER = f"o_orderkey % {BAD_EVERY} = 5"
_BAD_ITEM = f"l_orderkey % {BAD_EVERY} = 5"


def _json(columns: list[str]) -> str:
    return f"CAST(to_json(struct_pack({', '.join(f'{c} := {c}' for c in columns)})) AS VARCHAR)"


def _stored(t: Test) -> str:
    unique = t.test == "unique"
    return (f"SELECT '{t.model}' AS model, '{t.column}' AS column_name, '{t.test}' AS test_name, "
            f"{_json([t.column] if unique else STORED_COLUMNS[t.model])} AS failing, count(*) AS n_records "
            f"FROM {t.model} WHERE {f'{t.column} IS NOT NULL' if unique else _fail(t)} GROUP BY ALL"
            f"{' HAVING count(*) > 1' if unique else ''}")


SQL = {
    "orders_load": f"""
SELECT o_orderkey AS order_id, CASE WHEN NOT {_BAD_ORDER} THEN o_custkey END AS customer_id,
  CASE WHEN NOT {_BAD_ORDER} THEN o_orderstatus END AS order_status,
  CASE WHEN NOT {_BAD_ORDER} THEN o_orderdate END AS order_purchase_timestamp,
  CASE WHEN NOT {_BAD_ORDER} THEN o_totalprice END AS order_total,
  CASE WHEN {_BAD_ORDER} THEN 'type of order_purchase_timestamp' END AS reason
FROM orders""",
    "order_items_load": f"""
SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, CASE WHEN NOT {_BAD_ITEM} THEN l_partkey END AS product_id,
  CASE WHEN NOT {_BAD_ITEM} THEN l_suppkey END AS seller_id, CASE WHEN NOT {_BAD_ITEM} THEN l_extendedprice END AS price,
  CASE WHEN NOT {_BAD_ITEM} THEN l_quantity END AS quantity, CASE WHEN {_BAD_ITEM} THEN 'no price' END AS reason
FROM lineitem""",
    "marketing_load": """
SELECT CAST(l_shipdate AS DATE) AS date_key, 'C' || l_suppkey AS campaign_id,
  CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS impressions, count(*) AS clicks,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS spend
FROM lineitem GROUP BY 1, 2""",
    "retained_raw_reviews": f"SELECT * FROM ({REVIEWS['partitioned_raw_reviews']}) "
                            f"WHERE ingestion_date >= DATE '{RETENTION_AS_OF}' - {RETENTION_DAYS}",
    "saved_results": f"SELECT *, TIMESTAMP '{RESULTS_TS}' AS analysis_timestamp FROM ({STATS['statistical_results']})",
    "stored_failures": "\nUNION ALL ".join(_stored(t) for t in TABLE_TESTS),
    "profile_snapshot_runs": WAREHOUSE["profile_snapshot"],
}
