"""All registered queries and their oracle statements."""

from __future__ import annotations

from . import (loads, oracle_loads, oracle_quality_feeds, oracle_reviews, oracle_stats, oracle_warehouse, quality_feeds,
               reviews, stats_queries, streaming_queries, warehouse)


def registered_queries() -> dict:
    out = {}
    out.update(reviews.QUERIES)
    out.update(stats_queries.QUERIES)
    out.update(warehouse.QUERIES)
    out.update(quality_feeds.QUERIES)
    out.update(loads.QUERIES)
    out.update(streaming_queries.QUERIES)
    return out


def oracle_statements() -> dict:
    out = {}
    out.update(oracle_reviews.SQL)
    out.update(oracle_stats.SQL)
    out.update(oracle_warehouse.SQL)
    out.update(oracle_quality_feeds.SQL)
    out.update(oracle_loads.SQL)
    return {k: v for k, v in out.items() if k in registered_queries()}


def flagship(spark, sf_dir):
    return warehouse.QUERIES["business_kpis"](spark, sf_dir)
