"""A user with a third of all events: the bucketed windows spread it over tasks."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from plume.operators.warehouse import sessions as S


def _skewed_events(spark):
    base = dt.datetime(2024, 1, 1)
    hot = [(i, base + dt.timedelta(minutes=29 * i), 0, "view", 1.0, None) for i in range(3000)]
    cold = [(10_000 + u * 100 + j, base + dt.timedelta(hours=7 * j + u), u, "view", 1.0, None)
            for u in range(1, 101) for j in range(60)]
    return spark.createDataFrame(hot + cold, "event_id long, ts timestamp_ntz, user_id long, event_type string, "
                                             "value double, props string")


def _largest_task_share(df, used: str) -> float:
    """Share of rows in the largest partition of the stage that computes ``used``
    (the column must be consumed, or the optimizer prunes the window away)."""
    sizes = [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p"))
             .agg(F.count(F.lit(1)).alias("n"), F.max(used).alias("_used")).collect()]
    return max(sizes) / sum(sizes)


def test_hot_user_is_spread_over_tasks(spark):
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ev = _skewed_events(spark)
        # one window per user: the hot user's 3000 of 9000 rows land in one task
        per_user = ev.withColumn("_prev", F.lag("ts").over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
        assert _largest_task_share(per_user, "_prev") >= 1 / 3
        # (user, hour) windows: no task gets anywhere near a third
        bucketed = S._starts(ev, 720, "user_id", "ts", "event_id", 60)
        assert _largest_task_share(bucketed, "_sid") < 0.25
        counted = S.running_count(ev.withColumn("flag", F.col("event_id") % 7 == 0), "flag")
        assert _largest_task_share(counted, "prior_count") < 0.25
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
