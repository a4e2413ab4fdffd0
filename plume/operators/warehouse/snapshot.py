"""Type-2 snapshots kept as a table whose untouched partitions are never rewritten.

A snapshot folder holds two tables.  ``open`` has the open version of every
key, partitioned by a hash of the key; a run overwrites the buckets with
changes alone.  ``changes`` has one folder a run with the versions that the run
closed and those that it opened; the closed ones of all runs are the history,
which no later run touches.

A run writes its changes first and applies them to ``open`` afterwards.
Applying twice gives the same rows, so a run that was cut off in between is
made good by the next one before it looks for changes of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ...sources.store import folder_exists, mark_done, remove_folder, versions

_TO = "dbt_valid_to"
_FROM = "dbt_valid_from"


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _open(spark: SparkSession, target: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(f"{target}/open")


def _mark(spark: SparkSession, folder: str, number: int) -> None:
    mark_done(spark, f"{folder}/version={number}")


def _apply(spark: SparkSession, target: str, version: int, key: str) -> None:
    """Bring ``open`` up to the changes of a run: only buckets that the run opened a version in are written."""
    folder = f"{target}/changes/version={version}"
    if not folder_exists(spark, f"{folder}/opened=true"):  # the run changed nothing
        return _mark(spark, f"{target}/applied", version)
    opened = spark.read.parquet(f"{folder}/opened=true")
    # the new buckets are whole in a folder of their own before the old ones go
    aside = f"{target}/aside/version={version}"
    if not folder_exists(spark, f"{aside}/_SUCCESS"):
        touched = F.broadcast(opened.select(F.col("bucket").alias("_touched")).distinct())  # at most a row per bucket
        kept = _open(spark, target, opened).join(touched, F.col("bucket") == F.col("_touched"), "left_semi")
        moved = opened.select(F.col(key).alias("_moved"), F.col("bucket").alias("_in"))
        kept = kept.join(moved, kept[key].eqNullSafe(moved["_moved"]) & (kept["bucket"] == moved["_in"]), "left_anti")
        kept.unionByName(opened).write.mode("overwrite").parquet(aside)
    (spark.read.schema(opened.schema).parquet(aside).hint("rebalance", "bucket")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{target}/open"))
    remove_folder(spark, aside)
    _mark(spark, f"{target}/applied", version)


def refresh_snapshot(current: DataFrame, target: str, key: str, updated_at: str, buckets: int = 64) -> DataFrame:
    """Bring the snapshot at ``target`` up to ``current`` and return all its versions.

    Same versions as ``models.snapshot_scd2``: a key whose ``updated_at`` moved
    on closes its open version at the new time and opens a new one, new keys
    open a version, all else stays.  ``key`` is unique in ``current`` (a null
    is a key like any other); keys that left ``current`` stay open, and a null
    ``updated_at`` moves nothing.  ``buckets`` is fixed when the snapshot is
    begun; later runs go on with the number it was begun with.
    """
    spark = current.sparkSession
    done = versions(spark, f"{target}/applied")
    for version in versions(spark, f"{target}/changes"):
        if version not in done:
            _apply(spark, target, version, key)
    begun = versions(spark, f"{target}/begun")
    if begun:
        buckets = begun[-1]
    fresh = current.select(*current.columns, F.col(updated_at).alias(_FROM),
                           F.lit(None).cast(current.schema[updated_at].dataType).alias(_TO), _bucket(key, buckets).alias("bucket"))
    if not begun:  # the first run, or one that was cut off before its end
        fresh.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "static") \
             .partitionBy("bucket").parquet(f"{target}/open")
        _mark(spark, f"{target}/begun", buckets)
        return snapshot_rows(spark, target, fresh)
    now = fresh.select(*[F.col(c).alias(f"_n_{c}") for c in fresh.columns])
    # one pass over the open versions gives both the closed and the opened ones
    both = _open(spark, target, fresh).join(
        now, F.col(key).eqNullSafe(F.col(f"_n_{key}")) & (F.col("bucket") == F.col("_n_bucket")), "right")
    is_new, moved = F.col("bucket").isNull(), F.coalesce(F.col(f"_n_{updated_at}") > F.col(updated_at), F.lit(False))
    version = lambda opened, cells: F.struct(F.lit(opened).alias("opened"), *cells)
    after = version(True, [F.col(f"_n_{c}").alias(c) for c in fresh.columns])
    before = version(False, [(F.col(f"_n_{updated_at}") if c == _TO else F.col(c)).alias(c) for c in fresh.columns])
    changes = both.where(is_new | moved).select(F.inline(F.when(is_new, F.array(after)).otherwise(F.array(before, after))))
    number = (versions(spark, f"{target}/changes") or [-1])[-1] + 1
    folder = f"{target}/changes/version={number}"
    changes.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("opened").parquet(folder)
    _apply(spark, target, number, key)
    return snapshot_rows(spark, target, fresh)


def snapshot_rows(spark: SparkSession, target: str, like: DataFrame) -> DataFrame:
    """All versions: the open ones and the closed ones of every run."""
    rows = _open(spark, target, like)
    closed = [f"{target}/changes/version={v}/opened=false" for v in versions(spark, f"{target}/changes")]
    closed = [path for path in closed if folder_exists(spark, path)]
    if closed:
        rows = rows.unionByName(spark.read.schema(like.schema).parquet(*closed))
    return rows.drop("bucket")
