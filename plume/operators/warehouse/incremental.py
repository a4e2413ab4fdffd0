"""Daily tables rebuilt only where their inputs changed.

Every day of the inputs has a fingerprint: its number of rows and two sums of
row hashes, which neither depend on order nor on how the rows are dealt over
tasks.  A run compares the fingerprints with those of the run before, builds
the days that differ and overwrites their partitions alone.  The fingerprints
are written as a new version after the partitions, so a run that was cut off
is made good by the next.  Days that left the inputs are no longer read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...sources.store import remove_folder, shared, versions


def _print(df: DataFrame) -> Column:
    """An aggregate over rows: their number and two sums of their hashes (nulls are told from values)."""
    cells = [*df.columns]
    hashed = lambda seed: F.sum(F.xxhash64(F.lit(seed), *cells, *[F.isnull(c) for c in cells]).cast("decimal(38,0)")).cast("string")
    return F.concat_ws("|", F.count(F.lit(1)).cast("string"), hashed(1), hashed(2))


def day_fingerprints(inputs: dict[str, tuple[DataFrame, str]], whole: dict[str, DataFrame] | None = None) -> DataFrame:
    """day, print: one row per day that any input has.

    ``inputs``: name to (table, its day column); ``whole``: tables that count
    for every day, such as dimensions.
    """
    parts = [df.groupBy(F.col(day).alias("day")).agg(_print(df).alias("print")).withColumn("name", F.lit(name))
             for name, (df, day) in inputs.items()]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    days = every.groupBy("day").agg(F.concat_ws(";", F.sort_array(F.collect_list(F.concat("name", F.lit("="), "print")))).alias("print"))  # a row per input
    for name, df in sorted((whole or {}).items()):
        one = df.agg(F.concat(F.lit(f";{name}="), _print(df)).alias("_whole"))
        days = days.crossJoin(F.broadcast(one)).select("day", F.concat("print", "_whole").alias("print"))
    return days


def refresh_days(inputs: dict[str, tuple[DataFrame, str]], build: Callable[[dict[str, DataFrame]], DataFrame], target: str,
                 day: str = "date_key", whole: dict[str, DataFrame] | None = None) -> DataFrame:
    """Bring the table at ``target``, partitioned by ``day``, up to date and return it.

    ``build`` gets the inputs' rows of the changed days and returns the table's
    rows of these days.  A day's row of the fingerprints is all that is kept
    besides, so both sides of the comparison have one row per day.
    """
    spark = next(iter(inputs.values()))[0].sparkSession
    state = f"{target}-days"
    now = shared(day_fingerprints(inputs, whole))
    known = versions(spark, state)
    changed = now
    if known:
        before = spark.read.parquet(f"{state}/version={known[-1]}").select(F.col("day").alias("_day"), F.col("print").alias("_print"))
        changed = now.join(before, F.col("day").eqNullSafe(F.col("_day")), "left").where(~F.col("print").eqNullSafe(F.col("_print")))
    changed = shared(changed.select(F.col("day").alias("_changed")))
    of_days = {name: df.join(F.broadcast(changed), df[column].eqNullSafe(changed["_changed"]), "left_semi")
               for name, (df, column) in inputs.items()}
    # a day's rows come together, so a day has few files; AQE splits a day that is too large for a task
    build(of_days).hint("rebalance", day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(target)
    now.write.mode("overwrite").parquet(f"{state}/version={(known or [-1])[-1] + 1}")
    for v in known[:-1]:
        remove_folder(spark, f"{state}/version={v}")
    return current_days(spark.read.parquet(target), now, day)


def current_days(table: DataFrame, days: DataFrame, day: str) -> DataFrame:
    """The rows of ``table`` whose day the inputs still have."""
    kept = days.select(F.col("day").alias("_kept"))
    return table.join(F.broadcast(kept), table[day].eqNullSafe(kept["_kept"]), "left_semi")
