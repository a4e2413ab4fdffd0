"""Column functions shared by both pipelines.

All of them build JVM-side expressions (no Python UDFs), so they stay inside
whole-stage codegen and Catalyst can push, prune and fold around them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: the spellings pandas.read_csv turns into a missing value
# by default (pandas 2.x documentation, `na_values`).
NA_STRINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Whitespace as Python's str.split()/str.strip() define it (str.isspace),
# derived by that rule rather than listed.  The regex class uses \x{...}
# escapes, which the Java and RE2 engines read alike.
WS_CHARS = "".join(c for c in map(chr, range(0x110000)) if c.isspace())
WS_CLASS = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in WS_CHARS) + "]"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Remove leading/trailing whitespace (``trim`` only removes spaces).

    ``btrim`` with a character set, not an anchored regex: same result, no
    regex engine per row.
    """
    return F.btrim(col(c), F.lit(WS_CHARS))


def null_if_na(c) -> Column:
    """Map the pandas NA spellings to NULL."""
    c = col(c)
    return F.when(c.isin(*NA_STRINGS), F.lit(None).cast("string")).otherwise(c)


def rnd(c, digits: int) -> Column:
    """Round half-up through a fixed-scale decimal, returned as double.

    Distributed double sums differ in the last bits between plans; going
    through ``decimal(38,10)`` makes the rounding identical across engines.
    """
    x = col(c)
    rounded = F.round(x.cast("decimal(38,10)"), digits).cast("double")
    # beyond decimal(38,10) range (|x| >= 1e28) digits are meaningless: keep x
    return F.when(F.abs(x) < F.lit(1e27), rounded).otherwise(x.cast("double"))


def safe_div(num, den) -> Column:
    """``num / NULLIF(den, 0)`` as double; NULL instead of an ANSI error."""
    return F.try_divide(col(num).cast("double"), F.nullif(col(den).cast("double"), F.lit(0.0)))


def pct(part, total) -> Column:
    """``part * 100.0 / total`` as double, NULL when total is 0."""
    return safe_div(col(part) * F.lit(100.0), total)


def count_if(cond: Column) -> Column:
    """COUNT(CASE WHEN cond THEN 1 END): conditional count as long."""
    return F.count(F.when(cond, F.lit(1)))


def word_count_ws(text) -> Column:
    """Words separated by whitespace runs (pandas ``str.split()``), 0 for blank.

    Every whitespace character is first mapped to a plain space
    (``translate``, a character map), then maximal runs of non-spaces are
    counted with a possessive pattern: no array is built, the matcher never
    backtracks, and the ASCII class stays on the regex engine's fast path (a
    class listing the Unicode spaces is several times slower).
    """
    spaced = F.translate(col(text), WS_CHARS, " " * len(WS_CHARS))
    return F.regexp_count(spaced, F.lit("[^ ]++")).cast("long")


def word_count_space(text) -> Column:
    """Parts after splitting on single spaces, empty parts counted.

    That is the number of spaces plus one, computed without building the
    array of parts.
    """
    c = col(text)
    return (F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit(""))) + 1).cast("long")


def epoch_micros(ts: str) -> Column:
    """Microseconds since 1970-01-01 for a TIMESTAMP_NTZ column, time-zone free."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{ts}`)")


def day_number(d) -> Column:
    """Days since 1970-01-01 for a DATE."""
    return F.datediff(col(d), F.lit("1970-01-01").cast("date"))


def long_rows(names, *rows) -> Column:
    """``inline(array(struct...))`` unpivot: each row is a tuple of Columns.

    Every struct gets the same field names (``array`` requires equal types).
    """
    structs = [F.struct(*[c.alias(n) for c, n in zip(r, names)]) for r in rows]
    return F.inline(F.array(*structs))


def with_share_of_total(grouped, count_col: str = "count", out: str = "percentage", digits: int = 2):
    """``round(count * 100 / SUM(count) OVER (), d)`` over an aggregate.

    For groupings by bounded labels (sentiment, rating, length category): the
    total is a window over the few grouped rows, never over data rows.
    """
    from pyspark.sql import Window
    total = F.sum(count_col).over(Window.partitionBy(F.lit(0)))
    return grouped.withColumn(out, rnd(F.col(count_col) * 100.0 / total, digits))


def prefix_before(df, order_cols, weight: str, out: str = "_before", partitions: int | None = None):
    """Sum of ``weight`` over all rows strictly before each row in ``order_cols`` order.

    A distributed prefix sum: rows are range-partitioned on the order
    (balanced by sampling) and written once with the number of their range.
    Both the sum within a range and the totals of all earlier ranges come
    from that one table, so they agree on the ranges whatever plan reads it.
    No step holds more than one range in a task.  Meant for distinct keys
    (ties within one range are ordered arbitrarily) and narrow rows.
    """
    from pyspark.sql import Window

    from ..sources.store import shared
    ranged = df.repartitionByRange(partitions, *order_cols) if partitions else df.repartitionByRange(*order_cols)
    s = shared(ranged.withColumn("_pid", F.spark_partition_id()))
    local_w = Window.partitionBy("_pid").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    s_local = s.withColumn("_local", F.coalesce(F.sum(weight).over(local_w), F.lit(0)))
    tot = s.groupBy("_pid").agg(F.sum(weight).alias("_t"))
    off_w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = tot.select("_pid", F.coalesce(F.sum("_t").over(off_w), F.lit(0)).alias("_off"))
    return (s_local.join(F.broadcast(offsets), "_pid")
            .withColumn(out, F.col("_off") + F.col("_local")).drop("_pid", "_local", "_off"))


def ntz_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal from a date/datetime, independent of any time zone.

    ``lit(datetime)`` builds a zoned timestamp through the session zone; a
    wall-clock text cast to TIMESTAMP_NTZ does not.
    """
    import datetime as _dt
    if isinstance(value, _dt.datetime):
        text = value.replace(tzinfo=None).isoformat(sep=" ")
    elif isinstance(value, _dt.date):
        text = f"{value.isoformat()} 00:00:00"
    else:
        text = str(value)
    return F.lit(text).cast("timestamp_ntz")


def row_number_distributed(df, order_cols, out: str, key: str, columns: list[str]):
    """``row_number() OVER (ORDER BY order_cols)`` without a one-partition window.

    The order must be total (end it with ``key``, which is unique).  Only
    ``columns`` (those of the order) and the key are ranked, by the
    distributed prefix sum; the rank is joined back to the rows by the key.
    """
    narrow = df.select(*dict.fromkeys([*columns, key])).withColumn("_one", F.lit(1))
    ranks = prefix_before(narrow, order_cols, "_one", out="_before").select(
        F.col(key).alias("_key"), (F.col("_before") + 1).cast("int").alias(out))
    return df.join(ranks, df[key].eqNullSafe(ranks["_key"])).drop("_key")


def percent_rank_distributed(df, column: str, out: str):
    """``percent_rank() OVER (ORDER BY column ASC NULLS LAST)``: ties share the smallest rank.

    Rows below a value are counted over the distinct values and joined back.
    """
    values = df.groupBy(column).agg(F.count(F.lit(1)).alias("_c"))
    below = prefix_before(values, [F.col(column).asc_nulls_last()], "_c", out="_below")
    n = df.agg(F.count(F.lit(1)).alias("_n"))
    ranks = below.crossJoin(F.broadcast(n)).select(
        F.col(column).alias("_value"),
        F.when(F.col("_n") > 1, F.col("_below") / (F.col("_n") - 1)).otherwise(0.0).alias(out))
    return df.join(ranks, df[column].eqNullSafe(ranks["_value"])).drop("_value")
