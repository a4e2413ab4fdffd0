"""Sessionization and per-user running counts at any density of events.

Both need an order within each user.  A window partitioned by user alone sends
every event of a user to one task (Spark's batch ``session_window`` plans
exactly that: Exchange by user -> Sort -> MergingSessions), so a user holding a
third of all events would stall the stage; buckets of fixed width only move the
limit to a user with that many events in one bucket.

Here the work is a segmented scan: events are cut into ranges of about equal
size in the order (user, time, tie-break), wherever those cuts fall.  A window
per (range, user) does what can be done inside a range.  What crosses a cut is
a state of one row per user and range (latest event, latest session start,
number of flagged rows so far); the running state over a user's ranges is a
window over these rows, at most one a range, and is joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ...functions.columns import epoch_micros
from ...sources.store import shared

MICROS_PER_MINUTE = 60_000_000
MICROS_PER_DAY = 86_400_000_000
PIECES = 4


def ranged(events: DataFrame, user: str, ts: str, tiebreak: str, ranges: int | None = None) -> DataFrame:
    """Events with ``_t`` (micros) and ``_b``, the number of their range in the order (user, time, tie-break).

    Spark samples the order to cut it into as many parts as there are shuffle
    partitions (or ``ranges``), which are written once, sorted, so that every
    reader agrees on them.  Each is cut again into ``PIECES`` of equal size: the
    pieces are dealt over tasks by hash, and with several a task they even out.
    """
    e = events.withColumn("_t", epoch_micros(ts))
    order = (user, "_t", tiebreak)
    cut = e.repartitionByRange(ranges, *order) if ranges else e.repartitionByRange(*order)
    kept = shared(cut.sortWithinPartitions(*order).withColumn("_seq", F.monotonically_increasing_id()))
    part, row = F.shiftright("_seq", 33), F.col("_seq").bitwiseAND((1 << 33) - 1)  # the id's two halves
    sizes = kept.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))  # one row per range
    piece = F.col("_part") * PIECES + F.floor(row * PIECES / F.col("_rows"))
    return kept.withColumn("_part", part).join(F.broadcast(sizes), "_part") \
        .withColumn("_b", piece.cast("long")).drop("_seq", "_part", "_rows")


def _earlier(user: str):
    """The ranges of the same user before this one."""
    return Window.partitionBy(user).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)


def sessionize(events: DataFrame, gap_minutes: int, user: str = "user_id", ts: str = "ts",
               tiebreak: str = "event_id", ranges: int | None = None) -> DataFrame:
    """Add ``session_start_us`` (epoch micros of the session's first event) to every event.

    A new session starts when the previous event of the same user (order
    ``ts``, ``tiebreak``) is more than ``gap_minutes`` earlier, or there is
    none; an event exactly one gap later stays in the session, like
    ``session_window``.  The first event of a user in a range takes its
    predecessor from the state of the earlier ranges, and events before the
    first start inside their range take the latest session start of the
    earlier ranges.  An event without a user is a session of its own.
    """
    e = _starts(events, gap_minutes, user, ts, tiebreak, ranges)
    carry = (e.groupBy(user, "_b").agg(F.max("_sid").alias("_last"))
              .select(user, "_b", F.max("_last").over(_earlier(user)).alias("_carry")))
    return (e.join(carry, [user, "_b"], "left")
             .withColumn("session_start_us", F.coalesce(F.col("_sid"), F.col("_carry")))
             .drop("_t", "_b", "_sid", "_carry"))


def _starts(events: DataFrame, gap_minutes: int, user: str, ts: str, tiebreak: str,
            ranges: int | None = None) -> DataFrame:
    """Events with ``_b`` (range), ``_t`` (micros) and ``_sid`` (latest session
    start at or before the event inside its range; NULL for the events of a
    session continuing from an earlier range)."""
    e = ranged(events, user, ts, tiebreak, ranges)
    w = Window.partitionBy(user, "_b").orderBy("_t", tiebreak)
    before = (e.groupBy(user, "_b").agg(F.max("_t").alias("_bmax"))
               .select(user, "_b", F.max("_bmax").over(_earlier(user)).alias("_pmax")))
    e = e.withColumn("_prev", F.lag("_t").over(w)).join(before, [user, "_b"], "left")
    prev = F.coalesce(F.col("_prev"), F.col("_pmax"))
    start = prev.isNull() | ((F.col("_t") - prev) > F.lit(gap_minutes * MICROS_PER_MINUTE)) | F.col(user).isNull()
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return e.withColumn("_sid", F.max(F.when(start, F.col("_t"))).over(run)).drop("_prev", "_pmax")


def sessions(events: DataFrame, gap_minutes: int, user: str = "user_id", ts: str = "ts",
             ranges: int | None = None) -> DataFrame:
    """One row per session: start/end, duration, events, views, purchase, value.

    The events are windowed once (per user and range) and aggregated into
    fragments, one per (user, range, session inside it), with mergeable
    measures.  Only the first fragment of a user in a range can lack a start:
    it continues the latest session started in an earlier range, which the
    state of one row per user and range gives.  A second aggregation merges
    the fragments.  Both aggregations combine map-side, so even one huge
    session ships one partial row per task.
    """
    needed = dict.fromkeys((user, ts, "event_id", "event_type", "value"))
    e = _starts(events.select(*needed), gap_minutes, user, ts, "event_id", ranges)
    et = F.col("event_type")
    frag = e.groupBy(user, "_b", "_sid").agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.min("_t").alias("_tmin"),
        F.max("_t").alias("_tmax"), F.count(F.lit(1)).alias("_n"),
        F.count(F.when(et == "view", 1)).alias("_views"), F.count(F.when(et == "click", 1)).alias("_clicks"),
        F.count(F.when(et == "purchase", 1)).alias("_purchases"),
        F.sum(F.when(et == "purchase", F.col("value"))).alias("_value"))
    frag = shared(frag)
    carry = (frag.groupBy(user, "_b").agg(F.max("_sid").alias("_last"))
                 .select(user, "_b", F.max("_last").over(_earlier(user)).alias("_carry")))
    frag = frag.join(carry, [user, "_b"], "left").withColumn("session_start_us", F.coalesce("_sid", "_carry"))
    return frag.groupBy(user, "session_start_us").agg(
        F.min("_first").alias("session_start"), F.max("_last").alias("session_end"),
        F.sum("_n").alias("n_events"), F.sum("_views").alias("page_views"), F.sum("_clicks").alias("clicks"),
        (F.sum("_purchases") > 0).alias("converted"),
        F.round(F.coalesce(F.sum("_value"), F.lit(0.0)).cast("decimal(38,10)"), 6).cast("double")
        .alias("session_value"),
        ((F.max("_tmax") - F.min("_tmin")) / F.lit(float(MICROS_PER_MINUTE))).alias("duration_minutes"))


def running_count(df: DataFrame, flag: str, user: str = "user_id", ts: str = "ts",
                  tiebreak: str = "event_id", ranges: int | None = None, out: str = "prior_count") -> DataFrame:
    """Number of earlier rows of the same user with ``flag`` true (strictly before; NULL without a user).

    Prefix sum split by ranges: a windowed count inside each (user, range) plus
    the flagged rows of the user's earlier ranges.
    """
    e = ranged(df, user, ts, tiebreak, ranges).withColumn("_f", F.col(flag).cast("int"))
    w = (Window.partitionBy(user, "_b").orderBy("_t", tiebreak)
         .rowsBetween(Window.unboundedPreceding, -1))
    e = e.withColumn("_local", F.coalesce(F.sum("_f").over(w), F.lit(0)))
    off = (e.groupBy(user, "_b").agg(F.sum("_f").alias("_tot"))
            .select(user, "_b", F.coalesce(F.sum("_tot").over(_earlier(user)), F.lit(0)).alias("_off")))
    return (e.join(off, [user, "_b"], "left")
             .withColumn(out, (F.col("_off") + F.col("_local")).cast("long"))
             .drop("_t", "_b", "_f", "_local", "_off"))
