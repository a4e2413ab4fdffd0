"""Upstream daily sources and dimensions (U1-U8), built from driver tables.

Only the output columns of these tables are known (their SQL is not part of
the original); the formulas here are ours.  Design rules:

* join the big fact tables once, on their keys (sort-merge, AQE may switch
  to broadcast when a side is small at runtime), and pre-aggregate to a
  small grain (day x key) before joining dimension tables;
* pick per-day "top" members from the aggregated grain with a window
  partitioned by day, whose width is bounded by the member domain;
* never count several DISTINCT columns over fact rows in one aggregate.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ...functions.columns import day_number, epoch_micros, ntz_lit, rnd, safe_div
from ...functions.bins import roas_tier
from ...sources.store import shared
from .sessions import MICROS_PER_DAY, running_count, sessions

# ---- our fixed choices for the synthetic recipes ---------------------------
CAMPAIGNS = 40
CAMPAIGN_TYPES = ("Search", "Display", "Social", "Video")
ENGAGEMENT_SHIFT_DAYS = 9496          # 2024-01-01 -> 1998-01-01
USER_SHIFT_MODULUS = 45
USER_SEGMENTS = ("Consumer", "SMB", "Enterprise")
SUBSCRIPTION_TIERS = ("Premium", "Pro", "Free", "Trial")
NEW_USER_CUTOFF = "2024-01-20"
HISTORY_START_US = 1_704_067_200_000_000   # 2024-01-01 00:00:00 in epoch micros
HISTORY_DAYS = 30
NEW_USER_SPAN_DAYS = 11
FEATURE_CATEGORIES = 5


def _ts_range(col: str, start: dt.date | None, end: dt.date | None) -> Column:
    """Timestamp-range predicate that Parquet can push down (a cast to date cannot)."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(col) >= ntz_lit(dt.datetime.combine(start, dt.time())))
    if end is not None:
        nxt = dt.datetime.combine(end + dt.timedelta(days=1), dt.time())
        cond = cond & (F.col(col) < ntz_lit(nxt))
    return cond


def _top_per_day(grain: DataFrame, member: str, measure: str, out: str) -> DataFrame:
    """Member with the largest measure per day (ties: smallest member)."""
    w = Window.partitionBy("date_key").orderBy(F.col(measure).desc(), F.col(member).asc())
    return (grain.withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
                 .select("date_key", F.col(member).alias(out), F.col(measure).alias(f"{out}_measure")))


def _revenue() -> Column:
    return F.col("l_extendedprice") * (1 - F.col("l_discount"))


# ---- U1, U2: one join of line items and orders --------------------------------

def order_lines(lineitem: DataFrame, orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Line items with what both daily sources need of their order and its customer.

    Customers are joined to orders first, the smaller side.  Written once, each
    source's grains are plain aggregations over a few of its columns, and
    neither source joins orders again.  Orders of unknown customers keep their
    lines, with ``known_customer`` false.

    The smaller side of each join is hashed per partition: sorting the larger
    one would spill all line items.  Revenue is computed after the join, since
    the discount's few values take less room in the shuffle.
    """
    o = orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_day"))
    c = customer.select("c_custkey", "c_mktsegment", "c_nationkey")
    sides = o.join(c.hint("shuffle_hash"), o["o_custkey"] == c["c_custkey"], "left")
    li = lineitem.select("l_orderkey", "l_partkey", F.to_date("l_shipdate").alias("ship_day"), "l_discount",
                         "l_extendedprice", "l_quantity")
    return li.join(sides.hint("shuffle_hash"), li["l_orderkey"] == sides["o_orderkey"]).select(
        "order_day", "ship_day", "l_partkey", "c_nationkey", "c_mktsegment", F.col("c_custkey").isNotNull().alias("known_customer"),
        _revenue().alias("rev"), "l_extendedprice", "l_quantity")


def _day_range(column: str, start: dt.date | None, end: dt.date | None) -> Column:
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(column) >= F.lit(start))
    if end is not None:
        cond = cond & (F.col(column) <= F.lit(end))
    return cond


# ---- U1 ---------------------------------------------------------------------

def daily_sales(orders: DataFrame, lineitem: DataFrame, customer: DataFrame, nation: DataFrame,
                part: DataFrame, start: dt.date | None = None, end: dt.date | None = None,
                lines: DataFrame | None = None) -> DataFrame:
    """One row per order date.

    Orders, customers and deliveries count orders placed that day; revenue
    and items come from their line items (``lines``: the written
    ``order_lines``, made here if not given).  The top state is chosen from a
    (day, nation) pre-aggregate.  The top category's lines go to their part
    directly: a (day, part) pre-aggregate has nearly as many rows as the lines,
    so it would spill and move them a second time.  The parts are hashed, the
    lines not sorted, and what leaves the join is a (day, type) grain.
    """
    o = (orders.where(_ts_range("o_orderdate", start, end))
               .select("o_orderkey", "o_custkey", "o_orderstatus",
                       F.to_date("o_orderdate").alias("date_key")))
    if lines is None:
        lines = shared(order_lines(lineitem, orders.where(_ts_range("o_orderdate", start, end)), customer))
    lines = lines.where(_day_range("order_day", start, end)).withColumn("date_key", F.col("order_day"))
    day_o = o.groupBy("date_key").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.countDistinct("o_custkey").alias("unique_customers"),
        F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("delivered_orders"))
    # days x nations, read for the day's totals and for its top state
    by_nation = shared(lines.groupBy("date_key", "c_nationkey", "known_customer")
                       .agg(F.sum("rev").alias("rev"), F.sum("l_quantity").alias("items")))
    day_li = by_nation.groupBy("date_key").agg(F.sum("rev").alias("revenue"), F.sum("items").alias("items"))
    cat = (lines.select("date_key", "l_partkey", "rev")
                .join(part.select(F.col("p_partkey").alias("l_partkey"), "p_type").hint("shuffle_hash"), "l_partkey")
                .groupBy("date_key", "p_type").agg(F.sum("rev").alias("rev")))
    state = (by_nation.where("known_customer").join(nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey")
                      .groupBy("date_key", "n_name").agg(F.sum("rev").alias("rev")))
    top_cat = _top_per_day(cat, "p_type", "rev", "top_product_category")
    top_state = _top_per_day(state, "n_name", "rev", "top_state")
    d = (day_o.join(day_li, "date_key", "left").join(top_cat, "date_key", "left")
              .join(top_state, "date_key", "left"))
    # Ratios are taken from the rounded totals: revenue is exact at 4 decimals,
    # so every engine and summation order yields the same inputs.
    rev = rnd(F.coalesce(F.col("revenue"), F.lit(0.0)), 4)
    items = rnd(F.coalesce(F.col("items"), F.lit(0.0)), 4)
    return d.select(
        "date_key", "total_orders", rnd(rev, 4).alias("total_revenue"), rnd(items, 4).alias("total_items_sold"),
        "unique_customers", rnd(safe_div(rev, "total_orders"), 6).alias("avg_order_value"),
        rnd(safe_div(items, "total_orders"), 6).alias("avg_items_per_order"),
        "top_product_category", "top_state", "delivered_orders",
        rnd(safe_div(F.col("delivered_orders") * 100.0, "total_orders"), 6).alias("delivery_performance_score"))


DAILY_SALES_COLUMNS = [
    "date_key", "total_orders", "total_revenue", "total_items_sold", "unique_customers", "avg_order_value", "avg_items_per_order",
    "top_product_category", "top_state", "delivered_orders", "delivery_performance_score"]


# ---- U2 ---------------------------------------------------------------------

def daily_marketing(lineitem: DataFrame, orders: DataFrame, customer: DataFrame,
                    start: dt.date | None = None, end: dt.date | None = None,
                    lines: DataFrame | None = None) -> DataFrame:
    """One row per ship date; campaign = part key mod 40, channel = segment (``lines`` as in U1)."""
    if lines is None:
        lines = order_lines(lineitem.where(_ts_range("l_shipdate", start, end)), orders, customer)
    date_key = F.col("ship_day")
    grain = (lines.where(_day_range("ship_day", start, end) & F.col("known_customer")).select(
                date_key.alias("date_key"), (F.col("l_partkey") % CAMPAIGNS).alias("campaign"),
                F.col("c_mktsegment").alias("channel"), "rev",
                (F.lit(0.1) * F.col("l_extendedprice") * (1 + day_number(date_key) % 10)).alias("spend"),
                "l_quantity")
             .groupBy("date_key", "campaign", "channel").agg(
                F.sum("spend").alias("spend"), F.sum("rev").alias("rev"),
                F.sum("l_quantity").alias("clicks"), F.count(F.lit(1)).alias("conversions")))
    grain = shared(grain)  # days x campaigns x channels; three outputs derive from it
    day = grain.groupBy("date_key").agg(
        F.sum("spend").alias("spend"), F.sum("rev").alias("rev"), F.sum("clicks").alias("clicks"),
        F.sum("conversions").alias("conversions"),
        F.countDistinct("campaign").alias("unique_campaigns"),
        F.countDistinct("channel").alias("active_channels"))
    ch = grain.groupBy("date_key", "channel").agg(F.sum("rev").alias("rev"))
    cp = (grain.groupBy("date_key", "campaign").agg(F.sum("rev").alias("rev"))
               .withColumn("campaign_name", F.concat(F.lit("Campaign "), F.col("campaign").cast("string"))))
    top_ch = _top_per_day(ch, "channel", "rev", "top_performing_channel")
    top_cp = _top_per_day(cp.select("date_key", "campaign_name", "rev"), "campaign_name", "rev",
                          "top_performing_campaign")
    d = day.join(top_ch, "date_key", "left").join(top_cp, "date_key", "left")
    impressions = F.col("clicks") * 100.0
    return d.select(
        "date_key", rnd("spend", 4).alias("total_spend"), rnd(impressions, 4).alias("total_impressions"),
        rnd("clicks", 4).alias("total_clicks"), F.col("conversions").alias("total_conversions"),
        "unique_campaigns", "active_channels",
        rnd(safe_div(F.col("clicks") * 100.0, impressions), 6).alias("avg_ctr"),
        rnd(safe_div(F.col("conversions") * 100.0, "clicks"), 6).alias("avg_conversion_rate"),
        rnd(safe_div("spend", "clicks"), 6).alias("avg_cpc"),
        rnd(safe_div("spend", "conversions"), 6).alias("avg_cpa"),
        "top_performing_channel", "top_performing_campaign",
        rnd(safe_div(F.col("top_performing_channel_measure") * 100.0, "rev"), 6).alias("channel_performance_score"),
        rnd(safe_div("rev", "spend"), 6).alias("roas"))


# ---- U3 ---------------------------------------------------------------------

def event_sessions(events: DataFrame, gap_minutes: int) -> DataFrame:
    return sessions(events, gap_minutes)


def daily_engagement(events: DataFrame, gap_minutes: int, shift_days: int = ENGAGEMENT_SHIFT_DAYS) -> DataFrame:
    """Daily product engagement from sessions (session start day, shifted)."""
    return daily_engagement_from_sessions(sessions(events, gap_minutes), shift_days)


def daily_engagement_from_sessions(sess: DataFrame, shift_days: int = ENGAGEMENT_SHIFT_DAYS) -> DataFrame:
    s = sess.withColumn("date_key", F.date_sub(F.to_date("session_start"), shift_days))
    n = F.count(F.lit(1))
    g = s.groupBy("date_key").agg(
        F.countDistinct("user_id").alias("active_users"), n.alias("total_sessions"),
        F.sum("duration_minutes").alias("minutes"), F.sum("page_views").alias("total_page_views"),
        F.count(F.when(F.col("n_events") == 1, 1)).alias("bounce_sessions"),
        F.count(F.when(F.col("converted"), 1)).alias("conversion_sessions"),
        F.sum("session_value").alias("value"))
    return g.select(
        "date_key", "active_users", "total_sessions", rnd("minutes", 4).alias("total_session_minutes"),
        rnd(safe_div("minutes", "total_sessions"), 6).alias("avg_session_duration"),
        "total_page_views", rnd(safe_div("total_page_views", "total_sessions"), 6).alias("avg_page_views_per_session"),
        "bounce_sessions", "conversion_sessions", rnd("value", 4).alias("total_session_value"),
        rnd(safe_div(F.col("bounce_sessions") * 100.0, "total_sessions"), 6).alias("bounce_rate"),
        rnd(safe_div(F.col("conversion_sessions") * 100.0, "total_sessions"), 6).alias("conversion_rate"))


# ---- U4 ---------------------------------------------------------------------

def campaign_performance(lineitem: DataFrame, params) -> DataFrame:
    """U4: one row per campaign (part key mod 40)."""
    c = F.col("l_partkey") % CAMPAIGNS
    g = (lineitem.select(c.alias("campaign_id"), _revenue().alias("rev"),
                         (F.lit(0.1) * F.col("l_extendedprice") * (1 + c % 10)).alias("spend"),
                         "l_quantity", F.to_date("l_shipdate").alias("d"))
                 .groupBy("campaign_id").agg(
                    F.sum("spend").alias("spend"), F.sum("rev").alias("rev"),
                    F.sum("l_quantity").alias("clicks"), F.count(F.lit(1)).alias("conversions"),
                    F.min("d").alias("first_day"), F.max("d").alias("last_day")))
    roas = safe_div("rev", "spend")
    types = F.element_at(F.array(*[F.lit(t) for t in CAMPAIGN_TYPES]),
                         (F.pmod(F.col("campaign_id"), F.lit(len(CAMPAIGN_TYPES))) + 1).cast("int"))
    return g.select(
        "campaign_id", F.concat(F.lit("Campaign "), F.col("campaign_id").cast("string")).alias("campaign_name"),
        types.alias("campaign_type"), rnd("spend", 4).alias("total_spend"),
        rnd(F.col("clicks") * 100.0, 4).alias("total_impressions"), rnd("clicks", 4).alias("total_clicks"),
        F.col("conversions").alias("total_conversions"), rnd("rev", 4).alias("attributed_revenue"),
        (F.datediff("last_day", "first_day") + 1).alias("campaign_duration_days"),
        rnd(safe_div(F.col("clicks") * 100.0, F.col("clicks") * 100.0), 6).alias("overall_ctr"),
        rnd(safe_div(F.col("conversions") * 100.0, "clicks"), 6).alias("overall_conversion_rate"),
        rnd(safe_div("spend", "clicks"), 6).alias("overall_cpc"),
        rnd(safe_div("spend", "conversions"), 6).alias("overall_cpa"),
        rnd(roas, 6).alias("roas"), roas_tier(roas, params).alias("performance_tier"),
        rnd(F.least(F.lit(100.0), roas * 20.0), 2).alias("efficiency_score"))


# ---- U5 ---------------------------------------------------------------------

#: Share of a conversion that a channel gets, from its touches k of n and whether it has the first or the last touch.
ATTRIBUTION_MODELS = {
    "linear": lambda k, n, first, last: k / n,
    "first_touch": lambda k, n, first, last: first.cast("double"),
    "last_touch": lambda k, n, first, last: last.cast("double"),
}


def channel_attribution(events: DataFrame, model: str = "linear") -> DataFrame:
    """Multi-touch attribution of purchases to event-type channels.

    Each purchase is a conversion; its touches are the user's other events
    since the previous purchase (order ts, event_id).  The conversion epoch
    of an event is the number of earlier purchases of the user, computed as
    a bucketed prefix count (no per-user global window).  Touches after a
    user's last purchase belong to no conversion and drop out of the inner
    join.  ``model`` gives each channel its share of the conversion and of its
    revenue: k/n of the touches, or all to the first or the last touch.
    """
    if model not in ATTRIBUTION_MODELS:
        raise ValueError(f"attribution model {model!r}: one of {sorted(ATTRIBUTION_MODELS)}")
    e = events.select("event_id", "ts", "user_id", "event_type", "value") \
              .withColumn("is_purchase", F.col("event_type") == "purchase")
    # One pass reduces events to a row per (user, conversion, channel): count,
    # exact sum of timestamps, first and last touch.  An epoch has one purchase
    # at most, so that row is the conversion itself.
    reduced = shared(
        running_count(e, "is_purchase", out="epoch")
        .groupBy("user_id", "epoch", F.col("event_type").alias("channel"))
        .agg(F.count(F.lit(1)).alias("k"),
             F.sum(epoch_micros("ts").cast("decimal(38,0)")).alias("sum_us"),
             F.min(F.struct("ts", "event_id")).alias("_cfirst"),
             F.max(F.struct("ts", "event_id")).alias("_clast"),
             F.max(F.when(F.col("is_purchase"), F.col("value"))).alias("conv_value")))
    conv = reduced.where("channel = 'purchase'").select(
        "user_id", "epoch", F.col("sum_us").cast("long").alias("conv_us"), "conv_value")
    by_channel = reduced.where("channel <> 'purchase' OR channel IS NULL").drop("conv_value")
    per_conv = by_channel.groupBy("user_id", "epoch").agg(
        F.sum("k").alias("n_touch"), F.min("_cfirst").alias("_first"), F.max("_clast").alias("_last"))
    j = by_channel.join(per_conv, ["user_id", "epoch"]).join(conv, ["user_id", "epoch"])
    has_first = (F.col("_cfirst") == F.col("_first")).cast("int")
    has_last = (F.col("_clast") == F.col("_last")).cast("int")
    both = (F.col("_first") == F.col("_last")).cast("int") * has_first  # a single touch is first and last
    span_us = F.col("k").cast("decimal(38,0)") * F.col("conv_us").cast("decimal(38,0)") - F.col("sum_us")
    share = ATTRIBUTION_MODELS[model](F.col("k"), F.col("n_touch"), has_first, has_last)
    worth = F.col("conv_value") * F.col("k") / F.col("n_touch") if model == "linear" else F.col("conv_value") * share
    g = j.groupBy("channel").agg(
        F.sum(share).alias("conv"),
        F.sum(worth).alias("rev"),
        F.sum(has_first).cast("long").alias("first_touch_conversions"),
        F.sum(has_last).cast("long").alias("last_touch_conversions"),
        F.sum(F.col("k") - has_first - has_last + both).cast("long").alias("assisted_conversions"),
        (F.sum(span_us).cast("double") / F.lit(float(MICROS_PER_DAY)) / F.sum("k")).alias("days"),
        F.sum("k").alias("touches"))
    total = g.agg(F.sum("conv").alias("_all"))
    return g.crossJoin(F.broadcast(total)).select(
        "channel", F.lit(model).alias("attribution_model"),
        rnd("conv", 6).alias("total_attributed_conversions"), rnd("rev", 4).alias("total_attributed_revenue"),
        "first_touch_conversions", "last_touch_conversions", "assisted_conversions",
        rnd("days", 6).alias("avg_time_to_conversion_days"),
        rnd(safe_div(F.col("conv") * 100.0, "_all"), 6).alias("channel_contribution_score"),
        F.col("touches").cast("double").alias("attribution_weight_total"))


# ---- U6-U8 -------------------------------------------------------------------

def shifted_events(events: DataFrame) -> DataFrame:
    """User-history recipe (every event kept): users with user_id mod 10 = 0
    have their month of history compressed into its last 11 days (so some
    users are new), then each user is shifted back by user_id mod 45 days."""
    e = events.withColumn("_d", epoch_micros("ts") - F.lit(HISTORY_START_US))
    squeezed_us = F.expr(f"(_d * {NEW_USER_SPAN_DAYS}) div {HISTORY_DAYS}")
    squeezed = ntz_lit(NEW_USER_CUTOFF) + F.make_dt_interval(
        secs=(squeezed_us / F.lit(1_000_000)).cast("decimal(18,6)"))
    ts = F.when(F.col("user_id") % 10 == 0, squeezed).otherwise(F.col("ts"))
    shift = F.expr(f"make_dt_interval(CAST(user_id % {USER_SHIFT_MODULUS} AS INT), 0, 0, 0)")
    return e.withColumn("ts", ts - shift).drop("_d")


def raw_window(lo: dt.datetime, hi: dt.datetime) -> tuple[dt.datetime, dt.datetime]:
    """Bounds of the raw times of all events that ``shifted_events`` moves into [lo, hi).

    A user's history is moved by less than ``USER_SHIFT_MODULUS`` days, that of
    some users after it was compressed.
    """
    shift = dt.timedelta(days=USER_SHIFT_MODULUS)
    lo, hi = lo - shift, hi + shift
    start = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=HISTORY_START_US)
    cutoff = dt.datetime.fromisoformat(NEW_USER_CUTOFF)
    stretched = [start + (t - cutoff) * HISTORY_DAYS / NEW_USER_SPAN_DAYS for t in (lo, hi)]
    second = dt.timedelta(seconds=1)  # the compression rounds
    return min(lo, stretched[0]) - second, max(hi, stretched[1]) + second


def user_sessions(events: DataFrame, gap_minutes: int) -> DataFrame:
    """Sessions of the shifted user history (input of U6 and U7)."""
    return sessions(shifted_events(events), gap_minutes)


def user_profiles(events: DataFrame, as_of: dt.date, gap_minutes: int) -> DataFrame:
    """Lifetime profile per user from the shifted history."""
    return user_profiles_from_sessions(user_sessions(events, gap_minutes), as_of)


def user_profiles_from_sessions(user_sess: DataFrame, as_of: dt.date) -> DataFrame:
    """U6 from the user sessions: every measure is a sum or extreme over sessions."""
    j = (user_sess.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_sessions"), F.sum("duration_minutes").alias("minutes"),
        F.sum("page_views").alias("total_page_views"), F.sum("clicks").alias("total_feature_interactions"),
        F.to_date(F.min("session_start")).alias("signup_date"),
        F.to_date(F.max("session_end")).alias("last_login_date")))
    asof = F.lit(as_of).cast("date")
    recency = F.datediff(asof, "last_login_date")
    tenure = F.datediff(asof, "signup_date")
    sess = F.coalesce(F.col("total_sessions"), F.lit(0))
    score = F.least(F.lit(100.0), 10 * F.log1p(sess.cast("double")) + 5 * F.log1p(F.col("total_page_views").cast("double"))
                    + 5 * F.log1p(F.col("total_feature_interactions").cast("double")))
    seg = F.element_at(F.array(*[F.lit(s_) for s_ in USER_SEGMENTS]),
                       (F.pmod(F.col("user_id"), F.lit(len(USER_SEGMENTS))) + 1).cast("int"))
    tier = F.element_at(F.array(*[F.lit(t) for t in SUBSCRIPTION_TIERS]),
                        (F.pmod(F.col("user_id"), F.lit(len(SUBSCRIPTION_TIERS))) + 1).cast("int"))
    stage = (F.when(recency > 30, "Churned").when(recency > 14, "At Risk")
             .when(tenure <= 20, "New").otherwise("Active"))
    return j.select(
        "user_id", F.col("user_id").alias("customer_id"), seg.alias("user_segment"),
        tier.alias("subscription_tier"), stage.alias("user_lifecycle_stage"),
        rnd(score, 2).alias("engagement_score"), sess.cast("long").alias("total_sessions"),
        rnd(F.coalesce(F.col("minutes"), F.lit(0.0)), 4).alias("total_session_duration_minutes"),
        "total_page_views", "total_feature_interactions", "last_login_date",
        recency.alias("days_since_last_login"), "signup_date")


def _feature_key() -> Column:
    return F.get_json_object("props", "$.k").try_cast("long")


def user_engagement_metrics(events: DataFrame, as_of: dt.date, gap_minutes: int, days: int = 30) -> DataFrame:
    """Last-``days`` activity per user (sessions starting in the window)."""
    return user_engagement_metrics_from(user_sessions(events, gap_minutes), events, as_of, days)


def user_engagement_metrics_from(user_sess: DataFrame, events: DataFrame, as_of: dt.date,
                                 days: int = 30) -> DataFrame:
    """U7 from the user sessions plus the distinct features clicked in the window.

    The shift of a user's history moves no event by more than a known time, so
    the window bounds the raw ``ts`` as well, which reaches the scan.
    """
    lo = dt.datetime.combine(as_of - dt.timedelta(days=days - 1), dt.time())
    hi = dt.datetime.combine(as_of + dt.timedelta(days=1), dt.time())
    raw_lo, raw_hi = raw_window(lo, hi)
    ev = shifted_events(events.where((F.col("ts") >= ntz_lit(raw_lo)) & (F.col("ts") < ntz_lit(raw_hi))))
    s = (user_sess
         .where((F.col("session_start") >= ntz_lit(lo))
                & (F.col("session_start") < ntz_lit(hi)))
         .groupBy("user_id").agg(F.count(F.lit(1)).alias("recent_sessions"),
                                 rnd(F.sum("duration_minutes"), 4).alias("recent_session_minutes"),
                                 F.max("session_start").alias("last_session_timestamp")))
    f = (ev.where((F.col("event_type") == "click") & (F.col("ts") >= ntz_lit(lo))
                  & (F.col("ts") < ntz_lit(hi)))
           .groupBy("user_id").agg(F.countDistinct(_feature_key()).alias("features_used")))
    return s.join(f, "user_id", "full").select(
        "user_id", F.coalesce("recent_sessions", F.lit(0)).alias("recent_sessions"),
        F.coalesce("recent_session_minutes", F.lit(0.0)).alias("recent_session_minutes"),
        F.coalesce("features_used", F.lit(0)).alias("features_used"), "last_session_timestamp")


def feature_engagement_summary(events: DataFrame) -> DataFrame:
    """U8: interactions and distinct users per feature."""
    k = _feature_key()
    g = (events.where(k.isNotNull()).select(k.alias("k"), "user_id")
               .groupBy("k").agg(F.count(F.lit(1)).alias("total_interactions"),
                                 F.countDistinct("user_id").alias("unique_users")))
    return g.select(
        F.concat(F.lit("k"), F.col("k").cast("string")).alias("feature_name"),
        F.concat(F.lit("category_"), (F.col("k") % FEATURE_CATEGORIES).cast("string")).alias("feature_category"),
        "total_interactions", "unique_users",
        rnd(safe_div("total_interactions", "unique_users"), 6).alias("interactions_per_user"))
