"""Skew-resistant sessionization and running counts against brute force."""

import datetime as dt
import random
from collections import Counter

from pyspark.sql import functions as F

from plume.operators.warehouse import sessions as S
from plume.operators.warehouse import upstream as U

BASE = dt.datetime(2024, 1, 1)


def _events(spark, rows):
    return spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, "
                                       "value double, props string")


def _brute_sessions(rows, gap_min):
    by_user = {}
    for r in sorted(rows, key=lambda r: (r[2], r[1], r[0])):
        by_user.setdefault(r[2], []).append(r)
    out = set()
    for u, evs in by_user.items():
        start, prev, n = None, None, 0
        for e in evs:
            if prev is None or (e[1] - prev).total_seconds() > gap_min * 60:
                if start is not None:
                    out.add((u, start, n))
                start, n = e[1], 0
            prev, n = e[1], n + 1
        out.add((u, start, n))
    return out


def _random_rows(seed, users=5, n=400, hot_user_share=0.5):
    random.seed(seed)
    rows = []
    for i in range(n):
        u = 0 if random.random() < hot_user_share else random.randint(1, users)
        ts = BASE + dt.timedelta(minutes=random.choice([0, 5, 700, 720, 721, 1440, 3000]) * random.random() * 20)
        ts = ts.replace(microsecond=0)
        rows.append((i, ts, u, random.choice(["view", "click", "purchase"]), float(i % 7), '{"k": 1}'))
    return rows


def test_sessions_match_brute_force_with_hot_user(spark):
    for seed in (1, 2, 3):
        rows = _random_rows(seed)
        got = {(r.user_id, r.session_start, r.n_events)
               for r in S.sessions(_events(spark, rows), 720).collect()}
        assert got == _brute_sessions(rows, 720)


def test_sessions_with_any_number_of_ranges(spark):
    rows = _random_rows(4, n=300)
    for ranges in (1, 3, 40, 200):
        got = {(r.user_id, r.session_start, r.n_events)
               for r in S.sessions(_events(spark, rows), 720, ranges=ranges).collect()}
        assert got == _brute_sessions(rows, 720)


def test_per_event_session_ids_agree_with_sessions(spark):
    rows = _random_rows(6, n=250)
    ev = _events(spark, rows)
    per_event = S.sessionize(ev, 720, ranges=25).groupBy("user_id", "session_start_us").count()
    got = {(r.user_id, r["count"]) for r in per_event.collect()}
    want = {(u, n) for u, _, n in _brute_sessions(rows, 720)}
    assert got == want


def test_exact_gap_stays_in_session(spark):
    rows = [(1, BASE, 1, "view", 0.0, None), (2, BASE + dt.timedelta(minutes=720), 1, "view", 0.0, None),
            (3, BASE + dt.timedelta(minutes=1441), 1, "view", 0.0, None)]
    got = sorted((r.session_start, r.n_events) for r in S.sessions(_events(spark, rows), 720).collect())
    assert got == [(BASE, 2), (BASE + dt.timedelta(minutes=1441), 1)]


def test_long_session_spanning_many_buckets(spark):
    rows = [(i, BASE + dt.timedelta(minutes=600 * i), 7, "view", 0.0, None) for i in range(12)]
    got = S.sessions(_events(spark, rows), 720).collect()
    assert len(got) == 1 and got[0].n_events == 12 and got[0].duration_minutes == 600 * 11


def test_running_count_matches_brute_force(spark):
    rows = _random_rows(5)
    df = _events(spark, rows).withColumn("flag", F.col("event_type") == "purchase")
    got = {r.event_id: r.prior_count for r in S.running_count(df, "flag").collect()}
    want = {}
    for u in {r[2] for r in rows}:
        c = 0
        for r in sorted((r for r in rows if r[2] == u), key=lambda r: (r[1], r[0])):
            want[r[0]] = c
            c += r[3] == "purchase"
    assert got == want


def test_attribution_weights_sum_to_conversions(spark):
    rows = [(1, BASE, 1, "view", 0.0, None), (2, BASE + dt.timedelta(hours=1), 1, "click", 0.0, None),
            (3, BASE + dt.timedelta(hours=2), 1, "purchase", 30.0, None),
            (4, BASE + dt.timedelta(hours=3), 1, "view", 0.0, None),      # after last purchase: dropped
            (5, BASE + dt.timedelta(hours=4), 2, "signup", 0.0, None),
            (6, BASE + dt.timedelta(hours=5), 2, "purchase", 10.0, None)]
    out = {r.channel: r for r in U.channel_attribution(_events(spark, rows)).collect()}
    assert set(out) == {"view", "click", "signup"}
    assert sum(r.total_attributed_conversions for r in out.values()) == 2.0
    assert out["view"].total_attributed_revenue == 15.0 and out["signup"].total_attributed_revenue == 10.0
    assert out["view"].first_touch_conversions == 1 and out["click"].last_touch_conversions == 1
    assert out["signup"].first_touch_conversions == 1 and out["signup"].last_touch_conversions == 1
    assert abs(out["view"].avg_time_to_conversion_days - 2 / 24) < 1e-6


def test_ranges_of_a_dense_user(spark):
    """A user with a third of all events inside one hour, many at the same time: tasks stay even, rows are right."""
    random.seed(8)
    dense = [(i, BASE + dt.timedelta(hours=30, milliseconds=random.choice([0, 1, 2, 1800, 3599]) * 1000), 3,
              random.choice(["view", "click", "purchase"]), 1.0, None) for i in range(3000)]
    rest = [(10_000 + i, BASE + dt.timedelta(minutes=random.randrange(60 * 24 * 20)), random.randrange(4, 90),
             random.choice(["view", "click", "purchase"]), 1.0, None) for i in range(6000)]
    ev = _events(spark, dense + rest).repartition(4)
    cut = S.ranged(ev, "user_id", "ts", "event_id", 12)
    sizes = [r["count"] for r in cut.groupBy("_b").count().collect()]
    assert sum(sizes) == 9000 and max(sizes) < 9000 / 48 * 2
    windows = [r["count"] for r in cut.groupBy("user_id", "_b").count().collect()]  # what one window task must hold together
    assert max(windows) < 9000 / 48 * 2
    got = {(r.user_id, r.session_start, r.n_events) for r in S.sessions(ev, 30, ranges=12).collect()}
    assert got == _brute_sessions(dense + rest, 30)
    flagged = ev.withColumn("flag", F.col("event_type") == "purchase")
    counts = {r.event_id: r.prior_count for r in S.running_count(flagged, "flag", ranges=12).collect()}
    seen, want = {}, {}
    for i, _, u, kind, _, _ in sorted(dense + rest, key=lambda r: (r[1], r[0])):
        want[i] = seen.get(u, 0)
        seen[u] = want[i] + (kind == "purchase")
    assert counts == want


def test_events_without_a_user(spark):
    rows = [(1, BASE, None, "view", 0.0, None), (2, BASE + dt.timedelta(minutes=5), None, "view", 0.0, None),
            (3, BASE, 1, "view", 0.0, None), (4, BASE + dt.timedelta(minutes=5), 1, "view", 0.0, None)]
    got = Counter((r.user_id, r.n_events) for r in S.sessions(_events(spark, rows), 30, ranges=2).collect())
    assert got == {(None, 1): 2, (1, 2): 1}
