from __future__ import annotations

from datetime import datetime, timedelta
from statistics import mean, stdev

import numpy as np
from pyspark.sql import functions as F

from plumbline.functions import burst
from plumbline.operators import bursts

START = datetime(2024, 1, 1)


def reviews(spark, rows):
    return spark.createDataFrame(rows, "store_id string, product_id string, star_rating long, review_ts timestamp")


def brute(rows, unit, by_product):
    cut = (lambda t: t.replace(hour=0, minute=0, second=0)) if unit == "day" else (lambda t: t.replace(minute=0, second=0))
    counts: dict = {}
    for store, product, star, ts in rows:
        key = (store, product if by_product else None)
        n, five = counts.setdefault(key, {}).get(cut(ts), (0, 0))
        counts[key][cut(ts)] = (n + 1, five + (star == 5))
    out = {}
    for (store, product), buckets in counts.items():
        for b, (n, five) in buckets.items():
            past = [c for other, (c, _) in buckets.items() if b - timedelta(days=14) <= other < b]
            sd = stdev(past) if len(past) > 1 else None
            z = None if len(past) < 5 or not sd else (n - mean(past)) / sd
            flag = (z is not None and z >= 3 and n >= 10) if unit == "day" else (len(buckets) >= 5 and n >= 8 and five / n >= 0.9)
            out[(store, product, b, unit)] = (n, five, None if z is None else round(z, 6), flag)
    return out


def test_all_levels_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = []
    for day in range(40):
        for _ in range(int(rng.integers(0, 6)) + (25 if day in (20, 33) else 0)):
            ts = START + timedelta(days=day, hours=int(rng.integers(0, 3)) * 7, minutes=int(rng.integers(0, 60)))
            rows.append((f"s{rng.integers(0, 2)}", f"p{rng.integers(0, 2)}", int(rng.choice([5, 5, 5, 4])), ts))
    got = {
        (r.store_id, r.product_id, r.bucket_ts, r.granularity): (r.n_reviews, r.n_five_star, None if r.z_score is None else round(r.z_score, 6), r.is_burst)
        for r in bursts.burst_events(reviews(spark, rows)).collect()
    }
    want = {}
    for unit in ("day", "hour"):
        for by_product in (False, True):
            want.update(brute(rows, unit, by_product))
    assert got == want
    assert any(flag for *_, flag in want.values())
    flagged = bursts.flagged_bursts(bursts.burst_events(reviews(spark, rows))).collect()
    assert [r.bucket_ts for r in flagged] == sorted((r.bucket_ts for r in flagged), reverse=True)


def test_window_edge_is_fourteen_days(spark):
    def baseline(gap):
        rows = [("s", "p", 5, START), ("s", "p", 5, START + timedelta(days=gap))]
        counted = bursts.trailing_baseline(bursts.bucket_counts(reviews(spark, rows), ("day",), ("store",)))
        return counted.orderBy(F.desc("bucket_ts")).first()

    assert baseline(14).baseline_buckets == 1 and baseline(14).baseline_stddev is None
    assert baseline(15).baseline_buckets == 0 and baseline(15).baseline_mean is None


def flag(spark, expression):
    return spark.range(1).select(expression).first()[0]


def test_flags_at_their_edges(spark):
    lit = F.lit
    z = lambda n, m, sd, b: flag(spark, burst.z_score(lit(n), lit(m), lit(sd).cast("double"), lit(b)))
    assert z(10, 4.0, 2.0, 5) == 3.0
    assert z(10, 4.0, 2.0, 4) is None and z(10, 4.0, 0.0, 9) is None and z(10, 4.0, None, 9) is None
    day = lambda score, n: flag(spark, burst.is_day_burst(lit(score).cast("double"), lit(n)))
    assert day(3.0, 10) and not day(2.99, 10) and not day(3.0, 9) and day(None, 99) is False
    hour = lambda n, five, b: flag(spark, burst.is_hour_burst(lit(n), lit(five), lit(b)))
    assert hour(10, 9, 5) and not hour(10, 9, 4) and not hour(7, 7, 5) and not hour(10, 8, 5)


def test_hot_store_is_not_one_task(spark):
    """The bucket is part of the shuffle key, and rows combine before it."""
    rows = [("hot", "p", 5, START)]
    plan = bursts.bucket_counts(reviews(spark, rows))._jdf.queryExecution().executedPlan().toString()
    first_exchange = plan[plan.index("Exchange") :].splitlines()[0]
    assert "day" in first_exchange and "hour" in first_exchange
    assert "partial_count" in plan
