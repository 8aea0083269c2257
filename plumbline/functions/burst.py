"""Burst flags for one time bucket."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.constants import (
    DAY_MIN_REVIEWS,
    DAY_MIN_Z,
    HOUR_MIN_FIVE_STAR_SHARE,
    HOUR_MIN_REVIEWS,
    MIN_BASELINE_BUCKETS,
)


def bucket(ts: Column, unit: str) -> Column:
    return F.date_trunc(unit, ts)


def z_score(n: Column, mean: Column, stddev: Column, buckets: Column) -> Column:
    usable = (buckets >= MIN_BASELINE_BUCKETS) & stddev.isNotNull() & (stddev != 0)
    return F.when(usable, F.try_divide(n - mean, stddev))


def is_day_burst(z: Column, n: Column) -> Column:
    return F.coalesce((z >= DAY_MIN_Z) & (n >= DAY_MIN_REVIEWS), F.lit(False))


def is_hour_burst(n: Column, five_star: Column, buckets_in_group: Column) -> Column:
    share = F.try_divide(five_star, n)
    return F.coalesce(
        (buckets_in_group >= MIN_BASELINE_BUCKETS)
        & (n >= HOUR_MIN_REVIEWS)
        & (share >= HOUR_MIN_FIVE_STAR_SHARE),
        F.lit(False),
    )
