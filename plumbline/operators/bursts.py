"""Review-volume bursts against a trailing 14-day baseline."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.constants import BASELINE_DAYS, REQUIRED_STARS
from plumbline.functions import burst

LEVELS = ("store", "product")
UNITS = ("day", "hour")
_GROUP = ["store_id", "product_id", "level", "granularity"]


def bucket_counts(raw: DataFrame, units=UNITS, levels=LEVELS) -> DataFrame:
    """Reviews and five-star reviews per bucket, for every unit and level in one
    pass. Rows are combined before the shuffle and the bucket is part of the key,
    so a store with a large share of all reviews is spread like any other."""
    timed = raw.select(
        "store_id",
        "product_id",
        "star_rating",
        *[burst.bucket(F.col("review_ts"), unit).alias(unit) for unit in units],
    )
    columns = ["store_id", *(["product_id"] if "product" in levels else []), *units]
    sets = [
        ["store_id", *(["product_id"] if level == "product" else []), unit]
        for level in levels
        for unit in units
    ]
    grouped = timed.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns]).agg(
        F.count("*").alias("n_reviews"),
        F.count_if(F.col("star_rating") == REQUIRED_STARS).alias("n_five_star"),
        *[F.grouping(unit).alias(f"no_{unit}") for unit in units],
        *([F.grouping("product_id").alias("no_product")] if "product" in levels else []),
    )
    granularity, bucket_ts = F.lit(None).cast("string"), F.lit(None).cast("timestamp")
    for unit in units:
        granularity = F.when(F.col(f"no_{unit}") == 0, unit).otherwise(granularity)
        bucket_ts = F.when(F.col(f"no_{unit}") == 0, F.col(unit)).otherwise(bucket_ts)
    has_product = F.col("no_product") == 0 if "product" in levels else F.lit(False)
    return grouped.select(
        "store_id",
        F.when(has_product, F.col("product_id")).alias("product_id") if "product" in levels
        else F.lit(None).cast("string").alias("product_id"),
        F.when(has_product, "product").otherwise("store").alias("level"),
        granularity.alias("granularity"),
        bucket_ts.alias("bucket_ts"),
        "n_reviews",
        "n_five_star",
    )


def trailing_baseline(buckets: DataFrame, days: int = BASELINE_DAYS) -> DataFrame:
    """Mean, sample deviation and number of the group's earlier buckets in the
    last ``days`` days. Only buckets that have reviews count; the current one
    does not. A window partition holds one group's buckets, which time bounds."""
    group = Window.partitionBy(*_GROUP)
    before = group.orderBy(F.unix_seconds("bucket_ts")).rangeBetween(-days * 86400, -1)
    n = F.col("n_reviews")
    return (
        buckets.withColumn("baseline_mean", F.avg(n).over(before))
        .withColumn("baseline_stddev", F.stddev_samp(n).over(before))
        .withColumn("baseline_buckets", F.count("*").over(before))
        .withColumn("group_buckets", F.count("*").over(group))
    )


def burst_events(raw: DataFrame, units=UNITS, levels=LEVELS, days: int = BASELINE_DAYS) -> DataFrame:
    """Scored buckets of all reviews."""
    return score_buckets(bucket_counts(raw, units, levels), days)


def score_buckets(buckets: DataFrame, days: int = BASELINE_DAYS) -> DataFrame:
    """Scored buckets. Day buckets flag on the z-score; hour buckets flag on a
    five-star rush in a group with enough buckets overall."""
    scored = trailing_baseline(buckets, days)
    z = burst.z_score(
        F.col("n_reviews"), F.col("baseline_mean"), F.col("baseline_stddev"), F.col("baseline_buckets")
    )
    flagged = F.when(
        F.col("granularity") == "day", burst.is_day_burst(F.col("z_score"), F.col("n_reviews"))
    ).otherwise(burst.is_hour_burst(F.col("n_reviews"), F.col("n_five_star"), F.col("group_buckets")))
    return scored.withColumn("z_score", z).select(
        "store_id",
        "product_id",
        "bucket_ts",
        "granularity",
        "n_reviews",
        "n_five_star",
        "baseline_mean",
        "baseline_stddev",
        "z_score",
        flagged.alias("is_burst"),
    )


def flagged_bursts(bursts: DataFrame) -> DataFrame:
    """Bursts for the report, newest first."""
    return bursts.where("is_burst").orderBy(F.desc("bucket_ts"), "store_id", "product_id", "granularity")
