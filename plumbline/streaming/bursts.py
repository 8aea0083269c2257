"""Review-volume bursts of a stream.

The stream keeps reviews per hour, store and product in its state and writes each hour once, when the watermark has
passed its end. What it has written is small; days are sums of hours, and the flags are those of the batch form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plumbline.constants import BASELINE_DAYS, REQUIRED_STARS
from plumbline.operators.bursts import score_buckets

#: How late a review may come and still count.
DELAY = "2 days"
COUNTS = "store_id string, product_id string, level string, granularity string, bucket_ts timestamp, n_reviews long, n_five_star long"


def hour_counts(reviews: DataFrame, delay: str = DELAY) -> DataFrame:
    """Hour buckets of a stream of (review_id, store_id, product_id, star_rating, review_ts), for stores and products.

    A review sent again within ``delay`` counts once. Reviews without time, and those that come later than ``delay``
    after the newest one, are in no bucket. Rows are combined before the shuffle, and the hour is in its key.
    """
    once = reviews.where("review_ts IS NOT NULL").withWatermark("review_ts", delay).dropDuplicatesWithinWatermark(["review_id"])
    groups = F.array(
        F.struct(F.lit("store").alias("level"), F.lit(None).cast("string").alias("product_id")),
        F.struct(F.lit("product").alias("level"), F.col("product_id").cast("string").alias("product_id")),
    )
    each = once.select("store_id", "star_rating", "review_ts", F.inline(groups))
    counted = each.groupBy("store_id", "product_id", "level", F.window("review_ts", "1 hour").alias("hour")).agg(
        F.count("*").alias("n_reviews"), F.count_if(F.col("star_rating") == REQUIRED_STARS).alias("n_five_star")
    )
    return counted.select(
        "store_id", "product_id", "level", F.lit("hour").alias("granularity"), F.col("hour.start").alias("bucket_ts"), "n_reviews", "n_five_star"
    )


def stream_hour_counts(reviews: DataFrame, path: str, checkpoint: str, delay: str = DELAY, **trigger) -> StreamingQuery:
    """Start writing finished hours to ``path``, each exactly once; ``trigger`` is passed on."""
    writer = hour_counts(reviews, delay).writeStream.outputMode("append").format("parquet").option("path", path)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def with_days(hours: DataFrame) -> DataFrame:
    """Hour buckets and the day buckets that they add up to; the newest day may still grow."""
    day = F.date_trunc("day", "bucket_ts").alias("bucket_ts")
    days = hours.groupBy("store_id", "product_id", "level", day).agg(F.sum("n_reviews").alias("n_reviews"), F.sum("n_five_star").alias("n_five_star"))
    return hours.unionByName(days.withColumn("granularity", F.lit("day")))


def stored_bursts(hours: DataFrame, days: int = BASELINE_DAYS) -> DataFrame:
    """Scored day and hour buckets of what the stream has written."""
    return score_buckets(with_days(hours), days)
