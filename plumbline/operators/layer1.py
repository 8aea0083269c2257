"""Rule filter: five stars, long enough, and not only delivery talk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.constants import EXCLUSION_REASONS, MIN_TEXT_CHARS, REQUIRED_STARS
from plumbline.functions import text
from plumbline.functions.phrases import intervals, length_without, stripped_length

#: Phrases in one automaton, in bytes; what is read by the driver at a time and sent to a task.
PHRASE_BLOCK_BYTES = 4 << 20


def active_phrases(phrases: DataFrame) -> DataFrame:
    return phrases.where(F.col("is_active") & F.col("match_type").isin("contains", "exact"))


def compile_phrases(phrases: DataFrame) -> DataFrame:
    """One row, one column: an alternation of all phrases, longest first, or NULL
    when there are none. The phrase list is a hand-kept dimension."""
    longest_first = F.sort_array(F.collect_list(F.struct(-F.char_length("phrase"), F.col("phrase"))))
    alternatives = F.array_join(
        F.transform(longest_first, lambda p: text.regex_escape(p["phrase"])), "|"
    )
    return phrases.agg(
        F.when(F.count("*") > 0, F.concat(F.lit("(?iu)"), alternatives)).alias("pattern")
    )


def with_stripped_length(raw: DataFrame, phrases: DataFrame, block_bytes: int = PHRASE_BLOCK_BYTES) -> DataFrame:
    """``raw`` with the length of each text once all active phrases are cut.

    A table within one block of ``block_bytes`` is looked for in one pass, without a
    shuffle. A larger one is dealt by hash into blocks of about that size. A task holds
    one of them and reports only matches; these, not texts, are gathered per review
    and joined back. Each block is one more scan of the two columns it needs.
    """
    active = active_phrases(phrases).select("phrase").where("phrase <> ''").distinct()
    size = active.agg(F.sum(F.octet_length("phrase"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))

    def block(k: int) -> list[str]:
        own = active if blocks == 1 else active.where(F.pmod(F.xxhash64("phrase"), F.lit(blocks)) == k)
        return [row.phrase for row in own.toLocalIterator()]

    if blocks == 1:
        return raw.withColumn("stripped_char_length", stripped_length(F.col("comment_text"), block(0)))
    # A repeated id with another text is another key; equal rows have equal matches.
    text_key = F.xxhash64("comment_text")
    slim = raw.select("review_id", "comment_text")
    found = None
    for k in range(blocks):
        hits = slim.select("review_id", text_key.alias("__text"), intervals(F.col("comment_text"), block(k)).alias("hits"))
        hits = hits.where(F.size("hits") > 0)
        found = hits if found is None else found.unionAll(hits)
    found = found.groupBy("review_id", "__text").agg(F.array_distinct(F.flatten(F.collect_set("hits"))).alias("__hits"))
    found = found.withColumnRenamed("review_id", "__id")
    joined = raw.join(found, F.col("review_id").eqNullSafe(F.col("__id")) & (text_key == F.col("__text")), "left")
    left = length_without(F.col("comment_text"), F.col("__hits"))
    return joined.withColumn("stripped_char_length", left).drop("__id", "__text", "__hits")


def exclusion_reason(stars: int = REQUIRED_STARS, min_chars: int = MIN_TEXT_CHARS) -> Column:
    not_five, short, delivery_only, passed = EXCLUSION_REASONS
    return (
        F.when(F.col("star_rating") != stars, not_five)
        .when(F.col("char_length") < min_chars, short)
        .when(F.col("stripped_char_length") < min_chars, delivery_only)
        .otherwise(passed)
    )


def l1_audit(
    raw: DataFrame, phrases: DataFrame, stars: int = REQUIRED_STARS, min_chars: int = MIN_TEXT_CHARS
) -> DataFrame:
    """Why each review was kept or dropped; one row per review."""
    return with_stripped_length(raw, phrases).select(
        "pipeline_run_id",
        "review_id",
        "store_id",
        "star_rating",
        "char_length",
        "stripped_char_length",
        exclusion_reason(stars, min_chars).alias("exclusion_reason"),
    )


def _stage1_columns(kept: DataFrame) -> DataFrame:
    return kept.select(
        "pipeline_run_id",
        "review_id",
        "marketplace",
        "store_id",
        "product_id",
        "reviewer_id_hash",
        "star_rating",
        "comment_text",
        "content_hash",
        "review_ts",
        "language_hint",
        "char_length",
        "stripped_char_length",
        F.lit("pass").alias("filter_reason"),
    )


def l1_filter(
    raw: DataFrame, phrases: DataFrame, stars: int = REQUIRED_STARS, min_chars: int = MIN_TEXT_CHARS
) -> DataFrame:
    """Reviews that pass. The two stored-column tests reach the scan, so phrases
    are only looked for in rows that survive them."""
    candidates = raw.where((F.col("star_rating") == stars) & (F.col("char_length") >= min_chars))
    return _stage1_columns(with_stripped_length(candidates, phrases).where(F.col("stripped_char_length") >= min_chars))


def passed(raw: DataFrame, audit: DataFrame) -> DataFrame:
    """The same reviews by a stored audit of ``raw``."""
    fit = audit.where(F.col("exclusion_reason") == EXCLUSION_REASONS[-1]).select("review_id", "stripped_char_length")
    return _stage1_columns(raw.join(fit, "review_id"))


def l1_funnel(audit: DataFrame, stage1: DataFrame) -> DataFrame:
    counts = audit.agg(
        F.count("*").alias("n_in"),
        *[
            F.count_if(F.col("exclusion_reason") == reason).alias(f"n_{reason}")
            for reason in EXCLUSION_REASONS[:-1]
        ],
    )
    return counts.withColumn("n_out", stage1.agg(F.count("*")).scalar())
