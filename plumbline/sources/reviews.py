"""Review, seed and label files."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.constants import (
    DELIVERY_PHRASE_VERSION,
    DELIVERY_PHRASES,
    FORBIDDEN_KEYS,
    HUMAN_LABELS,
    LABEL_STRATA,
    LANGUAGE_HINTS,
    SEED_CATEGORIES,
)
from plumbline.functions import ids, text
from plumbline.schemas import PHRASES, RAW_REVIEWS

_ISO_WITH_OFFSET = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]([01]\d|2[0-3]):[0-5]\d)$"

# Order of arrival. Blocks of one file are ordered by their offset; within a
# block one task numbers the lines as it reads them.
FILE_ORDER = ["source_file", "source_block", "source_line"]


class _Field:
    """One key of a JSON object held as a VARIANT column."""

    def __init__(self, doc: Column, key: str):
        self.doc, self.path = doc, f"$.{key}"
        self.node = F.variant_get(doc, self.path, "variant")
        self.kind = F.schema_of_variant(self.node)
        self.absent = self.node.isNull()
        self.null = F.coalesce(F.is_variant_null(self.node), F.lit(False))

    def text(self) -> Column:
        return F.when(self.kind == "STRING", F.try_variant_get(self.doc, self.path, "string"))

    def number(self) -> Column:
        numeric = self.kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
        return F.when(numeric, F.try_variant_get(self.doc, self.path, "double"))

    def flag(self) -> Column:
        return F.when(self.kind == "BOOLEAN", F.try_variant_get(self.doc, self.path, "boolean"))

    def filled_text(self) -> Column:
        return F.coalesce(F.length(self.text()) > 0, F.lit(False))


def _numbered_lines(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("source_block"),
        F.monotonically_increasing_id().alias("source_line"),
        text.trim_spaces(F.col("value")).alias("line"),
    ).where("line <> ''")


def parse_reviews(lines: DataFrame) -> DataFrame:
    """Typed review columns plus ``reject_reason`` (NULL, ``json`` or ``schema``)
    and ``reject_star`` for the frame ``(…, line)``. No row is lost or raises."""
    doc = F.col("doc")
    field = {
        key: _Field(doc, key)
        for key in (
            "marketplace native_review_id store_id product_id reviewer_id_raw star_rating "
            "comment_text review_ts source_url has_media language_hint"
        ).split()
    }
    stars = field["star_rating"].number()
    ts_text = field["review_ts"].text()
    url = field["source_url"].text()
    with_seconds = F.regexp_replace(ts_text, r"^(.{10}T\d{2}:\d{2})(Z|[+-])", "$1:00$2")
    instant = F.date_trunc("millisecond", F.try_to_timestamp(with_seconds))
    false = F.lit(False)

    star_ok = F.coalesce((stars == F.floor(stars)) & stars.between(1, 5), false)
    optional = lambda key: field[key].absent | field[key].null
    checks = [
        field["marketplace"].absent | field["marketplace"].filled_text(),
        optional("native_review_id") | field["native_review_id"].filled_text(),
        field["store_id"].filled_text(),
        field["product_id"].filled_text(),
        field["reviewer_id_raw"].filled_text(),
        star_ok,
        field["comment_text"].filled_text(),
        F.coalesce(ts_text.rlike(_ISO_WITH_OFFSET) & instant.isNotNull(), false),
        optional("source_url") | F.coalesce(ids.is_url(url), false),
        field["has_media"].absent | field["has_media"].flag().isNotNull(),
        field["language_hint"].absent | F.coalesce(field["language_hint"].text().isin(LANGUAGE_HINTS), false),
    ]
    valid = checks[0]
    for check in checks[1:]:
        valid = valid & check

    parsed = lines.withColumn("doc", text.strict_json(F.col("line")))
    reason = F.when(doc.isNull(), "json").when(~valid, "schema")
    order = [c for c in FILE_ORDER if c in lines.columns]
    row = F.struct(
        reason.alias("reject_reason"),
        (doc.isNotNull() & F.schema_of_variant(doc).startswith("OBJECT") & ~star_ok).alias("reject_star"),
        F.coalesce(field["marketplace"].text(), F.lit("fixture")).alias("marketplace"),
        field["native_review_id"].text().alias("native_review_id"),
        field["store_id"].text().alias("store_id"),
        field["product_id"].text().alias("product_id"),
        field["reviewer_id_raw"].text().alias("reviewer_id_raw"),
        F.when(star_ok, stars.cast("int")).alias("star_rating"),
        field["comment_text"].text().alias("comment_text"),
        ts_text.alias("review_ts_text"),
        instant.alias("review_ts"),
        url.alias("source_url"),
        F.coalesce(field["has_media"].flag(), false).alias("has_media"),
        field["language_hint"].text().alias("language_hint"),
    )
    # The one-element inline keeps later filters on these columns from being
    # rewritten in terms of the JSON document and evaluating it again.
    return parsed.select(*order, row.alias("row")).select(*order, F.inline(F.array("row")))


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    """Review JSONL with defaults applied and bad rows marked, in file order columns."""
    return parse_reviews(_numbered_lines(spark.read.text(path)))


def split_rejects(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rejects as position and reason only (a bad line may hold personal data)."""
    order = [c for c in FILE_ORDER if c in parsed.columns]
    good = parsed.where("reject_reason IS NULL").drop("reject_reason", "reject_star")
    bad = parsed.where("reject_reason IS NOT NULL").select(*order, "reject_reason", "reject_star")
    return good, bad


def reject_counts(parsed: DataFrame) -> DataFrame:
    return parsed.agg(
        F.count("*").alias("n_read"),
        F.count_if(F.col("reject_reason").isNull()).alias("n_accepted"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("n_rejected"),
        F.count_if(F.col("reject_reason") == "json").alias("n_rejected_json"),
        F.count_if(F.col("reject_reason") == "schema").alias("n_rejected_schema"),
        F.count_if((F.col("reject_reason") == "schema") & F.col("reject_star")).alias("n_rejected_star"),
    )


def assert_no_rejects(rejects: DataFrame) -> None:
    if not rejects.isEmpty():
        raise ValueError("strict mode: some rows were rejected")


def review_filter(
    stores: Sequence[str] | None = None,
    products: Sequence[str] | None = None,
    since: datetime | str | None = None,
    until: datetime | str | None = None,
) -> Column:
    """Scope of an ingest as one condition; bounds are inclusive, unset means all."""
    keep = F.lit(True)
    if stores:
        keep = keep & F.col("store_id").isin(list(stores))
    if products:
        keep = keep & F.col("product_id").isin(list(products))
    if since is not None:
        keep = keep & (F.col("review_ts") >= F.lit(since).cast("timestamp"))
    if until is not None:
        keep = keep & (F.col("review_ts") <= F.lit(until).cast("timestamp"))
    return keep


def filter_reviews(df: DataFrame, **scope) -> DataFrame:
    return df.where(review_filter(**scope))


def cap_rows(df: DataFrame, n: int, order: Sequence[str] = tuple(FILE_ORDER)) -> DataFrame:
    """First ``n`` rows in arrival order, where the caller asks for a row budget."""
    return df.orderBy(*order).limit(n)


def normalize_reviews(
    df: DataFrame, salt: str, batch_id: str, run_id: str, ingested_at: datetime | str
) -> DataFrame:
    """Accepted reviews as the 19 stored columns; the raw reviewer id ends here."""
    now = F.lit(ingested_at).cast("timestamp")
    prepared = df.select(
        *[c for c in FILE_ORDER if c in df.columns],
        "marketplace",
        "native_review_id",
        "store_id",
        "product_id",
        ids.pseudonymize(F.col("reviewer_id_raw"), salt).alias("reviewer_id_hash"),
        F.col("star_rating").cast("long").alias("star_rating"),
        text.normalize_text(F.col("comment_text")).alias("comment_text"),
        "review_ts",
        ids.url_hash(F.col("source_url")).alias("source_url_hash"),
        F.col("language_hint").alias("given_language"),
        "has_media",
        ids.payload_hash(
            F.col("marketplace"),
            F.col("native_review_id"),
            F.col("store_id"),
            F.col("product_id"),
            F.col("star_rating"),
            F.col("comment_text"),
            F.col("review_ts_text"),
            F.col("source_url"),
            F.col("has_media"),
            F.col("language_hint"),
        ).alias("raw_payload_hash"),
    )
    keyed = (
        prepared.withColumn("content_hash", F.sha2("comment_text", 256))
        .withColumn(
            "review_id",
            ids.review_id(
                F.col("marketplace"),
                F.col("native_review_id"),
                F.col("store_id"),
                F.col("product_id"),
                F.col("reviewer_id_hash"),
                F.col("content_hash"),
                F.col("review_ts"),
            ),
        )
        .withColumn("language_hint", text.language_hint(F.col("comment_text"), F.col("given_language")))
        .withColumn("char_length", text.code_points(F.col("comment_text")))
        .withColumn("ingested_at", now)
        .withColumn("updated_at", now)
        .withColumn("crawl_batch_id", F.lit(batch_id))
        .withColumn("pipeline_run_id", F.lit(run_id))
    )
    return keyed.select(*[c for c in FILE_ORDER if c in df.columns], *RAW_REVIEWS.names)


# -- normalised NDJSON -------------------------------------------------------


def write_ndjson(df: DataFrame, path: str) -> None:
    """Stored columns as JSON lines with nulls kept and UTC millisecond times."""
    times = {f.name for f in RAW_REVIEWS.fields if f.dataType.typeName() == "timestamp"}
    df.select(
        *[ids.iso_millis(F.col(c)).alias(c) if c in times else F.col(c) for c in RAW_REVIEWS.names]
    ).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_normalized(spark: SparkSession, path: str) -> DataFrame:
    """Normalised NDJSON, strictly: an unknown, missing, mistyped or personal-data
    key fails the job and names the file and the problem."""
    doc = F.col("doc")
    field = {name: _Field(doc, name) for name in RAW_REVIEWS.names}
    keys = F.json_object_keys("line")
    allowed = F.array(*[F.lit(c) for c in RAW_REVIEWS.names])
    forbidden = F.array(*[F.lit(k) for k in FORBIDDEN_KEYS])
    nullable = {"native_review_id", "source_url_hash"}
    whole = lambda f: F.coalesce(f.number() == F.floor(f.number()), F.lit(False))

    rules = []
    for name in RAW_REVIEWS.names:
        f = field[name]
        if name == "has_media":
            ok = f.flag().isNotNull()
        elif name == "star_rating":
            ok = whole(f) & F.coalesce(f.number().between(1, 5), F.lit(False))
        elif name == "char_length":
            ok = whole(f) & F.coalesce(f.number() >= 0, F.lit(False))
        elif name == "language_hint":
            ok = F.coalesce(f.text().isin(LANGUAGE_HINTS), F.lit(False))
        elif name in nullable:
            ok = f.null | f.filled_text()
        else:
            ok = f.filled_text()
        rules.append(F.when(~ok, name))
    bad = F.concat_ws(", ", *rules)

    problem = (
        F.when(doc.isNull(), F.lit("not valid JSON"))
        .when(~F.schema_of_variant(doc).startswith("OBJECT"), F.lit("not a JSON object"))
        .when(
            F.arrays_overlap(keys, forbidden),
            F.concat(F.lit("forbidden key "), F.array_join(F.array_intersect(keys, forbidden), ", ")),
        )
        .when(
            F.size(F.array_except(keys, allowed)) > 0,
            F.concat(F.lit("unknown key "), F.array_join(F.array_except(keys, allowed), ", ")),
        )
        .when(bad != "", F.concat(F.lit("missing or wrong value: "), bad))
    )
    where = F.concat(F.lit("invalid review in "), F.col("source_file"), F.lit(": "), problem)

    def typed(name: str, kind: str) -> Column:
        f = field[name]
        if kind == "timestamp":
            return F.to_timestamp(f.text()).alias(name)
        if kind == "bigint":
            return f.number().cast("long").alias(name)
        return (f.flag() if kind == "boolean" else f.text()).alias(name)

    lines = _numbered_lines(spark.read.text(path)).withColumn("doc", text.strict_json(F.col("line")))
    checked = lines.withColumn(
        "doc", F.when(problem.isNotNull(), F.raise_error(where)).otherwise(doc)
    )
    return checked.select(
        *FILE_ORDER, *[typed(f.name, f.dataType.simpleString()) for f in RAW_REVIEWS.fields]
    )


# -- seeds, labels, phrases --------------------------------------------------


def _documents(spark: SparkSession, path: str) -> DataFrame:
    """Objects of small hand-kept files, each a JSON array or JSON lines."""
    body = text.trim_spaces(F.col("value"))
    array = F.try_parse_json(body).cast("array<variant>")
    lines = F.transform(
        F.filter(F.split(body, "\n"), lambda s: F.length(text.trim_spaces(s)) > 0),
        lambda s: F.parse_json(s),
    )
    files = spark.read.text(path, wholetext=True).where(F.length(body) > 0)
    return files.select(F.explode(F.when(body.startswith("["), array).otherwise(lines)).alias("doc"))


def read_seed_set(spark: SparkSession, path: str) -> DataFrame:
    doc = F.col("doc")
    get = lambda key: _Field(doc, key).text()
    return _documents(spark, path).select(
        get("seed_id").alias("seed_id"),
        get("category").alias("category"),
        text.trim_spaces(text.form_c(get("seed_text"))).alias("seed_text"),
    )


def validate_seed_set(seeds: DataFrame) -> DataFrame:
    """Exactly one non-empty seed per category slot, with unique ids."""
    slots = len(SEED_CATEGORIES)
    rows = seeds.limit(slots + 1).collect()
    problems = []
    if len(rows) != slots:
        problems.append(f"a seed set has exactly {slots} rows")
    if any(not r.seed_id or not r.seed_text for r in rows):
        problems.append("empty seed_id or seed_text")
    if len({r.seed_id for r in rows}) != len(rows):
        problems.append("duplicate seed_id")
    if len({r.category for r in rows}) != len(rows):
        problems.append("duplicate category")
    if {r.category for r in rows} != set(SEED_CATEGORIES):
        problems.append("unknown or missing category")
    if problems:
        raise ValueError("; ".join(problems))
    return seeds


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    doc = F.col("doc")
    get = lambda key: _Field(doc, key).text().alias(key)
    return _documents(spark, path).select(get("review_id"), get("label"), get("stratum"), get("notes"))


def label_problems(labels: DataFrame) -> DataFrame:
    """Review ids that make a label file unusable, with the reason; empty when all is well."""
    return (
        labels.groupBy("review_id")
        .agg(
            F.count("*").alias("n"),
            F.count_if(~F.coalesce(F.col("label").isin(HUMAN_LABELS), F.lit(False))).alias("bad_label"),
            F.count_if(F.col("stratum").isNotNull() & ~F.col("stratum").isin(LABEL_STRATA)).alias("bad_stratum"),
        )
        .select(
            "review_id",
            F.when(F.coalesce(F.length("review_id"), F.lit(0)) == 0, "missing review_id")
            .when(F.col("n") > 1, "duplicate review_id")
            .when(F.col("bad_label") > 0, "unknown label")
            .when(F.col("bad_stratum") > 0, "unknown stratum")
            .alias("problem"),
        )
        .where("problem IS NOT NULL")
    )


def validate_labels(labels: DataFrame) -> DataFrame:
    first = label_problems(labels).take(1)
    if first:
        raise ValueError(f"{first[0].problem}: {first[0].review_id}")
    return labels


def delivery_phrases(spark: SparkSession) -> DataFrame:
    """The built-in phrase dimension, version v0."""
    rows = []
    for category, phrases in DELIVERY_PHRASES.items():
        for phrase in phrases:
            lang = "en" if phrase.isascii() else "yue"
            rows.append((f"{category}_{len(rows) + 1:02d}", phrase, "contains", lang, category, True, DELIVERY_PHRASE_VERSION))
    return spark.createDataFrame(rows, PHRASES)
