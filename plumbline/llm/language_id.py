"""Language of texts and pages by Bayesian fusion of evidence.

Four sources of evidence are multiplied and normalised:

* the text: a naive Bayes model over hashed byte trigrams, learned from labelled texts. All trigrams count, with the
  weight of ``EFFECTIVE`` independent ones at most, since neighbours overlap;
* the language that the markup declares: how often it is declared on pages whose text looks like each language;
* the suffix of the address, in the same way;
* a prior for the host, smoothed towards its domain and that towards all rows. A row's own share is taken out first.

Counts of the last three are sums of the languages' shares by text, one grouped aggregation over all rows and levels.
A row of a table has its host looked up in ``SALTS`` copies of the slim host table, so one host's rows spread.

Defined results: without text, declaration, suffix and host the result is the prior over all rows; null and empty texts
have no text evidence; declarations are cut to their primary part in lower case; rows without labelled texts to learn from have
a null language; ties go to the language first in the alphabet; rows with null or repeated ids are judged like any other.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm import common
from plumbline.llm.html_extract import PRIOR, main_text

#: Labelled texts used for training at most, those with the smallest hashes.
SAMPLE = 20_000
#: Places of the trigram table, and counts that each starts with.
PLACES, START = 1 << 15, 0.5
EFFECTIVE = 60
#: Rows that the level above is worth in a host's or domain's prior, and in the tables of declarations and suffixes.
SMOOTH = 5.0
#: Weight of declarations and suffixes against text.
DECLARED_WEIGHT, SUFFIX_WEIGHT = 1.0, 0.5
SALTS = 16
SLICE = 1 << 20


def trigrams(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per slice of rows: begin, end, places of all trigrams, and the row of each."""
    column = pc.utf8_lower(pc.fill_null(column, "")).cast(pa.large_string())
    for begin, end in common.slices(column, SLICE):
        part = column.slice(begin, end - begin)
        offsets = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + len(part) + 1]
        if offsets[-1] == offsets[0]:
            yield begin, end, np.zeros(0, np.uint32), np.zeros(0, np.int64)
            continue
        data = np.frombuffer(part.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].astype(np.uint32)
        places = (data[:-2] * np.uint32(2654435761) ^ data[1:-1] * np.uint32(2246822519) ^ data[2:] * np.uint32(3266489917)) * np.uint32(668265263)
        row = np.repeat(np.arange(end - begin), np.diff(offsets))
        whole = row[:-2] == row[2:]
        yield begin, end, (places >> np.uint32(17))[whole], row[:-2][whole]


@dataclass
class TextModel:
    languages: list[str]
    table: np.ndarray  # PLACES x languages, log probabilities


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> TextModel:
    known = docs.select(F.col(id_col).alias("__id"), F.col(lang_col).cast("string").alias("lang")).filter("__id is not null and lang is not null")
    # At most ``sample`` ids, which is what is sent to every task.
    chosen = known.select("__id").orderBy(F.xxhash64("__id"), "__id").limit(sample).distinct()
    rows = docs.filter(F.col(lang_col).isNotNull()).join(F.broadcast(chosen), F.col(id_col) == F.col("__id"), "left_semi")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            names = np.array(batch.column(0).to_pylist(), object)
            for begin, end, places, row in trigrams(batch.column(1)):
                for name in set(names[begin:end]):
                    here = np.bincount(places[(names[begin:end] == name)[row]], minlength=PLACES)
                    totals[name] = totals.get(name, 0) + here
        for name, total in totals.items():
            place = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(place), pa.string()), pa.array(place, pa.int32()), pa.array(total[place], pa.int64())], ["lang", "place", "n"])

    slim = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    summed = slim.mapInArrow(count, "lang string, place int, n long").groupBy("lang", "place").agg(F.sum("n").alias("n"))
    # PLACES numbers for each language.
    per_language = summed.groupBy("lang").agg(F.collect_list("place").alias("places"), F.collect_list("n").alias("counts")).orderBy("lang").collect()
    table = np.full((PLACES, len(per_language)), START)
    for i, r in enumerate(per_language):
        table[r["places"], i] += r["counts"]
    return TextModel([r["lang"] for r in per_language], np.log(table / table.sum(axis=0)).astype(np.float32) if per_language else table)


def evidence(rows: DataFrame, model: TextModel, column: str, *, markup: bool = False) -> DataFrame:
    """``rows`` without ``column``, with ``text_log`` array<double>: log likelihoods of the text, or of the main text
    of pages, for each language of ``model``."""
    keep = [c for c in rows.columns if c != column]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = len(model.languages)
        for batch in batches:
            column_ = batch.column(len(keep))
            if markup:
                column_ = pa.array([main_text(page, PRIOR) for page in common.texts(column_)], pa.string())
            logs = np.zeros((len(column_), languages))
            for begin, end, places, row in trigrams(column_):
                n = np.bincount(row, minlength=end - begin)
                weight = np.minimum(1.0, EFFECTIVE / np.maximum(n, 1))
                for i in range(languages):
                    logs[begin:end, i] = np.bincount(row, model.table[places, i], minlength=end - begin) * weight
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(column_) + 1) * languages, pa.int32()), pa.array(logs.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), flat], [*keep, "text_log"])

    slim = rows.select(*keep, F.col(column).cast("string").alias("__text"))
    return slim.mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", text_log array<double>")


def host_of(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def domain_of(host: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), F.lit("")), host)


def suffix_of(host: Column) -> Column:
    return F.nullif(F.regexp_extract(host, r"\.([a-z][a-z0-9-]*)$", 1), F.lit(""))


def declared_in(html: Column) -> Column:
    """Primary part of the language that the html element or a content-language declares."""
    found = F.regexp_extract(html, r"(?i)<html\b[^>]*?\slang\s*=\s*[\"']?\s*([a-z]{2,3})\b", 1)
    meta = F.regexp_extract(html, r"(?i)<meta\b[^>]*?content-language[^>]*?content\s*=\s*[\"']?\s*([a-z]{2,3})\b", 1)
    return F.lower(F.coalesce(F.nullif(found, F.lit("")), F.nullif(meta, F.lit(""))))


def _shares(logs: Column) -> Column:
    """Logarithms to shares that sum to one."""
    top = F.array_max(logs)
    raised = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(raised, lambda x: x / F.aggregate(raised, F.lit(0.0), lambda a, b: a + b))


def fuse(rows: DataFrame, languages: list[str]) -> DataFrame:
    """``rows`` (text_log, declared, suffix, domain, host, …) with lang, probability and text_lang."""
    if not languages:
        return rows.select("*", *(F.lit(None).cast(t).alias(n) for n, t in (("lang", "string"), ("probability", "double"), ("text_lang", "string"))))
    n = len(languages)
    index = F.sequence(F.lit(0), F.lit(n - 1))
    own = rows.withColumn("text_share", _shares(F.col("text_log")))
    levels = F.array(*(F.struct(F.lit(level).alias("level"), key.alias("key")) for level, key in (("all", F.lit("")), *((c, F.col(c)) for c in ("declared", "suffix", "domain", "host")))))
    # The host's place in the hierarchy goes with it.
    each = own.select("text_share", F.when(F.col("host").isNotNull(), F.col("domain")).alias("of"), F.explode(levels).alias("at")).select("text_share", "of", "at.*").filter("key is not null")
    sums = [F.sum(F.col("text_share")[i]).alias(f"s{i}") for i in range(n)]
    counts = each.groupBy("level", "key").agg(*sums, F.min("of").alias("of")).select("level", "key", "of", F.array(*(F.col(f"s{i}") for i in range(n))).alias("counts"))
    counts = common.kept(counts, "counts")
    # A number for each language.
    total = counts.filter("level = 'all'").first()
    total = total["counts"] if total else [0.0] * n
    overall = F.array(*(F.lit((c + 1) / (sum(total) + n)) for c in total))

    def mixed(counts_: Column, above: Column) -> Column:
        total = F.aggregate(counts_, F.lit(0.0), lambda a, b: a + b)
        return F.zip_with(counts_, above, lambda c, p: (F.greatest(c, F.lit(0.0)) + SMOOTH * p) / (total + SMOOTH))

    at = lambda level: counts.filter(F.col("level") == level).drop("level").withColumn("overall", overall)
    domains = at("domain").select(F.col("key").alias("of"), mixed(F.col("counts"), F.col("overall")).alias("domain_prior"))
    hosts = at("host").join(domains, "of", "left").select(F.col("key").alias("host"), F.col("counts").alias("host_counts"), F.coalesce("domain_prior", "overall").alias("above"))
    hosts = hosts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))

    def likelihood(level: str, weight: float) -> DataFrame:
        """weight * log P(key | language), up to what all languages share."""
        smooth = F.zip_with("counts", "overall", lambda c, p: weight * F.log((c + SMOOTH * p) / p))
        return at(level).select(F.col("key").alias(level), smooth.alias(f"{level}_log"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))

    own = own.withColumns({"salt": F.pmod(F.xxhash64("text_log", F.monotonically_increasing_id()), F.lit(SALTS)).cast("int"), "overall": overall})
    own = own.join(hosts, ["host", "salt"], "left")
    own = own.join(likelihood("declared", DECLARED_WEIGHT), ["declared", "salt"], "left").join(likelihood("suffix", SUFFIX_WEIGHT), ["suffix", "salt"], "left")
    others = F.zip_with("host_counts", "text_share", lambda c, s: c - s)
    own = own.withColumn("prior", F.coalesce(mixed(others, F.col("above")), F.col("overall")))
    zero = F.array(*[F.lit(0.0)] * n)
    d, s = F.coalesce("declared_log", zero), F.coalesce("suffix_log", zero)
    logs = F.transform(index, lambda i: F.col("text_log")[i] + F.log(F.col("prior")[i]) + d[i] + s[i])
    names = F.array(*map(F.lit, languages))
    best = lambda shares: names[(F.array_position(shares, F.array_max(shares)) - 1).cast("int")]
    out = own.withColumn("shares", _shares(logs))
    result = [best(F.col("shares")).alias("lang"), F.array_max("shares").alias("probability"), best(F.col("text_share")).alias("text_lang")]
    return out.select(*rows.columns, *result)


def identify(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """One row per text of ``docs`` (doc_id, text, source) and per page of ``pages`` (page_id, url, html).

    The text model is learned from labelled texts (lang) of ``docs``. A document's source takes the host's place.
    """
    model = fit(docs)
    nothing = F.lit(None).cast("string")
    texts = docs.select(
        F.lit("document").alias("kind"), F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("page_id"), nothing.alias("declared"),
        nothing.alias("suffix"), nothing.alias("domain"), F.col("source").cast("string").alias("host"), F.col("text").alias("__body"),
    )
    host = host_of(F.col("url"))
    sites = pages.select(
        F.lit("page").alias("kind"), F.lit(None).cast("long").alias("doc_id"), F.col("page_id").cast("long").alias("page_id"), declared_in(F.col("html")).alias("declared"),
        suffix_of(host).alias("suffix"), domain_of(host).alias("domain"), host.alias("host"), F.col("html").alias("__body"),
    )
    both = evidence(texts, model, "__body").union(evidence(sites, model, "__body", markup=True))
    fused = fuse(common.kept(both, "evidence"), model.languages)
    return fused.select("kind", "doc_id", "page_id", "lang", F.round("probability", 6).alias("probability"), "text_lang", "declared", "host")
