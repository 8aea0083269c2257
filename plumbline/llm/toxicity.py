"""Toxicity by gradient-boosted trees over dense features of the whole text, with isotonic calibration.

Features are rates of words of a lexicon, how many of them stand near a second-person word, capitals, punctuation and
obfuscated spellings. The lexicon starts from ``SEEDS`` and learns words and word beginnings that mark toxic rows. The
three steps (lexicon, trees, calibration) use separate parts of the labelled rows, so that each sees the one before
as it works on new texts. Training takes at most ``SAMPLE`` labelled rows, those with the smallest hashes; scoring
covers every row.

Defined results: null and empty texts have no words and get the score of such texts; rows with a null or repeated id
are scored like any other; of several labels of one id the highest counts, null labels and labels without a document
don't; without at least ``LEAST`` labelled rows of both kinds in the part for trees, the score is h / (h + 1) for h
lexicon words, and without both kinds in the part for calibration, scores stay uncalibrated. Other columns, labels,
language and source are never inputs.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm import common
from plumbline.llm.words import Recent, word_hashes

#: Labelled rows used for training at most.
SAMPLE = 20_000
LEAST = 5
#: Learned lexicon entries at most, rows of the toxic kind that an entry needs, and its least log odds and deviation.
ENTRIES, SUPPORT, ODDS, DEVIATION = 4_000, 4, 2.0, 3.0
#: Lengths of word beginnings that can be entries.
BEGINNINGS = (3, 4, 5, 6)
#: Words before or after within which a second-person word counts as near.
NEAR = 5
#: Words that need no labels.
SEEDS = ("idiot", "moron", "stupid", "loser", "scum", "trash", "pathetic", "worthless", "disgusting", "clown", "dumb", "imbecile", "idiota", "estúpido", "dummkopf", "trottel", "abschaum", "connard", "crétin", "débile", "imbécil")
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine deiner ihr euch tu te toi ton ta tes vous votre vos tú ti tuyo usted ustedes vosotros".split())
_LEET = str.maketrans("013457@$!", "oieastasi")
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_INNER = re.compile(r"\w[*@$#!.0-9_-]+\w")
_STRETCH = re.compile(r"(\w)\1{2,}")

#: What a token's code holds: flags, then the weight of its lexicon entry in tenths.
HIT, SECOND, CAPS, OBFUSCATED, SHOUT, MARKS, WEIGHT = 1, 2, 4, 8, 16, 32, 256
FEATURES = ("log_words", "hit_rate", "log_hits", "weight_rate", "top_weight", "near_rate", "second_rate", "caps_rate", "shout_rate", "mark_rate", "obfuscated_rate", "obfuscated_hits", "next_weight")


class Codes(dict):
    """Token to code, worked out when first met; tokens used again survive when the table is renewed."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon, self.recent = lexicon, Recent(50_000)

    def weight(self, word: str) -> float:
        found = self.lexicon.get(word, 0.0)
        for n in BEGINNINGS:
            if len(word) > n:
                found = max(found, self.lexicon.get(word[:n] + "…", 0.0))
        return found

    def __missing__(self, token: str) -> int:
        code = self.recent.get(token)
        if code is None:
            code = self.recent.old(token)
        if code is None:
            code = self.recent.put(token, self.code(token))
        return code

    def code(self, token: str) -> int:
        word = _EDGE.sub("", token.lower())
        code = 0
        weight = self.weight(word)
        if _INNER.search(token) or _STRETCH.search(word):
            bare = re.sub(r"[\W_]", "", _STRETCH.sub(r"\1", word.translate(_LEET)))
            hidden = max(self.weight(bare), self.weight(re.sub(r"[\W\d_]", "", word)))
            code |= OBFUSCATED
            weight = max(weight, hidden)
        if weight:
            code |= HIT | int(10 * min(weight, 12.0)) * WEIGHT
        if word in SECOND_PERSON:
            code |= SECOND
        if len(word) > 1 and token.upper() == token and token.lower() != token:
            code |= CAPS
        if "!" in token or "?!" in token:
            code |= SHOUT
        if re.search(r"[*#$%&@|]", token):
            code |= MARKS
        return code


def dense(text: str, codes: Codes) -> list[float]:
    tokens = text.split()
    n = len(tokens)
    seen = np.fromiter(map(codes.__getitem__, tokens), np.int64, n)
    hits = np.flatnonzero(seen & HIT)
    rate = lambda flag: float(np.count_nonzero(seen & flag)) / max(n, 1)
    weights = np.sort(seen[hits] // WEIGHT / 10)[::-1]
    near = 0
    if len(hits):
        so_far = np.concatenate([[0], np.cumsum((seen & SECOND) > 0)])
        near = np.count_nonzero(so_far[np.minimum(hits + NEAR + 1, n)] > so_far[np.maximum(hits - NEAR, 0)]) / len(hits)
    return [
        math.log1p(n),
        len(hits) / max(n, 1),
        math.log1p(len(hits)),
        float(weights.sum()) / max(n, 1),
        float(weights[0]) if len(weights) else 0.0,
        float(near),
        rate(SECOND),
        rate(CAPS),
        rate(SHOUT),
        rate(MARKS),
        rate(OBFUSCATED),
        float(np.count_nonzero(seen[hits] & OBFUSCATED)),
        float(weights[1]) if len(weights) > 1 else 0.0,
    ]


def features(docs: DataFrame, lexicon: dict[str, float], *, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """``keep`` and (features array<double>, hits double) of every row."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes(lexicon)
        for batch in batches:
            rows = np.array([dense(text, codes) for text in common.texts(batch.column(len(keep)))], np.float64).reshape(-1, len(FEATURES))
            flat = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), flat, pa.array(np.expm1(rows[:, 2]))], [*keep, "features", "hits"])

    slim = docs.select(*keep, F.col(text_col).cast("string").alias("__text"))
    return slim.mapInArrow(common.tidy(run), ", ".join(f"{c} {kinds[c]}" for c in keep) + ", features array<double>, hits double")


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text divides by five."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def terms_of(text: str) -> list[str]:
    words = {_EDGE.sub("", w) for w in text.lower().split()}
    return sorted({w for w in words if w} | {w[:n] + "…" for w in words for n in BEGINNINGS if len(w) > n})


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Entries with their log odds from (doc_id, text, toxic). Of near copies one row counts: those with one least
    hash of three words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signs, terms = [], []
            for i, text in enumerate(common.texts(batch.column(1))):
                _, words = word_hashes(batch.column(1).slice(i, 1))
                three = words[:-2] + words[1:-1] * np.uint64(3) + words[2:] * np.uint64(5) if len(words) > 2 else words
                signs.append(int(three.min() >> np.uint64(1)) if len(three) else 0)
                terms.append(terms_of(text))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(signs, pa.int64()), pa.array(terms, pa.list_(pa.string()))], ["doc_id", "toxic", "sign", "terms"])

    each = rows.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("toxic").cast("int")).mapInArrow(common.tidy(run), "doc_id long, toxic int, sign long, terms array<string>")
    each = common.kept(each.groupBy("sign", "toxic").agg(F.min(F.struct("doc_id", "terms")).alias("one")).select("toxic", "one.terms"), "terms")
    totals = {r["toxic"]: r["count"] for r in each.groupBy("toxic").count().collect()}
    t, c = F.sum("toxic"), F.count("*") - F.sum("toxic")
    counts = each.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(t.alias("t"), c.alias("c")).filter(F.col("t") >= SUPPORT)
    odds = F.log((F.col("t") + 0.5) / (totals.get(1, 0) + 1)) - F.log((F.col("c") + 0.5) / (totals.get(0, 0) + 1))
    spread = F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
    best = counts.select("term", odds.alias("odds"), (odds / spread).alias("z")).filter((F.col("odds") >= ODDS) & (F.col("z") >= DEVIATION))
    learned = {r["term"]: r["odds"] for r in best.orderBy(F.desc("z"), "term").limit(ENTRIES).collect()}
    return {**dict.fromkeys(SEEDS, 3.0), **learned}


@dataclass
class Model:
    lexicon: dict[str, float]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None


def _both_kinds(rows: DataFrame) -> bool:
    counts = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    return min(counts.get(0, 0), counts.get(1, 0)) >= LEAST


def _raw(model: Model, rows: DataFrame) -> DataFrame:
    if model.trees is None:
        return rows.withColumn("raw", F.col("hits") / (F.col("hits") + 1))
    scored = model.trees.transform(rows.withColumn("vector", array_to_vector("features")))
    return scored.withColumn("raw", vector_to_array("probability")[1]).drop("vector", "rawPrediction", "probability", "prediction")


def fit(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE) -> Model:
    """Train on ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic in (0, 1)")
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # ``sample`` ids at most, which is what is sent to every task.
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(10)))
    rows = common.kept(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id"), "labelled")
    lexicon = learn_lexicon(rows.filter("part < 4"))
    dense_rows = common.kept(features(rows.filter("part >= 4"), lexicon, keep=("doc_id", "toxic", "part")), "training")
    model = Model(lexicon, None, None)
    training = dense_rows.filter("part < 8")
    if _both_kinds(training):
        learner = GBTClassifier(featuresCol="vector", labelCol="toxic", maxDepth=4, maxIter=24, stepSize=0.2, seed=6)
        model.trees = learner.fit(training.withColumn("vector", array_to_vector("features")))
        rest = _raw(model, dense_rows.filter("part >= 8"))
        if _both_kinds(rest):
            model.calibration = IsotonicRegression(featuresCol="raw", labelCol="toxic").fit(rest)
    return model


def score(model: Model, docs: DataFrame, *, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", name: str = "score") -> DataFrame:
    """``keep`` and the score, called ``name``, of every row. Columns of ``docs`` may have any names."""
    own = [f"kept_{i}" for i in range(len(keep))]
    quoted = [F.col("`" + column.replace("`", "``") + "`") for column in (*keep, text_col)]
    slim = docs.select(*(column.alias(k) for column, k in zip(quoted, [*own, "text"], strict=True)))
    rows = _raw(model, features(slim, model.lexicon, keep=tuple(own)))
    if model.calibration is not None:
        rows = model.calibration.transform(rows).withColumn("raw", F.col("prediction"))
    return rows.select(*(F.col(k).alias(column) for k, column in zip(own, keep, strict=True)), F.least(F.greatest("raw", F.lit(0.0)), F.lit(1.0)).alias(name))


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, learned from labels that are not held out."""
    model = fit(docs, labels.filter(~held_out(F.col("doc_id"))))
    scored = score(model, docs)
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
