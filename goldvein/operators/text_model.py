"""Text labels learnt by counting: naive Bayes over hashed words and trigrams.

A text's features are its words and the character trigrams of each word
(with marks for its ends), hashed into 65,536 buckets. Training is one
aggregate: how often each bucket stands in texts of each label, added up per
partition first. Log odds are rounded to whole millionths, so sums are exact
and do not depend on the order of rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldvein.functions.scoring import SENTIMENT_CUTOFF
from goldvein.operators.enrich import PERSONA_DEFAULT, PERSONA_RULES, TOKEN_SPLIT, persona, sentiment
from goldvein.session import cut_to_table

#: Buckets are named by hex digits of an MD5 sum: 16 ** DIGITS of them.
DIGITS = 4
BUCKETS = 16 ** DIGITS
UNIT = 1_000_000
#: Log odds (in units) that a text without a keyword needs over the second label.
MARGIN = 3 * UNIT
PERSONAS = tuple(label for label, _ in PERSONA_RULES)
POLES = ("NEGATIVE", "POSITIVE")


@dataclass(frozen=True)
class TextModel:
    """``base`` is a label's own weight, ``unseen`` that of a bucket that no text
    of the label has, ``weights`` (bucket, w0, w1, ... in the order of labels)
    what is added to ``unseen`` for the others: at most 65,536 rows."""
    labels: tuple[str, ...]
    base: tuple[int, ...]
    unseen: tuple[int, ...]
    weights: DataFrame


def words(text: Column) -> Column:
    """The words of a text, lower-cased; none for a null or empty one."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), TOKEN_SPLIT), lambda w: w != "")


def word_features(word: Column) -> Column:
    """Buckets of a word and of its trigrams, as many as it has characters and one more."""
    bucket = lambda kind, x: F.substring(F.md5(F.concat(F.lit(kind), x)), 1, DIGITS)
    grams = F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: bucket(
        "c", F.substr(F.concat(F.lit("^"), word, F.lit("$")), i, F.lit(3))))
    return F.concat(F.array(bucket("w", word)), grams)


def _weight(part: int, whole: int) -> int:
    return round(UNIT * math.log(part / whole))


def train(labelled: DataFrame, text: str, label: str, labels: tuple[str, ...]) -> TextModel:
    """A model of the rows whose label is one of ``labels`` (at least two; those
    without rows have the smoothed weights only). Words are counted first, and
    each different one is cut into features once."""
    at = range(len(labels))
    hit = [F.when(F.col("label") == x, F.lit(1)).otherwise(F.lit(0)).cast("long").alias(f"n{i}") for i, x in enumerate(labels)]
    rows = labelled.select(F.col(text).alias("t"), F.col(label).alias("label")).where(F.col("label").isin(*labels))
    # The word "" counts the texts themselves, and so does the bucket "".
    own = F.col("word") == ""
    rows = rows.select(*hit, F.explode(F.concat(F.array(F.lit("")), words(F.col("t")))).alias("word"))
    vocabulary = rows.groupBy("word").agg(*[F.sum(f"n{i}").alias(f"n{i}") for i in at])
    rows = vocabulary.select(*[f"n{i}" for i in at], F.explode(F.when(own, F.array(F.lit(""))).otherwise(word_features(F.col("word")))).alias("bucket"))
    n = [F.sum(f"n{i}").alias(f"n{i}") for i in at]
    counts = cut_to_table(rows.groupBy("bucket").agg(*n), "text_model")
    own = F.col("bucket") == ""
    sums = counts.agg(*[F.coalesce(F.sum(F.when(own, F.col(f"n{i}"))), F.lit(0)).alias(f"d{i}") for i in at],
                      *[F.coalesce(F.sum(F.when(~own, F.col(f"n{i}"))), F.lit(0)).alias(f"f{i}") for i in at]).first()
    texts = sum(sums[f"d{i}"] for i in at) + len(labels)
    base = tuple(_weight(sums[f"d{i}"] + 1, texts) for i in at)
    unseen = tuple(_weight(1, sums[f"f{i}"] + BUCKETS) for i in at)
    weights = counts.where(~own).select("bucket", *[
        (F.round(F.log((F.col(f"n{i}") + 1) / F.lit(float(sums[f"f{i}"] + BUCKETS))) * UNIT).cast("long") - unseen[i])
        .alias(f"w{i}") for i in at])
    return TextModel(labels, base, unseen, weights)


def _scorer(model: TextModel, spark: SparkSession) -> Callable[[Column], Column]:
    """Words of texts -> (weights per label, n_features). The model, a row per bucket at most,
    goes to every task once as an array; a word's weights are worked out once per batch."""
    k, unseen, base = len(model.labels), model.unseen, model.base
    found = model.weights.toArrow()
    weights = np.tile(np.array(unseen, np.int64), (BUCKETS, 1))
    at = np.array([int(x, 16) for x in found.column("bucket").to_pylist()], np.int64)
    for i in range(k):
        weights[at, i] += found.column(f"w{i}").to_numpy().astype(np.int64)
    cast, digits = spark.sparkContext.broadcast(weights), DIGITS

    def score(column: pa.Array) -> pa.Array:
        bucket = lambda x: int(hashlib.md5(x.encode()).hexdigest()[:digits], 16)
        lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        ends = np.concatenate([[0], np.cumsum(np.array([len(x) for x in lists], np.int64))]).astype(np.int64)
        coded = pa.compute.dictionary_encode(lists.flatten())
        table = cast.value
        each = np.zeros((len(coded.dictionary), k + 1), np.int64)
        for i, w in enumerate(coded.dictionary.to_pylist()):
            marked = f"^{w}$"
            mine = [bucket("w" + w), *[bucket("c" + marked[c:c + 3]) for c in range(len(w))]]
            each[i, :k], each[i, k] = table[mine].sum(axis=0), len(mine)
        sums = np.zeros((len(coded) + 1, k + 1), np.int64)
        np.cumsum(each[coded.indices.to_numpy().astype(np.int64)], axis=0, out=sums[1:])
        got = sums[ends[1:]] - sums[ends[:-1]]
        per_label = pa.ListArray.from_arrays(pa.array(np.arange(len(lists) + 1, dtype=np.int32) * k), pa.array((got[:, :k] + np.array(base)).ravel()))
        return pa.StructArray.from_arrays([per_label, pa.array(got[:, k].astype(np.int32))], names=["weights", "n_features"])

    return F.arrow_udf(score, "weights array<long>, n_features int")


def classify(df: DataFrame, model: TextModel, text: str) -> DataFrame:
    """``df`` with ``label`` (of the highest weight; the earlier of equals), ``margin``
    (its lead on the second, in units), ``weights`` (per label) and ``n_features``.
    Null and empty texts have the labels' own weights. No row is moved: the
    model goes to the rows, its size does not grow with the data."""
    scored = df.withColumn("_s", _scorer(model, df.sparkSession)(words(F.col(text))))
    weight = [F.col("_s.weights")[i] for i in range(len(model.labels))]
    ranked = F.sort_array(F.array(*[F.struct(w.alias("w"), F.lit(-i).alias("o"), F.lit(x).alias("label"))
                                    for i, (w, x) in enumerate(zip(weight, model.labels, strict=True))]), asc=False)
    return scored.withColumn("_r", ranked).select(
        *df.columns, F.col("_r")[0]["label"].alias("label"), (F.col("_r")[0]["w"] - F.col("_r")[1]["w"]).alias("margin"),
        F.col("_s.weights").alias("weights"), F.col("_s.n_features").alias("n_features"))


def trained_personas(titles: DataFrame, margin: int = MARGIN) -> Callable[[DataFrame], DataFrame]:
    """A ``model=`` of contact_personas: learns from the titles that a keyword rule
    knows (job_title) and labels the others where the lead is ``margin``."""
    model = train(titles.withColumn("_rule", persona(F.col("job_title"))), "job_title", "_rule", PERSONAS)

    def score(df: DataFrame) -> DataFrame:
        rule = persona(F.col("job_title"))
        return classify(df, model, "job_title").withColumn(
            "ai_persona", F.when(rule != PERSONA_DEFAULT, rule).when(F.col("margin") >= margin, F.col("label"))
            .otherwise(PERSONA_DEFAULT)).select(*df.columns, "ai_persona")
    return score


def trained_sentiment(feedback: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """A ``model=`` of feedback_scored: learns from the texts that the lexicon calls
    positive or negative; the score is the mean log odds of a feature, squashed
    to [-1, 1] and rounded to four places. The lexicon's verdict stays where it has one."""
    s = sentiment(F.col("feedback_text"))
    pole = F.when(s > SENTIMENT_CUTOFF, "POSITIVE").when(s < -SENTIMENT_CUTOFF, "NEGATIVE")
    model = train(feedback.withColumn("_pole", pole), "feedback_text", "_pole", POLES)

    def score(df: DataFrame) -> DataFrame:
        odds = (F.col("weights")[1] - F.col("weights")[0]) / (F.greatest(F.col("n_features"), F.lit(1)) * F.lit(float(UNIT)))
        return classify(df, model, "feedback_text").withColumn(
            "sentiment_score", F.when(s != 0, s).otherwise(F.round(F.tanh(odds), 4))).select(*df.columns, "sentiment_score")
    return score
