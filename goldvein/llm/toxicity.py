"""Toxicity scores by weak supervision.

1. *Terms.* A bounded sample of the labelled training rows shows which words
   and word beginnings go with toxic documents.
2. *Voters.* These terms are dealt over ``GROUPS`` lexicon voters (whole words)
   and ``GROUPS`` pattern voters (word beginnings); two more hold a fixed list
   of insults and its density. Each votes on every whole text.
3. *Label model.* The first and second moments of the votes over all documents,
   summed by partition, give each voter's accuracy (triplets of voters that
   agree as independent ones do) and the correlations that the accuracies
   leave unexplained, by which voters share their weight.
4. *Classifier.* A sparse linear model over hashed words and word beginnings
   learns the label model's posteriors, and scores every whole text.

The labels themselves choose terms, give the share of toxic documents and set
scale and shift of the final score; what the classifier learns from are the
posteriors. The sample is bounded per label, so its rows count as many times as
they stand for training rows of their label, and the score keeps the table's own
share of toxic documents.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldvein.llm.common import map_batches, shipped, written
from goldvein.llm.quality_classifier import fold, labels_of, summed
from goldvein.llm.words import words_of

#: Labelled rows that terms and the classifier are learned from at most, of each label: those with the smallest hashes of their ids.
SAMPLE_TOXIC, SAMPLE_CLEAN = 3000, 6000
#: Terms kept at most, and documents that must show one (and a hundredth of the toxic ones).
TERMS, SUPPORT = 3000, 5
GROUPS = 6
PREFIXES = (4, 5, 6)

#: Common English insults.
INSULTS = "idiot moron stupid loser scum trash worthless pathetic disgusting clown dumb imbecile filth vermin jerk".split()


def features_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and of the beginnings of the words of a text (places repeat)."""
    _, _, h, *heads = words_of(text, letters=True, prefixes=PREFIXES)
    heads = np.concatenate(heads)
    return h, heads[heads != 0]


def insult_hashes() -> np.ndarray:
    return words_of(" ".join(INSULTS), letters=True)[2]


class Voters:
    """words, beginnings: sorted arrays of term hashes; a term's voter is its hash mod GROUPS."""

    def __init__(self, words: np.ndarray, beginnings: np.ndarray):
        self.words, self.beginnings, self.insults = np.sort(words), np.sort(beginnings), np.sort(insult_hashes())
        self.count = 2 * GROUPS + 2

    def __call__(self, text: str) -> int:
        """A bit set of the voters that say toxic."""
        h, heads = features_of(text)
        bits = 0
        for terms, found, first in ((self.words, h, 0), (self.beginnings, heads, GROUPS)):
            for g in np.unique(member(found, terms) % np.uint64(GROUPS)):
                bits |= 1 << (first + int(g))
        hits = len(member(h, self.insults))
        return bits | (hits > 0) << 2 * GROUPS | (hits > 1 and 200 * hits >= len(h)) << (2 * GROUPS + 1)


def member(x: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """The elements of x that are among the sorted terms."""
    if not len(terms) or not len(x):
        return x[:0]
    return x[terms[np.minimum(np.searchsorted(terms, x), len(terms) - 1)] == x]


class LabelModel:
    """Voters' hit and false-alarm rates from moments of unlabelled votes."""

    def __init__(self, moments: np.ndarray, share: float):
        """moments: sums over documents of votes, 1 and silence (row 0) and of products of votes (rows 1...)."""
        k = moments.shape[1] - 2
        n = moments[0, k]
        mean = moments[0, :k] / n
        cov = moments[1:, :k] / n - np.outer(mean, mean)
        self.share = share
        gap = np.full(k, np.nan)  # P(vote | toxic) - P(vote | clean)
        for i in range(k):
            got = [cov[i, j] * cov[i, m] / cov[j, m] for j in range(k) for m in range(j + 1, k)
                   if i not in (j, m) and min(cov[i, j], cov[i, m], cov[j, m]) > 1e-7]
            if got:
                gap[i] = np.sqrt(np.median(got) / (share * (1 - share)))
        self.used = ~np.isnan(gap) & (mean > 0)
        gap = np.where(self.used, gap, 0)
        # Rates have to be probabilities that explain how often the voter votes.
        alarm = np.clip(mean - share * gap, 1e-4, 0.5)
        hit = np.clip((mean - (1 - share) * alarm) / share, alarm, 0.98)
        rest = cov - share * (1 - share) * np.outer(hit - alarm, hit - alarm)
        spread = hit * (1 - hit) * share + alarm * (1 - alarm) * (1 - share)
        self.correlation = np.where(np.outer(self.used, self.used), np.clip(rest / np.sqrt(np.outer(spread, spread)), 0, 1), 0)
        np.fill_diagonal(self.correlation, 0)
        self.evidence = np.where(self.used, np.log(hit / alarm), 0)
        # A text on which nobody votes speaks for clean, by how many such texts there are beyond the clean ones.
        silent, clean_silent = moments[0, k + 1] / n, np.prod(1 - alarm)
        missed = np.clip((silent - (1 - share) * clean_silent) / share, 0.02, 1.0)
        self.silence = float(np.log(missed / clean_silent))
        self.hit, self.alarm = hit, alarm

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """votes: (documents, voters) of 0 and 1. A voter that says nothing
        abstains; those that speak up together share weight by their correlation."""
        z = np.log(self.share / (1 - self.share)) + (votes * self.evidence / (1 + votes @ self.correlation)).sum(axis=1)
        z = np.where((votes * self.used).any(axis=1), z, z + self.silence)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def unpacked(bits: np.ndarray, count: int) -> np.ndarray:
    return ((bits[:, None] >> np.arange(count)[None]) & 1).astype(np.float64)


class Sparse:
    """Logistic regression on the presence of hashed features, with an L1
    penalty and weights of at least 0 (nothing makes up for an insult, and long
    texts don't add up to innocence), by accelerated proximal steps; the constant is free."""

    def __init__(self, names: np.ndarray, lists: list[np.ndarray], y: np.ndarray, weight: np.ndarray, penalty: float = 1e-4, steps: int = 300):
        """names: sorted features; lists: per document, the places in it of
        those it shows; weight: per document, how much it counts (1 on average)."""
        n, k = max(1, len(lists)), len(names)
        row = np.repeat(np.arange(len(lists), dtype=np.int32), [len(x) for x in lists])
        col = np.concatenate(lists) if lists else np.zeros(0, np.int32)
        mean = np.average(y, weights=weight) if len(y) else 0.5
        w, b = np.zeros(k), float(np.log((mean + 1e-3) / (1 - mean + 1e-3)))
        # Steps per feature by how rare it is, all of them by how many a document shows.
        per_doc = np.bincount(row, minlength=n).max() if len(row) else 1
        rate = 4.0 / max(1.0, 0.05 * per_doc)
        scale = np.minimum(n / np.maximum(np.bincount(col, weights=weight[row], minlength=k), 1.0), 50.0)
        z, t, v = w.copy(), 1.0, b
        for _ in range(steps if k else 0):
            s = np.bincount(row, weights=z[col], minlength=n) + v
            e = weight * (1 / (1 + np.exp(-np.clip(s, -30, 30))) - y) / n
            g = np.bincount(col, weights=e[row], minlength=k)
            step = rate * scale
            new = np.maximum(z - step * g - step * penalty, 0)
            u = (1 + np.sqrt(1 + 4 * t * t)) / 2
            if ((z - new) * (new - w)).sum() > 0:
                u = 1.0  # restart
            z, w, t = new + (t - 1) / u * (new - w), new, u
            v -= rate * e.sum()
        self.scores = np.bincount(row, weights=w[col], minlength=n) + v
        on = w > 1e-6
        self.names, self.weights, self.constant = names[on], w[on], v

    def calibrate(self, y: np.ndarray, weight: np.ndarray) -> None:
        """Scale and shift of the linear score by Newton steps on known labels
        (Platt's targets), so that a threshold on the score means a probability."""
        z, hits = self.scores, y.sum()
        y = np.where(y > 0, (hits + 1) / (hits + 2), 1 / (len(y) - hits + 2))
        x, p = np.stack([z, np.ones(len(z))], axis=1), np.array([1.0, 0.0])
        for _ in range(30):
            q = 1 / (1 + np.exp(-np.clip(x @ p, -30, 30)))
            p = p - 0.7 * np.linalg.solve((x * (weight * q * (1 - q))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (weight * (q - y)))
        if p[0] > 0:
            self.weights, self.constant = self.weights * p[0], self.constant * p[0] + p[1]

    def linear(self, found: np.ndarray) -> float:
        """found: distinct features."""
        s = self.constant
        if len(self.names) and len(found):
            at = np.minimum(np.searchsorted(self.names, found), len(self.names) - 1)
            s += self.weights[at][self.names[at] == found].sum()
        return s

    def score_text(self, text: str) -> float:
        h, heads = features_of(text)
        s = self.linear(np.unique(member(np.concatenate([h, heads]), self.names)))
        return float(1 / (1 + np.exp(-np.clip(s, -30, 30))))


def sample_rows(docs: DataFrame, labels: DataFrame, part: int, folds: int) -> DataFrame:
    """(doc_id, t, y) of the sampled training rows; the ids are a bounded list, so they are broadcast."""
    ids = labels.where(fold("doc_id", folds) != part)
    picked = [ids.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
              for y, n in ((1.0, SAMPLE_TOXIC), (0.0, SAMPLE_CLEAN))]
    return docs.join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id").dropDuplicates(["doc_id"])


def row_weights(y: np.ndarray, known: dict[float, int]) -> np.ndarray:
    """How much each sampled row counts, 1 on average, by the training rows of
    its label (``known``) per row that may be sampled of it."""
    toxic, clean = (max(1.0, known.get(label, 0) / n) for label, n in ((1.0, SAMPLE_TOXIC), (0.0, SAMPLE_CLEAN)))
    w = np.where(y > 0, toxic, clean)
    return w / w.mean() if len(w) else w


def sample_features(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w, p = [], []
            for t in b.column("t").to_pylist():
                h, heads = features_of(t)
                w.append(np.unique(h).view(np.int64))
                p.append(np.unique(heads).view(np.int64))
            yield pa.record_batch([b.column("doc_id"), b.column("t"), b.column("y"), *[pa.array(x, pa.list_(pa.int64())) for x in (w, p)]],
                                  names=["doc_id", "t", "y", "words", "beginnings"])

    return map_batches(rows, run, "doc_id long, t string, y double, words array<long>, beginnings array<long>", arrow=True)


def telling_terms(rows: DataFrame, column: str, toxic: int, clean: int) -> np.ndarray:
    """The terms most in favour of the toxic label, by smoothed log odds of
    the documents that show them; at most TERMS of them."""
    terms = rows.select("y", F.explode(column).alias("term")).groupBy("term").agg(
        F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("q"))
    odds = F.log(((F.col("p") + 0.5) / (toxic + 1)) / ((F.col("q") + 0.5) / (clean + 1)))
    best = terms.where((F.col("p") >= max(SUPPORT, 0.01 * toxic)) & (odds > 4)).orderBy(odds.desc(), F.col("p").desc(), "term").limit(TERMS)
    return np.array([r["term"] for r in best.select("term").collect()], np.int64).view(np.uint64)


def known_features(sample: DataFrame) -> np.ndarray:
    """Sorted features that SUPPORT documents of the bounded sample show."""
    terms = sample.select(F.explode(F.concat("words", "beginnings")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    kept = terms.where(F.col("n") >= SUPPORT).select("term").toPandas()["term"]
    return np.sort(kept.to_numpy(np.int64).view(np.uint64))


def training_rows(sample: DataFrame, names: np.ndarray, voters: Voters) -> pd.DataFrame:
    """Of the bounded sample: y, votes, and ``at``, the places in names of the features shown (32-bit integers)."""
    cast = sample.sparkSession.sparkContext.broadcast(shipped((names, voters)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, vote = pickle.loads(cast.value)
        for b in batches:
            at, votes = [], []
            for t in b.column("t").to_pylist():
                x = np.unique(np.concatenate(features_of(t)))
                at.append(np.searchsorted(known, member(x, known)).astype(np.int32).tobytes())
                votes.append(vote(t))
            yield pa.record_batch([b.column("y"), pa.array(votes, pa.int64()), pa.array(at, pa.binary())], names=["y", "votes", "at"])

    return map_batches(sample.select("t", "y"), run, "y double, votes long, at binary", arrow=True).toPandas()


def toxicity_scores(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic",
                    folds: int = 3, held_out: int = 1, threshold: float = 0.7) -> DataFrame:
    """One row per input row: doc_id, held_out, score (0 to 1), predicted (0
    or 1).

    Labels come from documents whose crc32(doc_id) mod ``folds`` is not
    ``held_out``, at most SAMPLE_TOXIC and SAMPLE_CLEAN of them, weighted back to
    the numbers of all such documents. Null and empty texts have no
    features and get the constant's score; a null doc_id is scored, never
    learned from, and not held out. Repeated rows are scored each. Without
    labels of both kinds the fixed insults alone make the score (0.9 with a
    hit, else 0.1). Other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("t"))
    sample = written(sample_features(sample_rows(rows, labels_of(labels, label, doc_id), held_out, folds)), "toxicity-sample")
    seen = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = seen.get(1.0, 0), seen.get(0.0, 0)
    both = toxic > 0 and clean > 0
    none = np.zeros(0, np.uint64)
    voters = Voters(*[telling_terms(sample, c, toxic, clean) if both else none for c in ("words", "beginnings")])
    cast = spark.sparkContext.broadcast(shipped(voters))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = pickle.loads(cast.value)
        for b in batches:
            yield pa.record_batch([b.column("doc_id"), pa.array([v(t) for t in b.column("t").to_pylist()], pa.int64())],
                                  names=["doc_id", "votes"])

    votes = written(map_batches(rows, vote, "doc_id long, votes long", arrow=True), "toxicity-votes")
    model, net = None, None
    if both:
        count = voters.count

        def moments(pdf: pd.DataFrame) -> np.ndarray:
            v = unpacked(pdf["votes"].to_numpy(np.int64), count)
            v1 = np.concatenate([v, np.ones((len(v), 1)), ~v.any(axis=1, keepdims=True)], axis=1)
            return np.concatenate([v1.sum(axis=0)[None], v.T @ v1])

        training = labels_of(labels, label, doc_id).where(fold("doc_id", folds) != held_out)
        known = {r["y"]: r["n"] for r in training.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
        share = known.get(1.0, 0) / sum(known.values())
        model = LabelModel(summed(votes, moments, count + 2), float(np.clip(share, 0.005, 0.5)))
        names = known_features(sample)
        got = training_rows(sample, names, voters)
        given = model.posterior(unpacked(got["votes"].to_numpy(np.int64), count))
        y = got["y"].to_numpy(np.float64)
        weight = row_weights(y, known)
        net = Sparse(names, [np.frombuffer(x, np.int32) for x in got["at"]], given, weight)
        net.calibrate(y, weight)
        del net.scores
    fitted = spark.sparkContext.broadcast(shipped((model, net)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, (_, linear) = pickle.loads(cast.value), pickle.loads(fitted.value)
        for b in batches:
            texts = b.column("t").to_pylist()
            if linear is None:
                s = [0.9 if len(member(features_of(t)[0], v.insults)) else 0.1 for t in texts]
            else:
                s = [linear.score_text(t) for t in texts]
            yield pa.record_batch([b.column("doc_id"), pa.array(s, pa.float64())], names=["doc_id", "score"])

    out = map_batches(rows, score, "doc_id long, score double", arrow=True)
    return out.select("doc_id", F.coalesce(fold("doc_id", folds) == held_out, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
