"""Quality scores by random Fourier features, ridge and isotonic calibration.

Document statistics (``STATISTICS``) are taken once from every whole text and
written. Random Fourier features turn them into a finite approximation of a
Gaussian kernel; ridge regression on these needs the normal equations only,
which every partition adds up for itself and a grouped sum puts together. Fold
4 of the training rows then calibrates the raw scores: their counts per score
bin go through pool-adjacent-violators.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldvein.llm.common import map_batches, written
from goldvein.llm.words import windows, words_of

STATISTICS = ("log_bytes log_words word_bytes digits upper lower spaces newlines symbols pipes bangs commas stops beyond_ascii "
              "distinct_words top_word repeat_3 repeat_8 words_per_line repeat_lines one_byte_words marked_words").split()
FEATURES, BINS = 256, 512


def statistics_of(text: str) -> np.ndarray:
    """The statistics of one text; all zero for one without words."""
    out = np.zeros(len(STATISTICS), np.float32)
    raw = text.encode()
    starts, ends, h = words_of(raw)
    n = len(h)
    if not n:
        return out
    data = np.frombuffer(raw, np.uint8)
    b = np.bincount(data, minlength=256)
    share = lambda s: b[list(s)].sum() / len(raw)
    counts = np.unique(h, return_counts=True)[1]
    again = lambda k: 1 - len(np.unique(windows(h, k))) / (n - k + 1) if n >= k else 0.0
    lines = [x for x in text.split("\n") if x.strip()]
    last = data[ends - 1]
    marked = ~(((last >= 97) & (last < 123)) | ((last >= 65) & (last < 91)) | ((last >= 48) & (last < 58)) | (last >= 128)
               | np.isin(last, list(b".,;:")))
    out[:] = (np.log1p(len(raw)), np.log1p(n), (ends - starts).mean(), b[48:58].sum() / len(raw), b[65:91].sum() / len(raw),
              b[97:123].sum() / len(raw), share(b" \t"), share(b"\n\r"), share(b"#*$%&<>@^~=_{}[]\\/+"), share(b"|"), share(b"!?"),
              share(b",;:"), share(b"."), b[128:].sum() / len(raw), len(counts) / n, counts.max() / n, again(3), again(8),
              np.log1p(n / max(1, len(lines))), 1 - len(set(lines)) / max(1, len(lines)), (ends - starts == 1).mean(), marked.mean())
    return out


def document_statistics(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns in ``carry`` and ``x`` (array<float>, in the order of STATISTICS)."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), *[F.col(f"`{c}`") for c in carry],
                       F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("_t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [statistics_of(t) for t in b.column("_t").to_pylist()]
            flat = pa.array(np.concatenate(x) if x else np.zeros(0, np.float32), pa.float32())
            offsets = pa.array(np.arange(len(x) + 1) * len(STATISTICS), pa.int32())
            yield pa.record_batch([*[b.column(c) for c in ("doc_id", *carry)], pa.ListArray.from_arrays(offsets, flat)],
                                  names=["doc_id", *carry, "x"])

    schema = rows.drop("_t").schema.add("x", T.ArrayType(T.FloatType()))
    return map_batches(rows, run, schema, arrow=True)


def fold(doc_id: str | Column, folds: int) -> Column:
    return F.pmod(F.crc32(F.col(f"`{doc_id}`").cast("string") if isinstance(doc_id, str) else doc_id.cast("string")), F.lit(folds))


def labels_of(labels: DataFrame, column: str, doc_id: str = "doc_id") -> DataFrame:
    """doc_id, y: the mean label of each document, rounded; nulls say nothing."""
    y = F.avg(F.col(f"`{column}`").cast("double"))
    return (labels.where(F.col(f"`{doc_id}`").isNotNull() & F.col(f"`{column}`").isNotNull())
            .groupBy(F.col(f"`{doc_id}`").cast("long").alias("doc_id")).agg((y >= 0.5).cast("double").alias("y")))


def summed(rows: DataFrame, partial, width: int) -> np.ndarray:
    """The sum over partitions of ``partial(list of pandas frames) -> matrix``
    with ``width`` columns. Each partition sends its matrix by row; a matrix
    row's sums meet in one group, of one row per partition."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for pdf in batches:
            if len(pdf):
                m = partial(pdf)
                total = m if total is None else total + m
        if total is not None:
            yield pd.DataFrame({"i": np.arange(len(total)), "v": list(total)})

    def add(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": [key[0]], "v": [np.sum(np.stack(pdf["v"].to_list()), axis=0)]})

    schema = "i long, v array<double>"
    got = rows.mapInPandas(run, schema).groupBy("i").applyInPandas(add, schema).collect()
    if not got:
        return np.zeros((0, width))
    out = np.zeros((1 + max(r["i"] for r in got), width))
    for r in got:
        out[r["i"]] = r["v"]
    return out


class Kernel:
    """Standardised statistics -> random Fourier features of a Gaussian kernel."""

    def __init__(self, moments: np.ndarray, features: int = FEATURES, bandwidth: float = 0.6, seed: int = 3):
        n, s, ss = moments[0, 0], moments[1], moments[2]
        self.mean = s / n
        self.sd = np.sqrt(np.maximum(ss / n - self.mean**2, 1e-9))
        r = np.random.default_rng(seed)
        d = len(s)
        self.w = r.standard_normal((d, features)) / (bandwidth * np.sqrt(d))
        self.b = r.uniform(0, 2 * np.pi, features)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.sd, -6, 6)
        # Linear terms and a constant beside the kernel: scores stay ordered far from the training rows.
        return np.concatenate([np.cos(z @ self.w + self.b) * np.sqrt(2 / len(self.b)), 0.1 * z, np.ones((len(z), 1))], axis=1)


def matrix(pdf: pd.DataFrame) -> np.ndarray:
    return np.stack(pdf["x"].to_list()).astype(np.float64)


def isotonic(at: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over rows sorted by ``at``: block centres, values."""
    blocks: list[list[float]] = []
    for a, v, k in zip(at, y, w, strict=True):
        blocks.append([a * k, v * k, k])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last, strict=True)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def fit_quality(train: DataFrame, ridge: float = 1e-3):
    """train: written rows (doc_id, x, y, part), part 4 for calibration.
    Returns a function statistics -> scores from 0 to 1."""
    d = len(STATISTICS)
    fit_rows = train.where("part != 4").select("x", "y")

    def moments(pdf: pd.DataFrame) -> np.ndarray:
        x = matrix(pdf)
        return np.stack([np.full(d, float(len(x))), x.sum(axis=0), (x * x).sum(axis=0)])

    total = summed(fit_rows, moments, d)
    if not len(total):
        return lambda x: np.full(len(x), 0.5)
    kernel = Kernel(total)

    def normal_equations(pdf: pd.DataFrame) -> np.ndarray:
        p = kernel(matrix(pdf))
        return p.T @ np.concatenate([p, pdf["y"].to_numpy(np.float64)[:, None]], axis=1)

    width = FEATURES + d + 2
    g = summed(fit_rows, normal_equations, width)
    n = total[0, 0]
    weights = np.linalg.solve(g[:, :-1] + ridge * n / len(g) * np.eye(len(g)), g[:, -1])
    raw = lambda x: np.clip(kernel(x) @ weights, -0.5, 1.5)

    def binned(pdf: pd.DataFrame) -> np.ndarray:
        s = raw(matrix(pdf))
        k = np.minimum(((s + 0.5) / 2 * BINS).astype(int), BINS - 1)
        return np.stack([np.bincount(k, minlength=BINS, weights=v) for v in (np.ones(len(s)), s, pdf["y"].to_numpy(float))], axis=1)

    bins = summed(train.where("part = 4").select("x", "y"), binned, 3)
    bins = bins[bins[:, 0] > 0] if len(bins) else bins
    if not len(bins):
        return lambda x: np.clip(raw(x), 0, 1)
    # A tenth of a document of the overall mean in each bin keeps end blocks off exactly 0 and 1.
    mean = bins[:, 2].sum() / bins[:, 0].sum()
    at, value = isotonic(bins[:, 1] / bins[:, 0], (bins[:, 2] + 0.1 * mean) / (bins[:, 0] + 0.1), bins[:, 0])
    # A small share of the raw score keeps the order within a block.
    return lambda x: 0.99 * np.interp(raw(x), at, value) + 0.01 * np.clip(raw(x), 0, 1)


def quality_scores(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality",
                   folds: int = 5, held_out: int = 0, threshold: float = 0.3, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: doc_id, the columns in ``carry``, held_out, score (0 to 1), predicted (0 or 1).

    Labels are learned from documents whose crc32(doc_id) mod ``folds`` is not
    ``held_out``. A null or empty text has zero statistics and is scored as
    such; a null doc_id is scored, never learned from, and not held out. Repeated rows are scored
    each; without any label to learn from all scores are 0.5. Other columns
    are ignored; an empty table gives an empty result.
    """
    stats = written(document_statistics(docs, text, doc_id, carry), "document-statistics")
    part = fold("doc_id", folds)
    train = written(stats.where(part != held_out).join(labels_of(labels, label), "doc_id")
                    .withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(5))), "quality-training")
    return apply_scores(stats, fit_quality(train), part == held_out, threshold, carry)


def apply_scores(stats: DataFrame, model, held_out: Column, threshold: float, carry: tuple[str, ...] = ()) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield pdf.drop(columns="x").assign(score=np.clip(model(matrix(pdf)), 0.0, 1.0))

    rows = stats.select("doc_id", *carry, F.coalesce(held_out, F.lit(False)).alias("held_out"), "x")
    scored = rows.mapInPandas(run, rows.drop("x").schema.add("score", T.DoubleType()))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
