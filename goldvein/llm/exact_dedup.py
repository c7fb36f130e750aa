"""Exact duplicates by a tree merge of sorted digest runs.

Every input partition makes one run of digests per slice of the digest
space. Runs are then merged in binomial rounds: in each round, the runs whose
numbers agree after dropping the last ``log2(fan_in)`` bits are exchanged to
one task, which merges them in digest order and keeps, per digest, one
verified identifier and the number of rows behind it. After
``log_fan_in(partitions)`` rounds one run is left per slice, and documents
look their digest up in it.

A group of equal texts has at most one row per run, so a text held by a
third of all rows is no larger than any other in every round. Slices bound
what one task merges: a slice is ``1 / slices`` of the distinct digests,
whichever round it is.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldvein.llm.common import map_batches, written

#: What must agree before two rows count as equal: SHA-256, and as a check on it length in bytes and a second hash.
IDENTITY = ["digest", "n_bytes", "check"]
RUN = "slice int, run long, digest binary, n_bytes long, check long, keep_id long, group_size long"


def merge_runs(batches: Iterator[pd.DataFrame], largest: bool = True) -> Iterator[pd.DataFrame]:
    """Merge neighbouring rows of equal identity. Input comes sorted by
    (slice, run, identity); state is one open row, so memory is a batch."""
    pick = "max" if largest else "min"
    by = ["slice", "run", *IDENTITY]
    open_row: pd.DataFrame | None = None
    for pdf in batches:
        if open_row is not None:
            pdf = pd.concat([open_row, pdf], ignore_index=True)
        if pdf.empty:
            continue
        fresh = pd.Series(False, index=pdf.index)
        for c in by:
            fresh |= pdf[c].ne(pdf[c].shift())
        out = pdf.groupby(fresh.cumsum(), sort=False).agg(
            {**{c: "first" for c in by}, "keep_id": pick, "group_size": "sum"})
        open_row = out.iloc[-1:].reset_index(drop=True)
        if len(out) > 1:
            yield out.iloc[:-1]
    if open_row is not None:
        yield open_row


def digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, digest, n_bytes, check) per row; a null text counts as empty."""
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                       F.unhex(F.sha2(t, 256)).alias("digest"),
                       F.octet_length(t).cast("long").alias("n_bytes"), F.xxhash64(t).alias("check"))


def tree_merge(rows: DataFrame, runs: int, slices: int, fan_in: int = 8, largest: bool = True) -> DataFrame:
    """Digest runs -> one row per distinct text: identity, keep_id, group_size.
    ``rows`` is a written table with a ``run`` number per row."""
    level = rows.select(
        F.pmod(F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long"), F.lit(slices)).cast("int").alias("slice"),
        F.col("run"), *IDENTITY, F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    # The local run: one row per digest and run, combined before any row is sent.
    pick = F.max if largest else F.min
    level = level.groupBy("slice", "run", *IDENTITY).agg(
        pick("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    for _ in range(max(1, math.ceil(math.log(max(2, runs), fan_in)))):
        level = level.withColumn("run", F.floor(F.col("run") / fan_in).cast("long"))
        level = (level.repartition(slices, "slice", "run")
                 .sortWithinPartitions("slice", "run", *IDENTITY))
        level = map_batches(level, lambda it, largest=largest: merge_runs(it, largest), RUN)
    return level.select(*IDENTITY, "keep_id", "group_size")


def exact_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", largest: bool = True,
                fan_in: int = 8, slices: int | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Equal texts are texts of equal bytes; null counts as empty. Of a group
    the row with the largest ``doc_id`` stays (the smallest with
    ``largest=False``). A repeated ``doc_id`` with one text counts every
    row, and each of its rows says kept; a null ``doc_id`` loses to any
    other, and in a group of null ids only, all are kept (keep_id null). An
    empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = written(digests(docs, text, doc_id).withColumn("run", F.spark_partition_id().cast("long")), "digest-runs")
    top = rows.agg(F.max("run")).first()[0]
    merged = tree_merge(rows, runs=1 + (top or 0), slices=slices, fan_in=fan_in, largest=largest)
    out = rows.join(merged, IDENTITY, "left")
    return out.select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
