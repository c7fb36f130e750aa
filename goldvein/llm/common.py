"""Helpers shared by the operators: table reads, written cuts, worker state."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldvein.session import scratch_path

#: Words are runs of characters other than ASCII white space, in every operator that counts words.
WORD_RE = r"[^\x20\x09-\x0D]+"
SPACE_RE = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to a fresh folder of the shared storage and read it
    back: every later use sees the same rows, and a lost executor costs a
    file read instead of the whole lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shipped(obj: object) -> bytes:
    """An object with the code of its class, for a broadcast: Spark pickles
    broadcast values by reference, which asks workers to have this package.
    ``pickle.loads`` gives it back anywhere."""
    return cloudpickle.dumps(obj)


def worker_state(key: str, make: Callable[[], object]) -> object:
    """An object built once per Python worker process (a tokenizer, a memo)."""
    kept = sys.__dict__.setdefault("_goldvein_worker_state", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def typed(df: DataFrame, **casts: str) -> DataFrame:
    """Only the named columns, cast, so extra input columns cannot clash."""
    return df.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in casts.items()])


def map_batches(df: DataFrame, fn: Callable[[Iterator], Iterator], schema: str | T.StructType,
                arrow: bool = False) -> DataFrame:
    """``mapInPandas`` (``mapInArrow`` with ``arrow``) over small record
    batches: Spark cuts them by rows, so few rows go into one, and very long
    texts still fit a worker."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
    return df.mapInArrow(fn, schema) if arrow else df.mapInPandas(fn, schema)


def release(df: DataFrame) -> None:
    """Let the cluster delete the shuffle files of plans that are done with:
    Spark does so when the driver collects the objects that stand for them,
    which between two large steps may otherwise take its time."""
    import gc

    for _ in range(2):
        gc.collect()
        df.sparkSession.sparkContext._jvm.System.gc()
