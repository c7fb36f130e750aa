"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "goldvein", extra: dict | None = None) -> SparkSession:
    """A session with AQE on, UTC time zone, no UI.

    On a cluster the deployment supplies master, memory and
    ``spark.checkpoint.dir``; only the SQL settings here matter.
    """
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", "16g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir). Where
    neither is set, a local session (one machine) gets a private folder; on
    a cluster that is an error, since executors do not share local folders.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:   # a remote (Connect) session manages its own folder
        sc = None
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d:
        if sc is None or not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="goldvein-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder."""
    base = shared_dir(spark)
    sep = "" if base.endswith("/") else "/"
    return f"{base}{sep}goldvein/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_to_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to a fresh path in the shared folder and read
    it back: a clean cut for iterative loops (the next round starts from a
    plain file scan with file-size statistics, not from the previous
    round's plan) that also survives executor loss."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
