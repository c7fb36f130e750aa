"""Skew-safe building blocks.

A single key (an e-mail, a contact, a signature term) may hold a third of
all rows. Aggregates are safe (partial aggregation before the shuffle);
windows and self-pairings are not, because Spark gives one task a whole
window partition. The helpers here split such hot groups across tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldvein.session import cut_lineage

def row_number_within(df: DataFrame, keys: list[str], order: list[Column], name: str,
                      range_partitions: int | None = None) -> DataFrame:
    """Exact ``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order)``.

    ``order`` together with ``keys`` must be a total order (add
    tie-breakers). Rows are range-partitioned on (keys, order), so a group of
    any size spreads over as many tasks as it needs; each task numbers its
    sorted rows, and the counts of a group's earlier tasks are added. Nothing
    depends on how large a group is.
    """
    parts = range_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sort_cols = [F.col(k).asc_nulls_first() for k in keys] + list(order)
    # Materialised once: positions must be identical for both uses below.
    ranged = cut_lineage(df.repartitionByRange(parts, *sort_cols).sortWithinPartitions(*sort_cols)
                         .withColumn("_pid", F.spark_partition_id())
                         .withColumn("_pos", F.monotonically_increasing_id()))
    stats = ranged.groupBy("_pid", *keys).agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stats.select(F.col("_pid").alias("_p"), *[F.col(k).alias("_k_" + k) for k in keys], "_first",
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    cond = ranged["_pid"] == offsets["_p"]
    for k in keys:
        cond = cond & ranged[k].eqNullSafe(offsets["_k_" + k])
    number = (F.col("_pos") - F.col("_first") + 1 + F.col("_off")).cast("bigint")
    return ranged.join(offsets, cond).select(*[ranged[c] for c in df.columns], number.alias(name))


def _side(df: DataFrame, item: str, carry: list[str], suffix: str) -> list[Column]:
    return [F.col(item).alias(item + suffix)] + [F.col(c).alias(c + suffix) for c in carry]


def _out(key: str, item: str, carry: list[str]) -> list[str]:
    return [key, item + "_a", item + "_b"] + [c + s for c in carry for s in ("_a", "_b")]


def _pairs_blocked(df: DataFrame, key: str, item: str, sizes: DataFrame, block_rows: int,
                   carry: list[str]) -> DataFrame:
    nb = F.greatest(F.lit(1), F.ceil(F.col("_g") / F.lit(block_rows))).cast("int")
    tagged = (df.join(sizes, key).withColumn("_nb", nb)
              .withColumn("_blk", F.pmod(F.xxhash64(F.col(item)), F.col("_nb")).cast("int")))
    # Row in block b joins block pairs (min(b,o), max(b,o)) for every o.
    spread = tagged.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)))
    spread = spread.select(
        key, item, *carry, "_blk",
        F.least("_blk", "_other").alias("_lo"), F.greatest("_blk", "_other").alias("_hi"))
    # The pairs are quadratic in a block, not in the input's size, so the input's small size must not
    # put all blocks into one task: dealt by block pair, whose rows are bounded.
    spread = spread.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key, "_lo", "_hi")
    a = spread.select(F.col(key), F.col("_lo"), F.col("_hi"), F.col("_blk").alias("_ba"),
                      *_side(spread, item, carry, "_a"))
    b = spread.select(F.col(key).alias("_kb"), F.col("_lo").alias("_lob"), F.col("_hi").alias("_hib"),
                      F.col("_blk").alias("_bb"), *_side(spread, item, carry, "_b"))
    joined = a.join(b, (a[key] == b["_kb"]) & (a["_lo"] == b["_lob"]) & (a["_hi"] == b["_hib"]))
    # Each block pair is formed once: rows of block lo on the left, hi on
    # the right, or both in the same block when lo == hi.
    keep = (((F.col("_ba") == F.col("_lo")) & (F.col("_bb") == F.col("_hi"))) |
            ((F.col("_ba") == F.col("_hi")) & (F.col("_bb") == F.col("_lo"))))
    return (joined.where(keep & (F.col(item + "_a") < F.col(item + "_b")))
            .select(*_out(key, item, carry)))


def pairs_within_groups(df: DataFrame, key: str, item: str, block_rows: int = 2_000,
                        carry: list[str] | None = None) -> DataFrame:
    """All unordered pairs (item_a < item_b) of items sharing ``key``.

    Only used where every pair in a group is a required candidate (an
    exact signature match). A group of g items is cut into
    ceil(g / block_rows) blocks and each row is sent to the block pairs it
    takes part in, so one task never holds more than two blocks of a group and
    the quadratic output of a hot group is spread over many tasks. Columns
    named in ``carry`` come along for both items (``c_a``, ``c_b``), so a
    pair filter can run right after the join.
    """
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_g"))
    return _pairs_blocked(df, key, item, sizes, block_rows, list(carry or []))
