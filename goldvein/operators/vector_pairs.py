"""Pairs of similar vectors, exact, by matrix products of blocks.

Vectors are scaled to length one and sorted by the nearest of a number of pivots
and their angle to it, so that neighbours in the order are near each other. The
sorted vectors are cut into *bunches* (what one task holds of one side) and
these into *blocks*, each a matrix with its centre and the largest angle to it.
Pairs of bunches, then pairs of blocks, are skipped where centres and angles
rule out every pair of vectors; of the others, one matrix product gives all
cosines at once. No pair of rows is ever joined: what is exchanged is blocks,
each once per bunch that its bunch is compared with.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldvein.session import cut_to_table

# Executors get the functions with their code; they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Vectors of a block; bytes of a bunch's matrices.
BLOCK_ROWS, BUNCH_BYTES = 512, 16 << 20
#: Pivots: the root of the number of vectors, within these bounds.
LEAST_PIVOTS, MOST_PIVOTS = 32, 2048
#: Angles are widened by this much, far more than their arithmetic can lose.
SLACK = 1e-6


def unit_rows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Vectors scaled to length one; null, zero and not finite ones drop out, one of another length fails."""
    for b in batches:
        sizes = b.column("v").value_lengths().to_numpy(zero_copy_only=False)
        if (sizes != length).any():
            raise ValueError(f"a vector has {int(sizes[sizes != length][0])} numbers, the first one {length}")
        x = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, length)
        norm = np.sqrt(np.einsum("ij,ij->i", x, x))
        keep = np.isfinite(norm) & (norm > 0)
        x = x[keep] / norm[keep, None]
        yield pa.record_batch([b.column("k").filter(pa.array(keep)), pa.array([r.tobytes() for r in x], pa.binary())], names=["k", "v"])


def nearest_pivot(batches: Iterator[pa.RecordBatch], pivots: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(k, home, angle, v): the nearest pivot and the angle to it."""
    for b in batches:
        if not b.num_rows:
            continue
        dots = np.frombuffer(b"".join(b.column("v").to_pylist())).reshape(b.num_rows, -1) @ pivots.T
        home = dots.argmax(axis=1)
        angle = np.arccos(np.clip(dots[np.arange(len(home)), home], -1, 1))
        yield pa.record_batch([b.column("k"), pa.array(home.astype(np.int32)), pa.array(angle), b.column("v")], names=["k", "home", "angle", "v"])


def ball(x: np.ndarray) -> tuple[np.ndarray, float]:
    """A direction and the largest angle of the rows to it."""
    centre = x.sum(axis=0)
    norm = np.sqrt(centre @ centre)
    centre = centre / norm if norm > 0 else x[0]
    return centre, float(np.arccos(np.clip((x @ centre).min(), -1, 1))) + SLACK


def apart(centre_a: np.ndarray, angle_a: float, centre_b: np.ndarray, angle_b: float, limit: float) -> bool:
    """Whether no vector of one ball is within ``limit`` of one of the other."""
    return math.acos(min(1.0, max(-1.0, float(centre_a @ centre_b)))) - angle_a - angle_b > limit + SLACK


def blocks(rows: DataFrame, kind: str) -> DataFrame:
    """Sorted (k, v) partitions, a bunch each -> (bunch, block, keys, matrix, centre, angle)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bunch, block, held = TaskContext.get().partitionId(), 0, []

        def out(part: pa.Table) -> pa.RecordBatch:
            data = b"".join(part.column("v").to_pylist())
            centre, angle = ball(np.frombuffer(data).reshape(part.num_rows, -1))
            keys = part.column("k").combine_chunks()
            return pa.record_batch([pa.array([bunch]), pa.array([block], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
                                    pa.array([data], pa.binary()), pa.array([centre.tobytes()], pa.binary()), pa.array([angle])],
                                   names=["bunch", "block", "keys", "matrix", "centre", "angle"])

        for b in batches:
            held.append(b.select(["k", "v"]))
            while sum(x.num_rows for x in held) >= BLOCK_ROWS:
                t = pa.Table.from_batches(held)
                yield out(t.slice(0, BLOCK_ROWS))
                block, held = block + 1, t.slice(BLOCK_ROWS).to_batches()
        if sum(x.num_rows for x in held):
            yield out(pa.Table.from_batches(held))

    return rows.mapInArrow(run, f"bunch long, block int, keys array<{kind}>, matrix binary, centre binary, angle double")


def bunch_balls(parts: DataFrame) -> DataFrame:
    """(bunch, centre, angle) around all blocks of a bunch."""
    def run(table: pa.Table) -> pa.Table:
        c = np.stack([np.frombuffer(x) for x in table.column("centre").to_pylist()])
        centre, _ = ball(c)
        angles = np.arccos(np.clip(c @ centre, -1, 1)) + table.column("angle").to_numpy()
        return pa.table({"bunch": table.column("bunch")[:1], "centre": pa.array([centre.tobytes()], pa.binary()), "angle": [float(angles.max()) + SLACK]})

    return parts.select("bunch", "centre", "angle").groupBy("bunch").applyInArrow(run, "bunch long, centre binary, angle double")


def near_bunches(balls: DataFrame, n: int, limit: float) -> DataFrame:
    """(a, b), a <= b: pairs of bunch numbers, each once, that aren't apart. A
    bunch's ball goes to every pair it takes part in."""
    pairs = balls.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))))
    pairs = pairs.select(F.least("bunch", "other").alias("a"), F.greatest("bunch", "other").alias("b"), "bunch", "centre", "angle")

    def run(table: pa.Table) -> pa.Table:
        c, angle = [np.frombuffer(x) for x in table.column("centre").to_pylist()], table.column("angle").to_pylist()
        if len(c) == 2 and apart(c[0], angle[0], c[1], angle[1], limit) or table["a"][0] != table["b"][0] and len(c) < 2:
            return table.select(["a", "b"]).slice(0, 0)
        return table.select(["a", "b"]).slice(0, 1)

    return pairs.groupBy("a", "b").applyInArrow(run, "a long, b long")


def products(a: pa.Table, b: pa.Table, same: bool, threshold: float) -> Iterator[tuple[pa.Array, pa.Array, np.ndarray]]:
    """(keys, keys, cosines) of the pairs above the threshold between the
    blocks of two bunches, or within one."""
    limit = math.acos(max(-1.0, min(1.0, threshold)))

    def unpack(t: pa.Table) -> list[tuple]:
        t = t.sort_by("block")
        return [(k.values, np.frombuffer(m).reshape(len(k), -1), np.frombuffer(c), r)
                for k, m, c, r in zip(t["keys"], t["matrix"].to_pylist(), t["centre"].to_pylist(), t["angle"].to_pylist(), strict=True)]

    left = unpack(a)
    right = left if same else unpack(b)
    for i, (ka, x, ca, ra) in enumerate(left):
        for j, (kb, y, cb, rb) in enumerate(right):
            if same and j < i or (not same or i != j) and apart(ca, ra, cb, rb, limit):
                continue
            dots = x @ y.T
            hit = dots > threshold
            if same and i == j:
                hit = np.triu(hit, 1)
            p, q = np.nonzero(hit)
            if len(p):
                yield ka.take(pa.array(p)), kb.take(pa.array(q)), dots[p, q]


def similar_vectors(vectors: DataFrame, key: str, vector: str, threshold: float) -> DataFrame:
    """(key_a, key_b, cosine) for keys a < b with cosine > threshold.

    Null, zero and not finite vectors have no cosine and drop out; vectors of
    unequal length fail; of a repeated key, rows do not pair with each other.
    The pivots (those of the smallest key hashes) and the cut into blocks
    only decide how much work is saved, never what is found.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[key].dataType.simpleString()
    result = f"{key}_a {kind}, {key}_b {kind}, cosine double"
    v = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).alias("k"), v.alias("v")).where(F.col("k").isNotNull() & F.col("v").isNotNull())
    first = rows.select(F.size("v").alias("n")).first()
    if first is None or not first["n"]:
        return spark.createDataFrame([], result)
    length = first["n"]
    unit = cut_to_table(rows.mapInArrow(lambda it: unit_rows(it, length), f"k {kind}, v binary"), "unit_vectors")
    n = unit.count()
    most = min(MOST_PIVOTS, max(LEAST_PIVOTS, math.isqrt(n)))
    chosen = [np.frombuffer(r["v"]) for r in unit.orderBy(F.xxhash64("k"), "k").limit(most).collect()]
    if not chosen:
        return spark.createDataFrame([], result)
    pivots = spark.sparkContext.broadcast(np.stack(chosen))
    homes = unit.mapInArrow(lambda it: nearest_pivot(it, pivots.value), f"k {kind}, home int, angle double, v binary")
    bunches = max(1, math.ceil(n * length * 8 / BUNCH_BYTES))
    by = ["home", "angle", "k"]
    parts = cut_to_table(blocks(homes.repartitionByRange(bunches, *by).sortWithinPartitions(*by), kind), "vector_blocks")
    near = near_bunches(bunch_balls(parts), bunches, math.acos(max(-1.0, min(1.0, threshold))))
    near = cut_to_table(near, "near_bunches")
    left = near.join(parts.withColumnRenamed("bunch", "a"), "a")
    other = parts.select(*[F.col(c).alias(c) for c in parts.columns]).withColumnRenamed("bunch", "right_b")
    right = near.where("a != b").select(F.col("a").alias("right_a"), F.col("b").alias("right_b")).join(other, "right_b")

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        same = a["a"][0].as_py() == a["b"][0].as_py()
        found = [pa.table({f"{key}_a": x, f"{key}_b": y, "cosine": c}) for x, y, c in products(a, b, same, threshold)]
        none = a["keys"].type.value_type
        schema = pa.schema([(f"{key}_a", none), (f"{key}_b", none), ("cosine", pa.float64())])
        return pa.concat_tables(found) if found else schema.empty_table()

    pairs = left.groupBy("a", "b").cogroup(right.groupBy("right_a", "right_b")).applyInArrow(run, result)
    a, b = F.col(f"{key}_a"), F.col(f"{key}_b")
    return pairs.where(a != b).select(F.least(a, b).alias(f"{key}_a"), F.greatest(a, b).alias(f"{key}_b"), "cosine")
