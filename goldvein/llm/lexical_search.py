"""Exact ranked lexical search with sparse ball trees.

A document is a sparse vector x over the terms of the searched items: x_t is
the integer that its term frequency and length give. An item scores it by the
sum of w_t * x_t over the item's terms. With both sides scaled by the root of
w_t, the score is the inner product of an item q and a document y, and for all
documents of a ball with centre c and radius r it is at most q.c + |q_S| r,
where S is the set of terms that any document of the ball holds (elsewhere
centre and documents are zero alike).

1. Texts are read once per block of items: term frequencies of the block's
   terms and the number of all terms; from these, document frequencies and
   totals over all documents.
2. Documents are sorted by their weightiest terms over all partitions, so
   documents of one subject lie together; each ``TREE_DOCS`` of them get a
   tree, split in the middle between two far points.
3. Every tree scores the leaf of the highest bound for every item. The scores,
   counted by rounded-down value over all trees, give a floor that the item's
   k-th best score is not below.
4. Every tree is searched best-first from that floor up: a subtree goes if its
   bound, rounded up, is below what k documents have. Leaves are scored in
   integers. The k best of each task are merged by rank.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from goldvein.llm.common import written

#: Bytes of item texts that are searched together; their terms go to every task.
ITEM_BYTES = 4 << 20
TREE_DOCS, TREE_ENTRIES, LEAF_DOCS = 1024, 1 << 17, 32
#: Bytes of one text that are cut into terms at a time.
PART = 1 << 20
#: Leading bits kept of a score when scores are counted for the floor.
FLOOR_BITS = 10
#: Bounds are raised by this share and by one, far more than their arithmetic can lose.
SLACK = 1e-9
#: A null doc_id comes after all others.
LAST_ID = 2**63 - 1

#: A to Z become lower case; every other byte below 128 but digits and letters parts terms.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))

TREE = "doc_ids array<long>, ends array<int>, places binary, values binary, node_lo binary, node_hi binary, radius binary"


def term_parts(text: bytes) -> Iterator[list[bytes]]:
    """The text's terms, in lists of some ``PART`` bytes."""
    data = text.translate(LETTERS)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PART)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def term_values(tf: np.ndarray, n: int, n_docs: int, n_terms: int) -> np.ndarray:
    """x of a document's terms: n terms in it, n_docs documents, n_terms terms in all."""
    m = 50 + (50 * n * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def frequencies(docs: DataFrame, terms: Broadcast, text: str, doc_id: str) -> DataFrame:
    """(doc_id, n, ids, tfs) of the documents with a term: numbers of the
    given terms in it and how often they occur."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: k for k, t in enumerate(terms.value)}
        for b in batches:
            keep, total, ids, tfs = [], [], [], []
            for k, t in enumerate(b.column("t")):
                found, n = Counter(), 0
                for part in term_parts(t.as_py()):
                    n += len(part)
                    found.update(filter(number.__contains__, part))
                if n:
                    keep.append(k)
                    total.append(n)
                    own = sorted((number[x], c) for x, c in found.items())
                    ids.append([x for x, _ in own])
                    tfs.append([c for _, c in own])
            yield pa.record_batch([b.column("doc_id").take(pa.array(keep, pa.int64())), pa.array(total, pa.int64()),
                                   pa.array(ids, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))],
                                  names=["doc_id", "n", "ids", "tfs"])

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary").alias("t"))
    return rows.mapInArrow(run, "doc_id long, n long, ids array<int>, tfs array<int>")


class Tree:
    """A ball tree over a few documents, whose rows are in the order of its
    nodes: node k holds the rows lo[k] to hi[k]; its children, if it is no
    leaf, are 2k + 1 and 2k + 2 (halves, so all places up to the last are filled)."""

    def __init__(self, ends: np.ndarray, places: np.ndarray, values: np.ndarray, weights: np.ndarray):
        self.starts, self.ends = np.concatenate([[0], ends[:-1]]).astype(np.int64), ends.astype(np.int64)
        self.values = values.astype(np.int64)
        self.terms, self.local = np.unique(places, return_inverse=True)
        self.y = self.values * np.sqrt(weights[places].astype(float))

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the rows' entries, and where each row's begin among them."""
        size = self.ends[rows] - self.starts[rows]
        begin = np.cumsum(size) - size
        return np.arange(int(size.sum())) + np.repeat(self.starts[rows] - begin, size), begin

    def dots(self, rows: np.ndarray, v: np.ndarray) -> np.ndarray:
        at, begin = self.entries(rows)
        return np.add.reduceat(self.y[at] * v[self.local[at]], begin)

    def centre(self, rows: np.ndarray) -> np.ndarray:
        at, _ = self.entries(rows)
        return np.bincount(self.local[at], weights=self.y[at], minlength=len(self.terms)) / len(rows)

    def spread(self, row: int) -> np.ndarray:
        out = np.zeros(len(self.terms))
        out[self.local[self.starts[row]:self.ends[row]]] = self.y[self.starts[row]:self.ends[row]]
        return out

    def build(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(order of the rows, lo, hi, radius per node)."""
        order = np.arange(len(self.ends))
        square = np.add.reduceat(self.y * self.y, self.starts)
        nodes, depth = [(0, len(order))], 0
        while max(hi - lo for lo, hi in nodes[(1 << depth) - 1:]) > LEAF_DOCS:
            for lo, hi in nodes[(1 << depth) - 1:]:
                rows, mid = order[lo:hi], (lo + hi) // 2
                c = self.centre(rows)
                far = rows[np.argmax(square[rows] - 2 * self.dots(rows, c))]
                from_far = square[rows] - 2 * self.dots(rows, self.spread(far))
                other = rows[np.argmax(from_far)]
                side = from_far - (square[rows] - 2 * self.dots(rows, self.spread(other)))
                order[lo:hi] = rows[np.argsort(side, kind="stable")]
                nodes += [(lo, mid), (mid, hi)]
            depth += 1
        radius = []
        for lo, hi in nodes:
            rows = order[lo:hi]
            c = self.centre(rows)
            most = (square[rows] - 2 * self.dots(rows, c)).max() + c @ c
            # What rounding can have taken from the difference is in proportion to its largest part.
            radius.append(math.sqrt(max(0.0, most) + SLACK * (square[rows].max() + c @ c)))
        lo, hi = np.array(nodes, np.int32).T
        return order, lo, hi, np.array(radius)


def with_subject(rows: DataFrame, corpus: Broadcast) -> DataFrame:
    """(doc_id, subject, ids, values): the document's three weightiest terms, and x in place of frequencies."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_docs, n_terms, weights = corpus.value
        for b in batches:
            ids, tfs = b.column("ids"), b.column("tfs")
            subject, values = [], []
            for k, n in enumerate(b.column("n").to_pylist()):
                own = ids[k].values.to_numpy()
                subject.append(own[np.lexsort((own, -weights[own]))[:3]])
                values.append(term_values(tfs[k].values.to_numpy().astype(np.int64), n, n_docs, n_terms).astype(np.int32))
            yield pa.record_batch([b.column("doc_id"), pa.array(subject, pa.list_(pa.int32())), ids, pa.array(values, pa.list_(pa.int32()))],
                                  names=["doc_id", "subject", "ids", "values"])

    return rows.mapInArrow(run, "doc_id long, subject array<int>, ids array<int>, values array<int>")


def trees(rows: DataFrame, corpus: Broadcast) -> DataFrame:
    """Trees over neighbouring rows of (doc_id, ids, values), as ``TREE`` has it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_ids, ids, values, entries = [], [], [], 0

        def out() -> pa.RecordBatch:
            tree = Tree(np.cumsum([len(x) for x in ids]), np.concatenate(ids), np.concatenate(values), corpus.value[2])
            order, lo, hi, radius = tree.build()
            at, _ = tree.entries(order)
            row = {"doc_ids": [doc_ids[k] for k in order], "ends": np.cumsum([len(ids[k]) for k in order]).tolist(),
                   "places": np.concatenate(ids)[at].tobytes(), "values": tree.values[at].astype(np.int32).tobytes(),
                   "node_lo": lo.tobytes(), "node_hi": hi.tobytes(), "radius": radius.tobytes()}
            return pa.RecordBatch.from_pylist([row], pa.schema([
                ("doc_ids", pa.list_(pa.int64())), ("ends", pa.list_(pa.int32())),
                *[(c, pa.binary()) for c in ("places", "values", "node_lo", "node_hi", "radius")]]))

        for b in batches:
            for k, doc_id in enumerate(b.column("doc_id").to_pylist()):
                doc_ids.append(doc_id)
                ids.append(b.column("ids")[k].values.to_numpy())
                values.append(b.column("values")[k].values.to_numpy())
                entries += len(ids[-1])
                if len(ids) >= TREE_DOCS or entries >= TREE_ENTRIES:
                    yield out()
                    doc_ids, ids, values, entries = [], [], [], 0
        if ids:
            yield out()

    return rows.mapInArrow(run, TREE)


class Search:
    """One tree's bounds for a block of items, and the scores of its leaves."""

    def __init__(self, row: dict, weights: np.ndarray, item_ends: np.ndarray, item_terms: np.ndarray):
        self.tree = tree = Tree(np.array(row["ends"], np.int64), np.frombuffer(row["places"], np.int32),
                                np.frombuffer(row["values"], np.int32), weights)
        self.lo, self.hi = np.frombuffer(row["node_lo"], np.int32), np.frombuffer(row["node_hi"], np.int32)
        radius = np.frombuffer(row["radius"], float)
        ids = row["doc_ids"]
        self.null = np.array([x is None for x in ids])
        self.doc_ids = np.array([LAST_ID if x is None else x for x in ids], np.int64)
        # The items' terms that the tree has, with their items.
        where = np.searchsorted(tree.terms, item_terms)
        here = tree.terms[np.minimum(where, len(tree.terms) - 1)] == item_terms
        self.cols = where[here]
        owner = np.repeat(np.arange(len(item_ends)), np.diff(item_ends, prepend=0))[here]
        self.items, self.begin = np.unique(owner, return_index=True)
        self.stop = np.append(self.begin[1:], len(self.cols))
        self.weights = weights[item_terms[here]]
        if not len(self.items):
            return
        self.bounds = np.empty((len(self.lo), len(self.items)))
        root = np.sqrt(self.weights.astype(float))
        for k, (lo, hi) in enumerate(zip(self.lo, self.hi, strict=True)):
            c = tree.centre(np.arange(lo, hi))[self.cols]
            near = np.add.reduceat(c * root, self.begin)
            reach = np.sqrt(np.add.reduceat(np.where(c > 0, self.weights, 0).astype(float), self.begin))
            self.bounds[k] = (near + reach * radius[k]) * (1 + SLACK) + 1

    def item_weights(self, q: int) -> np.ndarray:
        w = np.zeros(len(self.tree.terms), np.int64)
        w[self.cols[self.begin[q]:self.stop[q]]] = self.weights[self.begin[q]:self.stop[q]]
        return w

    def leaf_scores(self, node: int, w: np.ndarray) -> np.ndarray:
        t, lo, hi = self.tree, self.lo[node], self.hi[node]
        p, e = t.starts[lo], t.ends[hi - 1]
        return np.add.reduceat(w[t.local[p:e]] * t.values[p:e], t.starts[lo:hi] - p)

    def leaves(self, q: int, floor) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, scores) by falling bounds, until bounds are below ``floor()``."""
        bounds, w = self.bounds[:, q], self.item_weights(q)
        heap = [(-bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < floor():
                return
            if 2 * node + 2 < len(self.lo):
                for child in (2 * node + 1, 2 * node + 2):
                    heapq.heappush(heap, (-bounds[child], child))
            else:
                yield node, self.leaf_scores(node, w)


def rounded_down(scores: np.ndarray) -> np.ndarray:
    """Scores with all but their leading ``FLOOR_BITS`` bits cleared; the exponent may be one too high, never too low."""
    shift = np.maximum(np.frexp(scores.astype(float))[1] - FLOOR_BITS, 0).astype(np.int64)
    return scores >> shift << shift


def floors(forest: DataFrame, corpus: Broadcast, queries: Broadcast, n_items: int, k: int) -> np.ndarray:
    """Per item a score that k documents reach at least (1 where fewer were seen)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                s = Search(row, corpus.value[2], *queries.value)
                for q, item in enumerate(s.items):
                    _, scores = next(s.leaves(q, lambda: 0))
                    level, n = np.unique(rounded_down(scores[scores > 0]), return_counts=True)
                    if len(level):
                        yield pa.record_batch([pa.array(np.full(len(level), item)), pa.array(level), pa.array(n)], names=["item", "level", "n"])

    seen = forest.mapInArrow(run, "item long, level long, n long").groupBy("item", "level").agg(F.sum("n").alias("n"))
    down = Window.partitionBy("item").orderBy(F.col("level").desc())
    reached = seen.withColumn("n", F.sum("n").over(down)).where(F.col("n") >= k).groupBy("item").agg(F.max("level").alias("floor"))
    out = np.ones(n_items, np.int64)
    for item, floor in reached.collect():  # a row per item of the block
        out[item] = max(1, floor)
    return out


def best_documents(forest: DataFrame, corpus: Broadcast, queries: Broadcast, least: Broadcast, k: int) -> DataFrame:
    """(item, doc_id, score): of every task's documents at or above an item's floor, the k best."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floor = least.value.copy()
        best: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for b in batches:
            for row in b.to_pylist():
                s = Search(row, corpus.value[2], *queries.value)
                for q in np.flatnonzero(s.bounds[0] >= floor[s.items]) if len(s.items) else []:
                    item = int(s.items[q])
                    for node, scores in s.leaves(int(q), lambda item=item: floor[item]):
                        keep = np.flatnonzero(scores >= floor[item])
                        if not len(keep):
                            continue
                        at = keep + s.lo[node]
                        mine = (scores[keep], s.doc_ids[at], s.null[at])
                        if item in best:
                            mine = tuple(np.concatenate(x) for x in zip(best[item], mine, strict=True))
                        order = np.lexsort((mine[2], mine[1], -mine[0]))[:k]
                        best[item] = tuple(x[order] for x in mine)
                        if len(order) == k:
                            floor[item] = max(floor[item], best[item][0][-1])
        for item, (scores, ids, null) in best.items():
            yield pa.record_batch([pa.array(np.full(len(ids), item)), pa.array(ids, mask=null), pa.array(scores)], names=["item", "doc_id", "score"])

    return forest.mapInArrow(run, "item long, doc_id long, score long")


def item_blocks(items: DataFrame, text: str, item_id: str) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """The items as (item_id, terms, once each), in blocks of some ``ITEM_BYTES`` of text."""
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = items.select(F.col(f"`{item_id}`").cast("long").alias("item_id"), t.alias("t"))
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, math.ceil(total / ITEM_BYTES))
    for k in range(n):
        own = rows.where(F.pmod(F.xxhash64("item_id", "t"), F.lit(n)) == k).collect()
        yield [(r["item_id"], sorted({x for part in term_parts(r["t"].encode()) for x in part})) for r in own]


def search_block(spark: SparkSession, docs: DataFrame, items: list, k: int, text: str, doc_id: str) -> DataFrame:
    """(item_id, item, doc_id, score): k best or more documents of each item of a block."""
    sc = spark.sparkContext
    terms = sorted({t for _, own in items for t in own})
    number = {t: i for i, t in enumerate(terms)}
    rows = written(frequencies(docs, sc.broadcast(terms), text, doc_id), "term-frequencies")
    n_docs, n_terms = rows.agg(F.count(F.lit(1)), F.sum("n")).first()
    df = np.zeros(len(terms), np.int64)
    for term, n in rows.select(F.explode("ids").alias("term")).groupBy("term").count().collect():  # a row per term of the block
        df[term] = n
    weights = np.array([term_weight(n_docs, int(x)) for x in df], np.int64)
    corpus = sc.broadcast((n_docs, n_terms or 1, weights))
    queries = sc.broadcast((np.cumsum([len(own) for _, own in items]), np.array([number[t] for _, own in items for t in own], np.int32)))
    subjects = with_subject(rows.where(F.size("ids") > 0), corpus)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = ["subject", "doc_id"]
    forest = written(trees(subjects.repartitionByRange(parts, *by).sortWithinPartitions(*by), corpus), "ball-trees")
    least = sc.broadcast(floors(forest, corpus, queries, len(items), k))
    found = best_documents(forest, corpus, queries, least, k)
    names = spark.createDataFrame([(i, own) for i, (own, _) in enumerate(items)], "item long, item_id long")
    return found.join(names, "item")


def lexical_search(docs: DataFrame, items: DataFrame, k: int = 50, text: str = "text", doc_id: str = "doc_id",
                   item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """The k highest-scoring documents of each item: item_id, rank (from 1),
    doc_id, score; only scores above 0, equal ones by ascending doc_id (null last).

    Terms are runs of digits, letters and characters beyond ASCII; A to Z count
    as lower case. Null and empty texts have no term: such items find nothing,
    such documents are not found and count nowhere. Repeated items are ranked
    each on its own, repeated documents count and are found as often as they
    stand; other columns are ignored; empty tables give an empty result. Items
    are searched in blocks of ``ITEM_BYTES`` of text, whose terms, weights and
    floors are what is sent to every task.
    """
    spark = docs.sparkSession
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    out = None
    for block in item_blocks(items, item_text, item_id):
        block = [x for x in block if x[1]]
        if not block:
            continue
        found = search_block(spark, docs, block, k, text, doc_id).withColumn("rank", rank).where(F.col("rank") <= k)
        found = found.select("item_id", "rank", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out
