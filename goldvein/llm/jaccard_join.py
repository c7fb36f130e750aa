"""N-gram Jaccard join with PartEnum signatures.

Sets of word shingles are compared in size bands. Two sets of a band that are
similar enough differ in at most ``k`` elements, so if the feature domain is
cut into groups of partitions, more groups than ``k`` errors can spoil, some
group is nearly untouched, and for one of its enumerated subsets of
partitions both sets hold exactly the same elements. The hash of what a set
holds in a subset is a signature; similar sets share one.

Documents that share a signature form a bucket. Buckets are never paired out:

1. every member is checked against the bucket's most connected member, and the
   links found give components;
2. members of buckets that still hold several components are settled by an
   exact prefix join on their rarest shingles, between different components
   only. A passage that a third of all documents share sits at the common end of
   that order and brings nobody together.

Equal sets are one node from the start, so copies cost nothing. The result has
one row per document with its component; the links that components need are
either checked or implied by checked ones. How many sets each set is similar to
is counted apart (``link_counts``), over all pairs within a component, and only
if that column is asked for.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldvein.llm.common import map_batches, release, written
from goldvein.llm.words import mix, windows, words_of
from goldvein.operators.mdm import connected_groups

#: Documents (about) that the order of the prefix join is estimated from, and how many of them make a shingle common.
ORDER_SAMPLE, COMMON = 20_000, 3
#: Bits that a shingle's place in the order takes beside its set's size.
PLACES = 24
#: Cells of the first sketch that unlike pairs are told apart by; the second has one or two per element.
CELLS = 256
#: Bytes of text that are cut into shingles at once.
CHUNK = 1 << 20
#: Rows that a task packs for the exchange at once, and that it looks at together after it.
PACKED, SETTLED = 1 << 17, 1 << 20
#: Sets of a component that one block has on average; links are counted by pairs of blocks.
BLOCK = 256
#: Sets of a prefix key that one block has on average, and pairs of them that a task looks at at once.
KEY_BLOCK, PAIRS = 512, 1 << 17


def shingles(text: str, n: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes; a shorter text is one shingle."""
    h = words_of(text)[2]
    if not len(h):
        return h
    return np.unique(windows(h, min(n, len(h))))


def shingle_sets(texts: list[str], n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """``shingles`` of each of several texts, one after another, and the places
    where each one's begin and the last one's end."""
    raw = [t.encode() for t in texts]
    starts, _, h = words_of(b"\n".join(raw))[:3]
    edges = np.searchsorted(starts, np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])]))
    values, kept = np.zeros(len(h), np.uint64), np.zeros(len(h), bool)
    if len(h) >= n:
        values[:len(h) - n + 1] = windows(h, n)
    for a, b in itertools.pairwise(edges.tolist()):
        if b - a >= n:
            kept[a:b - n + 1] = True
            values[a:b - n + 1].sort()
        elif b > a:
            kept[a] = True
            values[a] = windows(h[a:b], b - a)[0]
    fresh = np.ones(len(h), bool)
    fresh[1:] = values[1:] != values[:-1]
    fresh[edges[:-1][np.diff(edges) > 0]] = True
    kept &= fresh
    return values[kept], np.concatenate([[0], np.cumsum(kept)])[edges]


def chunks(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place of the first text, shingle sets) of consecutive texts of about CHUNK characters."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= CHUNK):
            size += len(texts[end])
            end += 1
        yield at, *shingle_sets(texts[at:end])
        at = end


class PartEnum:
    """Signatures for Jaccard similarity of at least num / den."""

    def __init__(self, num: int = 3, den: int = 4):
        self.num, self.den = num, den
        self.lower = [1]

    def band(self, n: int) -> int:
        """Band i has sizes from lower[i] up to what lower[i] can be similar to."""
        while self.lower[-1] <= n:
            self.lower.append(self.lower[-1] * self.den // self.num + 1)
        return int(np.searchsorted(self.lower, n, side="right")) - 1

    def plan(self, band: int) -> tuple[int, int, int, int]:
        """For pairs whose smaller set is in the band: (groups, partitions in a
        group, partitions in a subset, good groups that are left by k errors)."""
        small = self.lower[band] * self.den // self.num
        total = small + small * self.den // self.num
        # Union u and intersection i: i * den >= num * u and u + i = total; they differ in u - i elements.
        k = total * (self.den - self.num) // (self.den + self.num)
        spoil = 1 if 0 < k <= 8 else 0  # errors that a group can take
        bad = k // (spoil + 1)
        groups = bad + 1 + (bad + 3) // 4 + 3 * (k > 8) + (k > 0)
        return groups, 3 if spoil else 1, 2 if spoil else 1, groups - bad

    def signatures(self, s: np.ndarray) -> np.ndarray:
        """Signatures of one set of distinct hashes."""
        return self.of_sets(s, np.array([0, len(s)]))[0]

    def of_sets(self, s: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(signatures, number of the set) of sorted sets one after another: under
        each set's own band and the one below; a set with too many empty subsets
        also gets the band's common one. Empty sets have none.

        Where any error spoils a group, the first bad + 1 groups that are not
        empty are enough: similar sets agree in all unspoiled groups, and of the
        groups before the first of these that is not empty, each set can only hold spoiled ones."""
        sigs, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        sizes = np.diff(bounds)
        own = np.array([self.band(int(n)) for n in sizes], np.int64)
        weight = (s >> np.uint64(11)).astype(np.float64) + 1.0
        for b in np.unique(np.concatenate([own, np.maximum(own - 1, 0)])[np.tile(sizes > 0, 2)]).tolist():
            some = np.flatnonzero((sizes > 0) & ((own == b) | (np.maximum(own - 1, 0) == b)))
            groups, parts, chosen, good = self.plan(b)
            cells = groups * parts
            held = sizes[some]
            first = np.cumsum(held) - held
            place = np.arange(held.sum()) + np.repeat(bounds[some] - first, held)
            cell = (s[place] % np.uint64(cells)).astype(np.int64) + np.repeat(np.arange(len(some)) * cells, held)
            # Sums in doubles: equal contents come in equal order, so equal sums; an empty cell is 0.
            content = np.bincount(cell, weights=weight[place], minlength=len(some) * cells).reshape(-1, groups, parts)
            filled = content > 0
            content = mix(content.view(np.uint64))
            where = np.arange(groups).astype(np.uint64) + np.uint64((b + 1) << 40)
            dead = np.zeros((len(some), groups), bool)
            for j, subset in enumerate(itertools.combinations(range(parts), chosen)):
                sig = np.broadcast_to(mix(where + np.uint64(j << 32)), dead.shape)
                full = np.zeros(dead.shape, bool)
                for p in subset:
                    sig = mix(sig + content[:, :, p] * np.uint64(2 * p + 3))
                    full |= filled[:, :, p]
                if parts == 1:
                    dead |= ~full
                    full &= np.cumsum(full, axis=1) <= groups - good + 1
                sigs.append(sig[full])
                owners.append(some[np.nonzero(full)[0]])
                if parts > 1:
                    dead |= ~full
            open_ = some[dead.sum(axis=1) >= good]
            sigs.append(mix(np.full(len(open_), (b + 1) << 40 | 0xFFFFFFFF, np.uint64)))
            owners.append(open_)
        return np.concatenate(sigs), np.concatenate(owners)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def _nodes(s: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit digests of each set."""
    sizes = np.diff(bounds)
    some = sizes > 0
    sums, mixed, other = (np.zeros(len(sizes), np.uint64) for _ in range(3))
    if some.any():
        at = bounds[:-1][some]
        sums[some] = np.add.reduceat(s, at)
        mixed[some] = np.add.reduceat(mix(s), at)
        other[some] = np.bitwise_xor.reduceat(mix(s * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1)), at)
    return mix(mix(sizes.astype(np.uint64) + sums) + mixed).view(np.int64), other.view(np.int64)


def _cells(sketches: list[bytes]) -> np.ndarray:
    """The counts of sketches of one size, a row each: even cells, then odd ones."""
    x = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(sketches), -1).astype(np.int16)
    return np.stack([x & 15, x >> 4], axis=1)


def _apart(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """In how many elements two sets differ at least, by their sketches; one
    with more cells is folded to the other's."""
    out = np.zeros(len(a), np.int64)
    sizes = np.array([[len(x), len(y)] for x, y in zip(a, b, strict=True)])
    for la, lb in np.unique(sizes, axis=0).tolist():
        at = np.flatnonzero((sizes[:, 0] == la) & (sizes[:, 1] == lb))
        x, y = _cells([a[i] for i in at]), _cells([b[i] for i in at])
        while x.shape[2] != y.shape[2]:
            if x.shape[2] < y.shape[2]:
                x, y = y, x
            half = x.shape[2] // 2
            x = np.minimum(x[:, :, :half] + x[:, :, half:], 15)
        out[at] = np.abs(x - y).sum(axis=(1, 2))
    return out


def sketch(s: np.ndarray, cells: int = 0) -> bytes:
    """How many elements fall into each of the cells (a power of two; by default one or
    two cells per element), up to 15, two cells a byte. The cells of two sets differ by no more than the sets do."""
    cells = cells or max(64, 1 << int(len(s)).bit_length())
    at = (s >> np.uint64(40)).astype(np.int64) & (cells - 1)
    c = np.minimum(np.bincount(at, minlength=cells), 15).astype(np.uint8)
    return (c[::2] | c[1::2] << 4).tobytes()


def digests(rows: DataFrame) -> DataFrame:
    """(doc_id, h, n, node, node2, sketch, fine) of (doc_id, h, t)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nodes, nodes2, sizes, coarse, fine = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [], []
            for _, s, bounds in chunks(b.column("t").to_pylist()):
                one, two = _nodes(s, bounds)
                nodes.append(one)
                nodes2.append(two)
                sizes.append(np.diff(bounds))
                for i, j in itertools.pairwise(bounds.tolist()):
                    coarse.append(sketch(s[i:j], CELLS))
                    fine.append(sketch(s[i:j]))
            yield pa.record_batch([b.column("doc_id"), b.column("h"), *[pa.array(np.concatenate(x), pa.int64()) for x in (sizes, nodes, nodes2)],
                                   pa.array(coarse, pa.binary()), pa.array(fine, pa.binary())],
                                  names=["doc_id", "h", "n", "node", "node2", "sketch", "fine"])

    return map_batches(rows, run, "doc_id long, h long, n long, node long, node2 long, sketch binary, fine binary", arrow=True)


def buckets(rows: DataFrame) -> DataFrame:
    """(sig, node, n) for every signature that different sets share."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        scheme = PartEnum()
        for b in batches:
            for _, s, bounds in chunks(b.column("t").to_pylist()):
                sigs, owner = scheme.of_sets(s, bounds)
                yield np.stack([sigs.view(np.int64), _nodes(s, bounds)[0][owner], np.diff(bounds)[owner]])

    return shared(rows, sign, ["sig", "node", "n"])


def shared(texts: DataFrame, made: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]], names: list[str]) -> DataFrame:
    """Of the rows (sig, node, ...), all long, that ``made`` makes of the texts as arrays of a line
    for each column, those whose sig another node has too, once each (a row of a sig
    that a task looks at several times may come again).

    Nearly all sigs are of one node. So rows cross the exchange in blocks of one
    target partition each, and are sorted as arrays; only those that go on
    become rows of Spark. A task holds one row of each of its sigs at most, and those it looks at."""
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = map_batches(texts, lambda batches: _packed(made(batches), parts), "part int, block binary", arrow=True)
    return rows.repartitionById(parts, "part").select("block").mapInArrow(
        lambda batches: _settled((b.column("block") for b in batches), names), ", ".join(f"{c} long" for c in names))


def _packed(arrays: Iterator[np.ndarray], parts: int) -> Iterator[pa.RecordBatch]:
    """(part, block) of rows by their first column; a block has the columns one after another."""
    waiting, size = [], 0
    for x in itertools.chain(arrays, [None]):
        if x is not None:
            waiting.append(x)
            size += x.shape[1]
        if size >= PACKED or x is None and size:
            y = np.concatenate(waiting, axis=1)
            part = (y[0].view(np.uint64) % np.uint64(parts)).astype(np.uint16 if parts <= 1 << 16 else np.uint32)
            y = np.take(y, np.argsort(part, kind="stable"), axis=1)
            edges = np.concatenate([[0], np.cumsum(np.bincount(part, minlength=parts))])
            some = np.flatnonzero(np.diff(edges))
            yield pa.record_batch([pa.array(some, pa.int32()), pa.array([y[:, edges[k]:edges[k + 1]].tobytes() for k in some], pa.binary())], names=["part", "block"])
            waiting, size = [], 0


def _settled(blocks: Iterator[pa.Array], names: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of blocks whose sig several nodes have."""
    held, sent = np.zeros((len(names), 0), np.int64), np.zeros(0, bool)  # a row of each sig so far; sent: it is out already
    waiting, size = [], 0
    for column in itertools.chain(blocks, [None]):
        for block in [] if column is None else column.to_pylist():
            waiting.append(np.frombuffer(block, np.int64).reshape(len(names), -1))
            size += waiting[-1].shape[1]
        if not size or column is not None and size < max(SETTLED, len(sent)):
            continue
        x = np.concatenate([held, *waiting], axis=1)
        out = np.concatenate([sent, np.zeros(size, bool)])
        waiting, size = [], 0
        order = np.argsort(x[0])
        sig = x[0, order]
        starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        lengths = np.diff(np.append(starts, len(sig)))
        lead = order[starts]
        long = lengths > 1
        order, lengths = order[np.repeat(long, lengths)], lengths[long]
        order = order[np.lexsort((order, x[0, order]))]  # of a sig, the held row comes first
        starts = np.cumsum(lengths) - lengths
        lead[long] = order[starts]
        y, first = np.take(x, order, axis=1), np.repeat(lead[long], lengths)
        several = np.zeros(0, bool)
        if len(starts):
            several = (np.minimum.reduceat(y[1], starts) != np.maximum.reduceat(y[1], starts)) | out[lead[long]]
            # A held row that is out, and its like, stay behind.
            y = y[:, np.repeat(several, lengths) & ~(out[first] & (y[1] == x[1, first]))]
            y = y[:, np.lexsort((y[1], y[0]))]
            fresh = np.ones(y.shape[1], bool)
            fresh[1:] = (y[0, 1:] != y[0, :-1]) | (y[1, 1:] != y[1, :-1])
            y = y[:, fresh]
            for at in range(0, y.shape[1], 1 << 16):
                yield pa.record_batch([pa.array(c[at:at + (1 << 16)], pa.int64()) for c in y], names=names)
        if column is not None:
            now = np.zeros(len(lead), bool)
            now[long] = several
            held, sent = x[:, lead], now


def similar_sizes(a: str, b: str):
    return (3 * F.greatest(a, b) <= 4 * F.least(a, b))


def star_pairs(m: DataFrame) -> DataFrame:
    """Distinct (a, b): each member of a bucket with the bucket's most connected member."""
    sizes = m.groupBy("sig").agg(F.count(F.lit(1)).alias("g"))
    degree = m.join(sizes, "sig").groupBy("node").agg(F.sum("g").alias("degree"))
    centre = m.join(degree, "node").groupBy("sig").agg(F.max(F.struct("degree", "node", "n")).alias("c"))
    pairs = m.join(centre, "sig").where(F.col("node") != F.col("c.node")).where(similar_sizes("n", "c.n"))
    return pairs.select(F.col("node").alias("a"), F.col("c.node").alias("b")).distinct()


def possible(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs (a, b) that sizes and sketches leave open, the small sketches
    first: similar sets of sizes x and y differ in (x + y) / 7 elements at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            total = batch.column("na").to_numpy() + batch.column("nb").to_numpy()
            keep = []
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                keep.append(7 * _apart(part.column("sa").to_pylist(), part.column("sb").to_pylist()) <= total[at:at + 4096])
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(np.concatenate(keep)))

    pairs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    for name in ("sketch", "fine"):
        one = reps.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col(name).alias("sa"))
        two = reps.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col(name).alias("sb"))
        both = pairs.join(one, "a").join(two, "b").where(similar_sizes("na", "nb"))
        pairs = both.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(run, "a long, b long")
    return pairs


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes that are similar. texts: (node, t)."""
    one = texts.select(F.col("node").alias("a"), F.col("t").alias("t_a"))
    two = texts.select(F.col("node").alias("b"), F.col("t").alias("t_b"))
    both = pairs.join(one, "a").join(two, "b").sortWithinPartitions("b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, set_b = None, None
        for batch in batches:
            keep = []
            for t_a, b, t_b in zip(*[batch.column(c).to_pylist() for c in ("t_a", "b", "t_b")], strict=True):
                if last != b:
                    last, set_b = b, shingles(t_b)
                set_a = shingles(t_a)
                inter = len(np.intersect1d(set_a, set_b, assume_unique=True))
                keep.append(100 * inter >= 75 * (len(set_a) + len(set_b) - inter))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return map_batches(both.select("a", "t_a", "b", "t_b"), run, "a long, b long", arrow=True)


def unresolved(m: DataFrame, reps: DataFrame, groups: DataFrame) -> DataFrame:
    """(node, component) of the members of buckets with several components."""
    component = reps.join(groups, "node", "left").select("node", F.coalesce("group_id", "node").alias("component"))
    placed = m.join(component, "node")
    several = placed.groupBy("sig").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
    return placed.join(several.select("sig"), "sig", "left_semi").select("node", "component").distinct()


def prefix_pairs(open_nodes: DataFrame, texts: DataFrame, reps: DataFrame) -> DataFrame:
    """Distinct (a, b) of different components that share a shingle among the
    n - ceil(3n/4) + 1 first of each, in one order of all shingles: by how
    many of a sample of documents show it, then by hash. Similar sets
    always share one, whatever the order. A pair is looked at under its keys
    and goes on under the first they share at most (``key_pairs``)."""
    cast = open_nodes.sparkSession.sparkContext.broadcast(common_shingles(open_nodes, texts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        names, counts = cast.value
        for b in batches:
            out = []
            nodes = b.column("node").to_pylist()
            for lead, s, bounds in chunks(b.column("t").to_pylist()):
                seen = np.zeros(len(s), np.int64)
                if len(names):
                    at = np.minimum(np.searchsorted(names, s), len(names) - 1)
                    seen = np.where(names[at] == s, counts[at], 0)
                for k, (i, j) in enumerate(itertools.pairwise(bounds.tolist())):
                    n = j - i
                    # The set is sorted: a stable sort by counts leaves equal counts in the order of hashes.
                    first = s[i:j][np.argsort(seen[i:j], kind="stable")[:n - -(-3 * n // 4) + 1]]
                    before = np.concatenate([first[:1], first[:-1]])
                    out.append(np.stack([first.view(np.int64), np.full(len(first), nodes[lead + k]), n << PLACES | np.arange(len(first)), before.view(np.int64)]))
            if out:
                yield np.concatenate(out, axis=1)

    rows = texts.join(open_nodes.select("node"), "node", "left_semi").select("node", "t")
    keys = written(shared(rows, run, ["sig", "node", "n", "before"]), "prefix-keys")
    release(keys)
    keys = keys.join(open_nodes, "node")
    # Keys whose documents are of one component already need no look.
    groups = keys.groupBy("sig").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count(F.lit(1)).alias("g"))
    groups = groups.where("x < y").select("sig", F.ceil(F.col("g") / KEY_BLOCK).cast("int").alias("blocks"))
    keys = keys.join(groups, "sig").join(reps.select("node", "sketch"), "node")
    return key_pairs(keys).distinct()


def key_pairs(keys: DataFrame) -> DataFrame:
    """(a, b), a < b, of sets of different components that share a prefix key and can
    be similar. keys: (sig, node, n, before, component, blocks, sketch); n has the size and the
    key's place among the set's own, ``before`` is the set's key before it.

    If a pair's first shared key has places i and j, i + j elements before it are
    not shared, so i + j <= (x + y) / 7 for similar sets of sizes x and y; and a key that
    follows the same key in both sets is not the first. Under the first one at
    least, a similar pair passes. A key's sets are cut into blocks by hash, and
    every pair of blocks is one unit of work, so a key of any size spreads."""
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = keys.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "sig", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "node", "n", "before", "component", "sketch")
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(parts, "sig", "lo", "hi").sortWithinPartitions("sig", "lo", "hi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(x: np.ndarray, cells: np.ndarray) -> Iterator[pa.RecordBatch]:
            """Of whole units of work: x has the rows of numbers, a column each."""
            sig, lo, hi, own, node, n, before, component = x
            size, place = n >> PLACES, n & (1 << PLACES) - 1
            starts = np.flatnonzero(np.concatenate([[True], (sig[1:] != sig[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])]))
            ends = np.append(starts[1:], len(sig))
            after = np.repeat(ends, ends - starts) - np.arange(len(sig)) - 1
            total, at = np.cumsum(after), 0
            while at < len(sig):
                end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, side="right")))
                many = after[at:end]
                i = np.repeat(np.arange(at, end), many)
                j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many)
                keep = (component[i] != component[j]) & ((lo[i] == hi[i]) | (own[i] != own[j]))
                keep &= (3 * np.maximum(size[i], size[j]) <= 4 * np.minimum(size[i], size[j])) & (7 * (place[i] + place[j]) <= size[i] + size[j])
                keep &= (before[i] != before[j]) | (place[i] == 0) | (place[j] == 0)
                i, j, at = i[keep], j[keep], end
                found = []
                for k in range(0, len(i), 4096):
                    y, z = i[k:k + 4096], j[k:k + 4096]
                    near = 7 * np.abs(cells[y] - cells[z]).sum(axis=(1, 2)) <= size[y] + size[z]
                    found.append(np.stack([node[y[near]], node[z[near]]]))
                if found:
                    two = np.unique(np.sort(np.concatenate(found, axis=1), axis=0), axis=1)
                    if two.shape[1]:
                        yield pa.record_batch([pa.array(c, pa.int64()) for c in two], names=["a", "b"])

        held, cells = np.zeros((8, 0), np.int64), np.zeros((0, 2, CELLS // 2), np.int8)  # the unit that may go on
        for b in batches:
            if not b.num_rows:
                continue
            x = np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("sig", "lo", "hi", "own", "node", "n", "before", "component")])
            x, cells = np.concatenate([held, x], axis=1), np.concatenate([cells, _cells(b.column("sketch").to_pylist()).astype(np.int8)])
            last = int(np.flatnonzero(np.concatenate([[True], (x[:3, 1:] != x[:3, :-1]).any(axis=0)]))[-1])
            if last:
                yield from pairs(x[:, :last], cells[:last])
            held, cells = x[:, last:], cells[last:]
        if held.shape[1]:
            yield from pairs(held, cells)

    keys.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    return dealt.mapInArrow(run, "a long, b long")


def common_shingles(open_nodes: DataFrame, texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that at least COMMON of about ORDER_SAMPLE texts (all, if fewer) show, with how many do."""
    ids, total = open_nodes.select("node").distinct(), open_nodes.select("node").distinct().count()
    if total > ORDER_SAMPLE:
        ids = ids.where(F.pmod(F.xxhash64("node"), F.lit(total)) < ORDER_SAMPLE)
    sample = texts.join(ids, "node", "left_semi").select("t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, s, _ in chunks(b.column("t").to_pylist()):
                yield pa.record_batch([_signed(s)], names=["s"])

    counted = map_batches(sample, run, "s long", arrow=True).groupBy("s").agg(F.count(F.lit(1)).alias("c"))
    got = counted.where(F.col("c") >= COMMON).toArrow()
    names, counts = (got.column(c).to_numpy().astype(np.int64) for c in ("s", "c"))
    names = names.view(np.uint64)
    order = np.argsort(names)
    return names[order], counts[order]


def link_counts(texts: DataFrame, groups: DataFrame) -> DataFrame:
    """(node, n_links): to how many other sets each set is similar, where any.

    Similar sets are of one component, so a component's sets are cut into blocks
    by hash and every pair of blocks is one unit of work, dealt over all tasks:
    a component of any size spreads, and each pair of sets meets once. Sizes and
    sketches tell most unlike pairs apart, the others are compared exactly; only
    counts leave a task. texts: (node, t); groups: (node, group_id).
    """
    sizes = groups.groupBy("group_id").agg(F.count(F.lit(1)).alias("g"))
    blocks = groups.join(sizes, "group_id").select("node", F.col("group_id").alias("component"),
                                                   F.ceil(F.col("g") / BLOCK).cast("int").alias("blocks"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = [shingles(t) for t in b.column("t").to_pylist()]
            yield pa.record_batch([*b.columns[:-1], pa.array([x.tobytes() for x in s], pa.binary()), pa.array([sketch(x, CELLS) for x in s], pa.binary())],
                                  names=[*b.schema.names[:-1], "s", "sketch"])

    members = texts.join(blocks, "node").select("component", "blocks", "node", "t")
    members = map_batches(members, sets, "component long, blocks int, node long, s binary, sketch binary", arrow=True)
    members = members.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "component", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "node", "s", "sketch")
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(parts, "component", "lo", "hi").sortWithinPartitions("component", "lo", "hi", "own")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, cells, sizes, names, counts = None, [], None, None, [], None

        def out(nodes: list[int], links: list[int] | np.ndarray) -> pa.RecordBatch:
            return pa.record_batch([pa.array(nodes, pa.int64()), pa.array(links, pa.int64())], names=["node", "links"])

        for batch in batches:
            later, found = [], []  # sets of the second block, which only meet those of the first
            for component, lo, hi, own, node, raw, sk in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if key != (component, lo, hi):
                    if held:
                        yield out(names, counts[:len(held)])
                    key, held, names = (component, lo, hi), [], []
                    cells, sizes, counts = np.zeros((BLOCK, CELLS), np.int16), np.zeros(BLOCK, np.int64), np.zeros(BLOCK, np.int64)
                s, cell, k, mine = np.frombuffer(raw, np.uint64), _cells([sk]).ravel(), len(held), 0
                n = len(s)
                if k and (lo == hi or own == hi):
                    near = np.flatnonzero((3 * np.maximum(sizes[:k], n) <= 4 * np.minimum(sizes[:k], n)))
                    near = near[7 * np.abs(cells[near] - cell).sum(axis=1) <= sizes[near] + n]
                    for i in near:
                        inter = len(np.intersect1d(held[i], s, assume_unique=True))
                        if 100 * inter >= 75 * (len(held[i]) + n - inter):
                            counts[i] += 1
                            mine += 1
                if own == lo:
                    if k == len(sizes):
                        cells, sizes, counts = (np.concatenate([x, np.zeros_like(x)]) for x in (cells, sizes, counts))
                    held.append(s)
                    names.append(node)
                    cells[k], sizes[k], counts[k] = cell, n, mine
                else:
                    later.append(node)
                    found.append(mine)
            if later:
                yield out(later, found)
        if held:
            yield out(names, counts[:len(held)])

    counted = map_batches(dealt, run, "node long, links long", arrow=True)
    return counted.groupBy("node").agg(F.sum("links").alias("n_links"))


def jaccard_components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, n_links, text_hash, leads.

    Words are runs of visible characters, A-Z lower-cased; sets are distinct
    5-word shingles (the whole text if it has fewer words); links hold from a
    Jaccard similarity of 0.75. ``n_links`` counts all other sets that this
    row's set is similar to; equal sets count once, copies of it not at all. It is
    worked out when read, and not at all by a query that leaves it out. Null and empty texts have
    no shingles and link with nothing. Repeated rows and equal texts are one
    component; a null doc_id names no component but may belong to one, and
    one of null ids alone has no name. Ids may repeat with several texts, each of
    which stands for itself. ``leads`` marks the one (doc_id, text_hash) that a component
    is kept by: its smallest id, null last, then hash; a row without shingles leads itself. Other
    columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("t"))
    rows = rows.withColumn("h", F.xxhash64("t"))
    all_docs = written(digests(rows), "shingle-digests")
    m = written(buckets(rows), "signature-buckets")
    release(m)
    # Of each set, the first of its rows: by id, null ids last, then by text.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "h")).alias("first")
    reps = all_docs.where("n > 0").groupBy("node", "node2").agg(first, F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("fine").alias("fine"))
    reps = written(reps.join(m.select("node").distinct(), "node", "left_semi").drop("node2"), "representatives")
    theirs = reps.select("node", F.col("first.id").alias("id"), F.col("first.h").alias("h"))
    same = (rows["h"] == theirs["h"]) & rows["doc_id"].eqNullSafe(theirs["id"])
    texts = written(rows.join(theirs, same).select("node", "t").dropDuplicates(["node"]), "candidate-texts")
    release(m)
    stars = written(possible(star_pairs(m), reps), "star-pairs")
    links = written(verified(stars, texts), "star-links")
    release(m)
    groups = connected_groups(links, "a", "b")
    open_nodes = written(unresolved(m, reps, groups), "open-nodes")
    release(m)
    more = written(possible(prefix_pairs(open_nodes, texts, reps), reps), "prefix-pairs")
    release(m)
    links = written(links.unionByName(verified(more, texts)).where("a != b").distinct(), "links")
    release(m)
    groups = connected_groups(links, "a", "b")
    named = all_docs.where("n > 0").groupBy("node", "node2").agg(first).join(groups, "node", "left").withColumn("group_id", F.coalesce("group_id", "node"))
    leading = named.groupBy("group_id").agg(F.min("first").alias("lead"))
    named = named.join(leading, "group_id").select("node", "node2", "lead")
    out = all_docs.join(named, ["node", "node2"], "left").join(link_counts(texts, groups), "node", "left")
    leads = F.col("doc_id").eqNullSafe(F.col("lead.id")) & (F.col("h") == F.col("lead.h"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("lead.id", "doc_id").alias("component_id"),
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.col("h").alias("text_hash"),
                      F.when(F.col("n") > 0, leads).otherwise(True).alias("leads"))
