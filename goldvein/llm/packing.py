"""Best-fit packing of token sequences by exact-complement hashing.

Lengths are at most ``capacity``, so a table of counts per length (at most
``capacity`` rows, whatever the corpus) holds all that packing has to know. On
it the driver plans *patterns*: a pattern is a few lengths that share a
sequence, and how often. First come the exact ones: for every length, the
single, pair or triple of other lengths that fills the gap to the last token,
taken as often as the counts allow. What is left goes best-fit, longest
first, into the smallest gap that holds it. Documents are then dealt to the
patterns by their rank among the pieces of their length, in one pass without
a shuffle of texts.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldvein.llm.bpe import byte_names
from goldvein.llm.common import map_batches, worker_state, written

CAPACITY = 4096
MEMO_ENTRIES = 400_000
#: Marks that form one piece with each other and none with letters.
MARKS = "!\"#$%&()*+,-./:;=?@|"
PIECE_ROW = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"


class WordEncoder:
    """Ids of whole texts by the ``tokenizers`` library, remembering the ids
    of stretches between white space (this vocabulary drops white space, and
    no piece crosses it)."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # Ids of stretches, and of the pieces that make up new stretches; the last full memo is looked into before it goes.
        self.memo: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.names = {b: c for c, b in byte_names().items()}

    def piece(self, p: str) -> bytes:
        """One piece of lower-case letters or marks, past the normaliser."""
        if (out := self.pieces.get(p)) is None:
            named = p if p.isascii() else "".join([self.names[b] for b in p.encode()])
            out = array("I", [t.id for t in self.tokenizer.model.tokenize(named)]).tobytes()
            if len(self.pieces) >= MEMO_ENTRIES:
                self.pieces.clear()
            self.pieces[p] = out
        return out

    def stretch(self, x: str) -> bytes:
        word = x.rstrip(MARKS)
        if len(x) >= 64:
            return array("I", self.tokenizer.encode(x, add_special_tokens=False).ids).tobytes()
        if (out := self.old.get(x)) is None:
            if not word or word.isalpha() and (word.isascii() or max(word) <= "ÿ"):
                # Latin letters are in normal form, and so is their lower case.
                out = (self.piece(word.lower()) if word else b"") + (self.piece(x[len(word):]) if len(word) < len(x) else b"")
            else:
                out = array("I", self.tokenizer.encode(x, add_special_tokens=False).ids).tobytes()
        if len(self.memo) >= MEMO_ENTRIES:
            self.old, self.memo = self.memo, {}
        self.memo[x] = out
        return out

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        memo = self.memo
        return b"".join([memo.get(x) or self.stretch(x) for line in text.split("\n") for x in line.split(" ") if x])


def pieces_of(docs: DataFrame, tokenizer_file: str, end_id: int = 1, capacity: int = CAPACITY,
              text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The pieces of every document, numbered within their length per task."""
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        enc = worker_state(f"words-{hash(spec.value)}", lambda: WordEncoder(spec.value))
        seen = np.zeros(capacity + 1, np.int64)
        for b in batches:
            rows = []
            for d, t in zip(b.column("doc_id").to_pylist(), b.column("t").to_pylist(), strict=True):
                data = enc.ids(t) + end
                for k, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at:at + 4 * capacity]
                    n = len(part) // 4
                    rows.append((d, k, at // 4, n, zlib.crc32(part), task, int(seen[n])))
                    seen[n] += 1
            cols = list(zip(*rows, strict=True)) if rows else [()] * 7
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                  names=[x.split()[0] for x in PIECE_ROW.split(", ")])

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("t"))
    return map_batches(rows, run, PIECE_ROW, arrow=True)


class Lengths:
    """Availability counts, and the set of available lengths as two bit sets
    (one mirrored): the pairs with a given sum are one shift and one AND."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.counts = capacity, [0] * (capacity + 1)
        self.bits = self.mirrored = 0
        for n, c in counts.items():
            self.add(n, c)

    def add(self, n: int, by: int) -> None:
        was, self.counts[n] = self.counts[n], self.counts[n] + by
        if bool(was) != bool(self.counts[n]):
            self.bits ^= 1 << n
            self.mirrored ^= 1 << (self.capacity - n)

    def pair(self, total: int, but: int = 0) -> list[int] | None:
        """Two available lengths with this sum, the larger as large as can
        be; one piece of length ``but`` is spoken for."""
        hits = self.bits & (self.mirrored >> (self.capacity - total)) if 0 < total <= self.capacity else 0
        while hits:
            x = hits.bit_length() - 1
            y = total - x
            if x < y:
                return None
            if all(self.counts[z] >= (x == z) + (y == z) + (but == z) for z in (x, y)):
                return [x, y]
            hits ^= 1 << x
        return None

    def complement(self, gap: int) -> list[int] | None:
        """A single, pair or triple that adds up to ``gap``, longest part first."""
        if gap <= 0 or self.counts[gap]:
            return [gap] if gap > 0 else None
        if two := self.pair(gap):
            return two
        firsts = self.bits & ((1 << gap) - 1)
        while firsts:
            a = firsts.bit_length() - 1
            if 3 * a < gap:
                return None
            if (two := self.pair(gap - a, but=a)) and two[0] <= a:
                return [a, *two]
            firsts ^= 1 << a
        return None


def plan_patterns(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """[(lengths that share a sequence, how many such sequences)], using up
    every piece. Work depends on the number of distinct lengths only."""
    there = Lengths(histogram, capacity)
    plan = [([capacity], there.counts[capacity])] if there.counts[capacity] else []
    there.add(capacity, -there.counts[capacity])
    for n in range(capacity - 1, 0, -1):
        while there.counts[n]:
            there.add(n, -1)
            rest = there.complement(capacity - n)
            there.add(n, 1)
            if not rest:
                break
            lengths = [n, *rest]
            need = {x: lengths.count(x) for x in lengths}
            times = min(there.counts[x] // k for x, k in need.items())
            for x, k in need.items():
                there.add(x, -k * times)
            plan.append((lengths, times))
    counts = there.counts
    # Best fit for the rest, whole groups of alike sequences at a time.
    open_by_gap: dict[int, list[tuple[list[int], int]]] = {}
    gaps = np.zeros(capacity + 1, bool)

    def put(lengths: list[int], times: int) -> None:
        gap = capacity - sum(lengths)
        open_by_gap.setdefault(gap, []).append((lengths, times))
        gaps[gap] = True

    for n in range(capacity - 1, 0, -1):
        left = counts[n]
        while left:
            fit = n + int(np.argmax(gaps[n:])) if gaps[n:].any() else 0
            if fit:
                lengths, times = open_by_gap[fit].pop()
                gaps[fit] = bool(open_by_gap[fit])
            else:
                lengths, times, fit = [], -(-left // (capacity // n)), capacity
            each = min(fit // n, left)
            full = min(times, left // each)
            put(lengths + [n] * each, full)
            left -= full * each
            if times > full:
                extra = 1 if 0 < left < each else 0
                if extra:
                    put(lengths + [n] * left, 1)
                    left = 0
                if times - full - extra and lengths:
                    put(lengths, times - full - extra)
    return plan + [x for groups in open_by_gap.values() for x in groups if x[1]]


def slots_of(plan: list[tuple[list[int], int]], capacity: int = CAPACITY) -> dict[int, np.ndarray]:
    """Per length, rows (first rank, copies in the pattern, first sequence,
    offset of the first copy) by first rank: which ranks go where."""
    used: dict[int, int] = {}
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for lengths, times in plan:
        at = 0
        for n in sorted(set(lengths), reverse=True):
            k = lengths.count(n)
            out.setdefault(n, []).append((used.get(n, 0), k, sequence, at))
            used[n] = used.get(n, 0) + k * times
            at += k * n
        sequence += times
    return {n: np.array(rows, np.int64) for n, rows in out.items()}


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Written pieces (``PIECE_ROW``) plus sequence_id and offset."""
    spark = pieces.sparkSession
    per_task = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    per_task = written(per_task.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "piece-counts")
    # At most ``capacity`` rows come to the driver, and the slots made of them are as few.
    histogram = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = spark.sparkContext.broadcast(slots_of(plan_patterns(histogram, capacity), capacity))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            seq, off = np.zeros(len(p), np.int64), np.zeros(len(p), np.int64)
            length, rank = p["length"].to_numpy(), p["rank"].to_numpy()
            for n in np.unique(length):
                at, s = np.flatnonzero(length == n), slots.value[int(n)]
                hit = s[np.searchsorted(s[:, 0], rank[at], side="right") - 1]
                nth = rank[at] - hit[:, 0]
                seq[at], off[at] = hit[:, 2] + nth // hit[:, 1], hit[:, 3] + nth % hit[:, 1] * n
            yield p.drop(columns="rank").assign(sequence_id=seq, offset=off)

    ranked = pieces.join(per_task.select("length", "task", "before").hint("merge"), ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
    return ranked.mapInPandas(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_file: str, end_id: int = 1, capacity: int = CAPACITY,
                   text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and then ``end_id``; only longer ones are cut, into
    pieces of ``capacity``. A null text is empty and has the end id alone.
    Repeated rows and ids are packed each time, null ids stay null, other
    columns are ignored; an empty table gives an empty result.
    """
    return pack(written(pieces_of(docs, tokenizer_file, end_id, capacity, text, doc_id), "pieces"), capacity)
