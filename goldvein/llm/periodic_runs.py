"""Periodic runs of words by recompression.

The words of many texts, numbered, stand one after another with a mark of its
own before, between and behind them, so nothing that is equal reaches over a
text's end. *Recompression* turns this sequence into a run-length grammar:
block compression names every stretch of one repeated symbol, pair
compression names the pairs of a left-class and a right-class symbol, and so on
in turn until one symbol is left. Both decide by the symbols next to a
place alone, so equal stretches are parsed alike but for a few symbols at their
ends; an extension query climbs the grammar from two places while the symbols
agree and descends where they first differ, with one step a level.

A run of period q with at least four periods holds four neighbouring points of
the grid 0, q, 2q, ...; so all q up to a quarter of the text are tried at
their grid points, which number n/1 + n/2 + n/3 + ... . Points whose four words
agree are candidates, and grammar queries to the left and right give their exact
extension. A stretch that is found with several periods has the smallest.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A run has so many words, and so many periods, at least.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Words after which the texts gathered so far are compressed together.
GROUP_WORDS = 1 << 19
#: Grid points that are looked at together.
GRID_POINTS = 1 << 20

RUNS = "array<struct<start: long, length: long, period: long>>"


def right_class(symbols: np.ndarray, level: int) -> np.ndarray:
    """Which symbols are of the right class at a level: a bit of a mixed number."""
    x = (symbols.astype(np.uint64) + np.uint64(level << 40)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(63)).astype(bool)


class Grammar:
    """A run-length grammar of a sequence of numbers, as its levels.

    Per level: the symbols, whether a symbol stands for a block of the level
    below (else for a pair, or for itself), and the place of each symbol's first
    one in the level below. Names are exact: two symbols of any levels are equal
    if and only if they have the same derivation. The first and the last symbol
    of the sequence must be unlike all others.
    """

    def __init__(self, sequence: np.ndarray):
        self.symbols = [sequence.astype(np.int64)]
        self.first: list[np.ndarray] = []    # per level but the lowest: place of the first symbol below
        self.parent: list[np.ndarray] = []   # per level but the highest: place of the symbol above
        self.blocks: list[bool] = []         # per level but the lowest: made by block compression
        self.width = [np.ones(1, np.int64)]  # per level, filled below: length in the sequence, per place
        self.width[0] = np.ones(len(sequence), np.int64)
        self.names = int(sequence.max(initial=-1)) + 1
        turn = 0
        while len(self.symbols[-1]) > 1:
            s = self.symbols[-1]
            if (s[1:] == s[:-1]).any():
                self._blocks(s)
            turn += 1
            self._pairs(self.symbols[-1], turn)

    def _add(self, starts: np.ndarray, symbols: np.ndarray, block: bool) -> None:
        at = np.zeros(len(self.symbols[-1]), np.int64)
        at[starts[1:]] = 1
        self.parent.append(np.cumsum(at))
        self.first.append(starts)
        self.width.append(np.add.reduceat(self.width[-1], starts))
        self.symbols.append(symbols)
        self.blocks.append(block)

    def _name(self, symbols: np.ndarray, where: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """New names for the (left, right) derivations of the places ``where``."""
        order = np.lexsort((right, left))
        a, b = left[order], right[order]
        fresh = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(fresh) - 1 + self.names
        self.names += int(fresh.sum())
        symbols[where] = number
        return symbols

    def _blocks(self, s: np.ndarray) -> None:
        starts = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        size = np.diff(starts, append=len(s))
        where = np.flatnonzero(size > 1)
        self._add(starts, self._name(s[starts], where, s[starts][where], size[where]), True)

    def _pairs(self, s: np.ndarray, turn: int) -> None:
        right = right_class(s, turn)
        second = np.concatenate([[False], ~right[:-1] & right[1:]])
        if not second.any():
            return
        starts = np.flatnonzero(~second)
        above = s[starts]
        where = np.flatnonzero(np.diff(starts, append=len(s)) == 2)
        self._add(starts, self._name(above, where, above[where], s[starts[where] + 1]), False)

    def extension(self, i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
        """Per pair of places i < j: how many symbols from them on (before
        them, with ``back``) agree one by one."""
        way = -1 if back else 1
        # Places of the next symbols to compare, on the current level.
        a, b = (i - 1, j - 1) if back else (i.copy(), j.copy())
        done = np.zeros(len(i), np.int64)
        split = np.full(len(i), -1, np.int64)  # level at which the query found a difference
        live = np.arange(len(i))
        top = len(self.symbols) - 1

        def step(level: int, q: np.ndarray) -> np.ndarray:
            """Move queries over one agreeing symbol, over as many of a block as
            both sides have left; which of them agreed."""
            s, x, y = self.symbols[level], a[q], b[q]
            same = s[x] == s[y]
            g, x, y = q[same], x[same], y[same]
            if level < top and self.blocks[level]:
                up, first = self.parent[level], self.first[level]
                px, py = up[x], up[y]
                if back:
                    n = np.minimum(x - first[px], y - first[py]) + 1
                else:
                    end = np.append(first, len(s))
                    n = np.minimum(end[px + 1] - x, end[py + 1] - y)
            else:
                n = np.ones(len(g), np.int64)
            done[g] += n * self.width[level][x]
            a[g] += way * n
            b[g] += way * n
            return same

        def at_edge(level: int, x: np.ndarray) -> np.ndarray:
            """Whether a place is the first (last, with back) of its symbol above."""
            up = self.parent[level]
            if back:
                return np.append(up[1:] != up[:-1], True)[x]
            return self.first[level][up[x]] == x

        for level in range(top):
            if not len(live):
                break
            # One step brings two places that are parsed differently to a common edge, or to a difference.
            off = live[~(at_edge(level, a[live]) & at_edge(level, b[live]))]
            ended = off[~step(level, off)]
            still = off[~np.isin(off, ended)] if len(ended) else off
            split[ended] = level
            if len(still):
                again = still[~(at_edge(level, a[still]) & at_edge(level, b[still]))]
                split[again] = level
            live = live[split[live] < 0]
            a[live], b[live] = self.parent[level][a[live]], self.parent[level][b[live]]
        split[live] = top
        # Downwards: all queries that found their difference above come to a level with those that found it there.
        for level in range(top, -1, -1):
            q = np.flatnonzero(split >= level)
            if not len(q):
                continue
            came = q[split[q] > level]
            if len(came):  # from the symbol above to its first (last) one here
                first = self.first[level]
                end = np.append(first[1:], len(self.symbols[level])) - 1
                a[came], b[came] = (end[a[came]], end[b[came]]) if back else (first[a[came]], first[b[came]])
            while len(q):  # one step a level by the parse; more only where the two sides are cut differently
                q = q[step(level, q)]
        return done


def grid_candidates(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) of the grid points whose next three points of the same
    grid hold the same word; grids begin at each text's start."""
    longest = sizes // LEAST_PERIODS
    text = np.repeat(np.arange(len(sizes)), longest)
    period = np.arange(len(text)) - np.repeat(np.cumsum(longest) - longest, longest) + 1
    points = (sizes[text] - 1) // period - (LEAST_PERIODS - 2)
    some = points > 0
    text, period, points = text[some], period[some], points[some]
    ends = np.cumsum(points)
    at = 0
    while at < len(points):
        base = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, base + GRID_POINTS, side="right")))
        n, p = points[at:stop], period[at:stop]
        p_all = np.repeat(p, n)
        k = np.arange(len(p_all)) - np.repeat(np.cumsum(n) - n, n)
        i = np.repeat(starts[text[at:stop]], n) + k * p_all
        for d in range(1, LEAST_PERIODS):
            same = words[i] == words[i + d * p_all]
            i, p_all = i[same], p_all[same]
        yield i, p_all
        at = stop


def runs_of(texts: list[np.ndarray]) -> list[np.ndarray]:
    """Per sequence of word numbers: its runs as rows (start, length, period),
    by start, then period. Equal numbers mean equal words; they are below 2**40."""
    sizes = np.array([len(t) for t in texts], np.int64)
    none = [np.zeros((0, 3), np.int64)] * len(texts)
    if not sizes.sum():
        return none
    # A mark before every text and one behind the last.
    starts = np.cumsum(sizes) - sizes + np.arange(1, len(sizes) + 1)
    sequence = np.empty(int(sizes.sum()) + len(sizes) + 1, np.int64)
    inside = np.ones(len(sequence), bool)
    inside[starts - 1] = inside[-1] = False
    joined = np.unique(np.concatenate(texts), return_inverse=True)[1]
    sequence[inside] = joined
    sequence[~inside] = np.arange(len(sizes) + 1) + int(joined.max()) + 1
    grammar, found = None, []
    for i, p in grid_candidates(sequence, starts, sizes):
        if not len(i):
            continue
        grammar = grammar or Grammar(sequence)
        left = grammar.extension(i, i + p, back=True)
        own = left < p  # else the grid point before is in the run as well
        i, p, left = i[own], p[own], left[own]
        length = left + p + grammar.extension(i, i + p)
        long = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * p)
        found.append(np.stack([i[long] - left[long], length[long], p[long]], axis=1))
    if not found or not sum(map(len, found)):
        return none
    runs = np.concatenate(found)
    # Of one stretch the smallest period; the others are its multiples.
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    runs = runs[np.concatenate([[True], (runs[1:, :2] != runs[:-1, :2]).any(axis=1)])]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    text = np.searchsorted(starts, runs[:, 0], side="right") - 1
    runs[:, 0] -= starts[text]
    return np.split(runs, np.searchsorted(text, np.arange(1, len(texts))))


def dropped_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Whether a run holds the word after that run's first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:-1]) > 0


def inject(doc_id: int | None, n: int) -> np.ndarray | None:
    """Places of the words that a text is made of where a tenth of the texts (by
    their id's CRC) repeat a part of themselves; None for the others."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i >= a, a + (i - a) % p, i)


def periodic_runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", repeat_tenth: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_words, runs (start, length, period, by
    start, then period) and collapsed, the text's words, joined by blanks,
    without those that a run holds after its first period.

    A run is a longest possible stretch of at least ``LEAST_WORDS`` words and
    ``LEAST_PERIODS`` of its smallest period in which words one period apart
    are equal byte by byte. Words are runs of other than ASCII white space.
    Null and empty texts have no words, no runs and an empty collapsed text.
    Repeated rows and null ids stay as they are; other columns are ignored;
    an empty table gives an empty result. ``repeat_tenth`` first makes a tenth
    of the texts, by id, repeat a part of themselves (a null id never).
    A text is the work of one task, whose memory is that of some hundred bytes
    a word; short texts are compressed ``GROUP_WORDS`` words at a time.
    """
    schema = f"doc_id long, n_words long, runs {RUNS}, collapsed string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[bytes, int] = {}
        ids, kept, coded, total = [], [], [], 0

        def out() -> pa.RecordBatch:
            runs = runs_of(coded)
            collapsed = []
            for words, r in zip(kept, runs, strict=True):
                if len(r):
                    words = [words[k] for k in np.flatnonzero(~dropped_words(len(words), r))]
                collapsed.append(b" ".join(words).decode(errors="replace"))
            flat = np.concatenate(runs)
            struct = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], names=["start", "length", "period"])
            ends = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)
            return pa.record_batch([pa.array(ids, pa.int64()), pa.array([len(w) for w in kept], pa.int64()),
                                    pa.ListArray.from_arrays(pa.array(ends), struct), pa.array(collapsed, pa.string())],
                                   names=["doc_id", "n_words", "runs", "collapsed"])

        for b in batches:
            for own, t in zip(b.column("doc_id").to_pylist(), b.column("t"), strict=True):
                words = t.as_py().split()  # bytes: at ASCII white space
                codes = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
                if repeat_tenth and (at := inject(own, len(words))) is not None:
                    words, codes = [words[k] for k in at], codes[at]
                ids.append(own)
                kept.append(words)
                coded.append(codes)
                total += len(words)
                if total >= GROUP_WORDS:
                    yield out()
                    number, ids, kept, coded, total = {}, [], [], [], 0
        if ids:
            yield out()

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary").alias("t"))
    return rows.mapInArrow(run, schema)
