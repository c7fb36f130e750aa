"""Repeated passages with a sparse suffix array.

A passage is a run of ``LENGTH`` words that stands at two places or more.
Instead of every suffix of every text, only the suffixes at minimiser
positions are kept: of each run of LENGTH words, the place of its smallest
``GRAM``-word hash. The place depends on the words alone, so equal passages keep
equal suffixes.

1. The kept suffixes are sorted by what they begin with, over all partitions,
   and each is compared with its neighbours: ``HALF`` words beyond the anchor to
   the right, and (in a second entry, mirrored) to the left. A passage around
   an anchor spans one of the two, so what has no equal neighbour is done with.
2. The others are extended: for every passage that a remaining anchor
   stands for, the words to its left and right are taken in up to LENGTH, and
   sorted neighbours that agree in all of them are repeats.

Sorting is by range of (key, document, place), so one passage that a third of
all documents hold is spread over many tasks; keys that straddle two of
them are put right from the partition borders. Equal texts are one text from
the start.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldvein.llm.common import SPACE_RE, map_batches, release, written
from goldvein.llm.words import mix, windows, words_of

LENGTH, GRAM = 50, 8
#: Words beyond the anchor's own that are compared on one side at first; two halves and the anchor are a passage.
HALF = (LENGTH - GRAM) // 2
#: A null doc_id comes after all others.
LAST_ID = 2**63 - 1

NEIGHBOUR = "key long, doc long, h long, pos int, head boolean, again boolean, first boolean"


def anchors_of(h: np.ndarray) -> np.ndarray:
    """For each run of LENGTH words, the place of its smallest GRAM-word hash (the first of equals)."""
    if len(h) < LENGTH:
        return np.zeros(0, np.int64)
    grams = windows(h, GRAM)
    span = LENGTH - GRAM + 1
    view = np.lib.stride_tricks.sliding_window_view(grams, span)
    return np.arange(len(view)) + view.argmin(axis=1)


def sides_of(anchors: np.ndarray) -> np.ndarray:
    """Which half a run's anchor leaves longer: 0 right of it, 1 left."""
    return (anchors - np.arange(len(anchors)) >= HALF).astype(np.int64)


def suffix_entries(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(keys, 2 * anchor + side), one entry per kept suffix and side in use."""
    h = words_of(text, lower=False)[2]
    anchors = anchors_of(h)
    if not len(anchors):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    entry = np.unique(2 * anchors + sides_of(anchors))
    start = entry // 2 - HALF * (entry % 2)
    keys = windows(h, GRAM + HALF)[start]
    return mix(keys + (entry % 2).astype(np.uint64)), entry


def passage_entries(text: str, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, starts) of the runs of LENGTH words that the given entries stand for."""
    h = words_of(text, lower=False)[2]
    anchors = anchors_of(h)
    starts = np.flatnonzero(np.isin(2 * anchors + sides_of(anchors), entries))
    return windows(h, LENGTH)[starts], starts


def neighbours(rows: DataFrame) -> DataFrame:
    """rows: written (key, doc, h, pos), all different. Those whose key
    another row has, with ``first`` for the smallest (doc, pos, h) of a key."""
    by = ["key", "doc", "pos", "h"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.select("key", "doc", "h", "pos").repartitionByRange(parts, *by).sortWithinPartitions(*by)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before, head = np.zeros((4, 0), np.int64), False, True

        def out(x: np.ndarray, again: np.ndarray, first: np.ndarray, leads: bool, keep: np.ndarray) -> pa.RecordBatch:
            lead = np.zeros(x.shape[1], bool)
            lead[:1] = leads
            keep = keep | lead
            x = x[:, keep]
            return pa.record_batch([pa.array(x[0], pa.int64()), pa.array(x[1], pa.int64()), pa.array(x[2], pa.int64()),
                                    pa.array(x[3].astype(np.int32), pa.int32()), pa.array(lead[keep]), pa.array(again[keep]), pa.array(first[keep])],
                                   names=["key", "doc", "h", "pos", "head", "again", "first"])

        for b in batches:
            x = np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)])
            x = np.concatenate([held, x], axis=1)
            if not x.shape[1]:
                continue
            same = np.concatenate([[before], x[0, 1:] == x[0, :-1], [False]])
            again = same[:-1] | same[1:]
            held, before, k = x[:, -1:], bool(same[-2]), x.shape[1] - 1
            if k:
                yield out(x[:, :k], again[:k], ~same[:k], head, again[:k])
                head = False
        if held.shape[1]:
            one = np.ones(1, bool)
            yield out(held, one & before, ~(one & before), head, one)  # the border row always

    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "65536")
    found = written(ranged.mapInArrow(compare, NEIGHBOUR), "neighbours")
    # One key per partition, at most, can go on from the partition before. Of such a
    # key, every partition has one leading row; only these are put right.
    edge = F.broadcast(found.where("head").select("key").distinct())
    cols = ["key", "doc", "h", "pos"]
    later = found.where("again AND NOT first").select(*cols, "first")
    leading = found.where("first").select(*cols, "again")
    inner = leading.where("again").join(edge, "key", "left_anti").select(*cols, F.lit(True).alias("first"))
    border = leading.join(edge, "key", "left_semi")
    least = border.groupBy("key").agg(F.min(F.struct("doc", "pos", "h")).alias("m"), F.count(F.lit(1)).alias("n"))
    border = border.join(F.broadcast(least), "key").where("again OR n > 1").select(
        *cols, (F.struct("doc", "pos", "h") == F.col("m")).alias("first"))
    return later.unionByName(inner).unionByName(border)


def span_lists(starts: np.ndarray, text: np.ndarray, texts: int) -> pa.ListArray:
    """For each of the texts, the union of the runs of LENGTH words at its starts
    (sorted by text, then start), as (start, end)."""
    opens = np.ones(len(starts), bool)
    opens[1:] = (np.diff(text) > 0) | (np.diff(starts) > LENGTH)
    begin = np.flatnonzero(opens)
    end = starts[np.append(begin[1:], len(starts)) - 1] + LENGTH if len(begin) else starts
    ranges = pa.StructArray.from_arrays([pa.array(starts[begin].astype(np.int32)), pa.array(end.astype(np.int32))], names=["start", "end"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(text[begin], np.arange(texts + 1)).astype(np.int32)), ranges)


def repeated_passages(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per input row that holds repeated passages: doc_id, n_words,
    spans and later (arrays of word ranges (start, end), end excluded).

    ``spans`` are all words in runs of 50 words or more that stand at another
    place too, in the same or another document; ``later`` those of them
    that a run at a smaller (doc_id, place) says already. Words are runs of visible characters and
    compared as they are, passages by 64-bit hashes. Null, empty and shorter texts have none. Of equal
    texts the smallest id is the first, and all others are later as a whole; rows equal in id
    and text are one place, so none of them is later than the other. Null ids come last.
    ``text_hash`` (xxhash64) tells texts of a repeated id apart. Other columns are ignored; an empty table
    gives an empty result.
    """
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(LAST_ID)).alias("doc"), F.xxhash64(t).alias("h"), t.alias("t"))

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [suffix_entries(x) for x in b.column("t").to_pylist()]
            keys = np.concatenate([k for k, _ in got]) if got else np.zeros(0, np.uint64)
            if len(keys):
                yield pa.record_batch(
                    [pa.array(keys.view(np.int64), pa.int64()), pa.array(np.repeat(b.column("h").to_numpy(), [len(k) for k, _ in got]), pa.int64()),
                     pa.array(np.concatenate([e for _, e in got]).astype(np.int32), pa.int32())], names=["key", "h", "pos"])

    suffixes = map_batches(rows.select("h", "t"), entries, "key long, h long, pos int", arrow=True).distinct()
    suffixes = written(suffixes.select("key", F.lit(0).cast("long").alias("doc"), "h", "pos"), "suffixes")
    release(rows)
    open_entries = neighbours(suffixes).groupBy("h").agg(F.collect_set("pos").alias("entries"))

    texts = rows.groupBy("h").agg(F.min("doc").alias("doc"), F.count(F.lit(1)).alias("copies"))
    texts = written(texts, "texts")
    todo = open_entries.join(texts, "h").select("h", "doc", "entries")
    todo = rows.join(todo, ["h", "doc"]).dropDuplicates(["h", "doc"])

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [passage_entries(x, np.array(e)) for x, e in zip(b.column("t").to_pylist(), b.column("entries").to_pylist(), strict=True)]
            sizes = [len(k) for k, _ in got]
            if sum(sizes):
                yield pa.record_batch(
                    [pa.array(np.concatenate([k for k, _ in got]).view(np.int64), pa.int64()),
                     *[pa.array(np.repeat(b.column(c).to_numpy(), sizes), pa.int64()) for c in ("doc", "h")],
                     pa.array(np.concatenate([s for _, s in got]).astype(np.int32), pa.int32())], names=["key", "doc", "h", "pos"])

    found = written(map_batches(todo.select("h", "doc", "t", "entries"), passages, "key long, doc long, h long, pos int", arrow=True), "passages")
    release(rows)
    # A hit is one number, 2 * pos + first: texts of many hits are kept small while they are collected.
    hit = F.col("pos").cast("long") * 2 + F.col("first").cast("int")
    hits = neighbours(found).groupBy("h").agg(F.sort_array(F.collect_list(hit)).alias("hits"))

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, sizes = b.column("hits").flatten().to_numpy(zero_copy_only=False), b.column("hits").value_lengths().to_numpy(zero_copy_only=False)
            text, pos = np.repeat(np.arange(len(sizes)), sizes), flat // 2
            later = flat % 2 == 0
            yield pa.record_batch([b.column("h"), span_lists(pos, text, len(sizes)), span_lists(pos[later], text[later], len(sizes))],
                                  names=["h", "spans", "later"])

    # Few texts at a time: neighbours() left large batches behind, in which the hits of very many texts would be one batch.
    kind = "array<struct<start: int, end: int>>"
    placed = map_batches(hits, spans, f"h long, spans {kind}, later {kind}", arrow=True)

    # Every row: its text's spans; all of a text of several copies, in all but the smallest id.
    words = F.size(F.filter(F.split("t", SPACE_RE), lambda x: x != "")).alias("n_words")
    every = rows.select("doc", "h", words).where(F.col("n_words") >= LENGTH)
    # One row per text, written: the join with all rows has an exchange of its own on either side, so a text
    # that very many rows hold can be split.
    known = texts.select("h", F.col("doc").alias("first_doc"), "copies").join(placed, "h", "left")
    every = every.join(written(known.where("copies > 1 OR size(spans) > 0"), "placed"), "h")
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").alias("end"))).cast(kind)
    none = F.array().cast(kind)
    several = F.col("copies") > 1
    out = every.select(
        F.when(F.col("doc") != LAST_ID, F.col("doc")).alias("doc_id"), F.col("h").alias("text_hash"), "n_words",
        F.when(several, whole).otherwise(F.coalesce("spans", none)).alias("spans"),
        F.when(several & (F.col("doc") != F.col("first_doc")), whole).otherwise(F.coalesce("later", none)).alias("later"))
    return out.where(F.size("spans") > 0)


def cut(text: str, ranges: list[dict]) -> str:
    """The text without the word ranges and the white space after them."""
    raw = text.encode()
    starts = words_of(raw, lower=False)[0]
    out, at = [], 0
    for r in ranges:
        out.append(raw[at:starts[r["start"]]])
        at = starts[r["end"]] if r["end"] < len(starts) else len(raw)
    return b"".join([*out, raw[at:]]).decode()


def without_later_passages(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows with every passage that stands at an earlier place cut from
    their texts; a row of which nothing visible is left goes. All columns stay."""
    found = repeated_passages(docs, text, doc_id).where(F.size("later") > 0).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_h"), F.to_json("later").alias("_later")).distinct()
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    both = docs.join(found, F.col(f"`{doc_id}`").cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64(t) == F.col("_h")), "left")
    changed = both.where("_later IS NOT NULL").drop("_id", "_h")
    names, place = docs.columns, docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = [cut(x or "", json.loads(r)) for x, r in zip(b.column(place).to_pylist(), b.column("_later").to_pylist(), strict=True)]
            cols = [pa.array(new, pa.string()) if i == place else b.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(cols, names=names).filter(pa.array([bool(x.strip(" \t\n\v\f\r")) for x in new], pa.bool_()))

    done = map_batches(changed, run, docs.schema, arrow=True)
    return both.where("_later IS NULL").select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(done)
