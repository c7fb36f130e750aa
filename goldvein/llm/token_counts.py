"""Token counts of whole texts without token ids.

A vocabulary of this kind has no piece in which a blank follows another
character, so no merge crosses such a place: a text falls apart into
*pre-tokens* (blanks and the visible characters after them) that are encoded
independently of each other. Hence:

1. Texts are read once. Documents are taken in blocks; a block keeps the
   frequencies of its own pre-tokens per document, as numbers into the block's
   list of distinct pre-tokens, which is cut into slices by hash.
2. Slices are exchanged: all blocks' pre-tokens of one slice meet in one task,
   which counts the pieces of every distinct pre-token once.
3. The counts go back to their blocks, are joined to the frequencies and
   summed per document.

A frequent pre-token has one entry per block, whatever share of the words it is.
Memory is bounded by a block (its text plus, at most, one more text's distinct
pre-tokens) and by the distinct pre-tokens of a slice.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldvein.llm.common import worker_state, written

#: Fixed value: the character that stands for a blank in the vocabulary.
BLANK = "▁"
#: Characters of text after which a block of documents is closed.
BLOCK_CHARS = 8 << 20
#: Characters of one text that are cut into pre-tokens at a time.
PART = 1 << 20
#: Slices per shuffle partition, so that partitions are of even size.
SLICES = 4

BLOCK = ("block long, doc_ids array<long>, n_bytes array<long>, sizes array<int>, steps binary, times binary, "
         "slices array<struct<slice: int, lengths: binary, tokens: binary>>")


def pre_tokens(text: str) -> Counter:
    """Frequencies of the text's pre-tokens. Each stands without its first
    blank, which encoding puts in front of it; that of the text's beginning
    has none of its own. So "" is a single blank at the text's end."""
    text = text.replace(BLANK, " ")
    out: Counter = Counter()
    at = 0
    while at < len(text):
        end = at + PART
        while end < len(text):  # cut before a blank that follows a visible character
            end = text.find(" ", end)
            if end < 0:
                end = len(text)
            elif text[end - 1] != " ":
                break
            else:
                end += 1
        part = text[at:end]
        if at:
            part = part[1:]
        if "  " in part or part[:1] == " ":
            first = re.match(" *[^ ]*", part)
            out[first[0]] += 1
            out.update(re.findall(" ( *[^ ]*)", part[first.end():]))
        else:
            out.update(part.split(" "))
        at = end
    return out


def packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2**31, byte by byte of each, compressed."""
    planes = np.ascontiguousarray(numbers, np.int32).view(np.uint8).reshape(-1, 4).T
    return len(numbers).to_bytes(8, "little") + pa.Codec("zstd").compress(planes.tobytes(), asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.Codec("zstd").decompress(data[8:], 4 * n, asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view(np.int32).ravel().astype(np.int64)


def joined(tokens: list[bytes]) -> bytes:
    return pa.Codec("zstd").compress(b"".join(tokens), asbytes=True)


def split(lengths: np.ndarray, data: bytes) -> list[bytes]:
    ends = np.cumsum(lengths).tolist()
    text = pa.Codec("zstd").decompress(data, ends[-1], asbytes=True) if ends else b""
    return [text[i:j] for i, j in zip([0, *ends], ends, strict=False)]


def load_model(content: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=content)


def check_model(content: bytes) -> None:
    """Fail if the vocabulary doesn't let texts be cut before blanks."""
    sp = load_model(content)
    if any(re.search(f"[^{BLANK}]{BLANK}", sp.id_to_piece(i)) for i in range(sp.get_piece_size())):
        raise ValueError("a piece of the vocabulary holds a blank after another character")
    probe = " Ａ  b\n "
    if sp.normalize(probe) != BLANK + probe.replace(" ", BLANK):
        raise ValueError("the vocabulary's normaliser changes texts")


def n_pieces(sp, tokens: list[str]) -> list[int]:
    return [len(x) if t else 1 for t, x in zip(tokens, sp.encode(tokens, num_threads=1), strict=True)]


class Block:
    """Frequencies of a number of documents."""

    def __init__(self):
        self.vocabulary: dict[str, int] = {}
        self.doc_ids, self.n_bytes, self.sizes, self.places, self.times, self.chars = [], [], [], [], [], 0

    def add(self, doc_id: int | None, n_bytes: int, text: str) -> None:
        found, number = pre_tokens(text), self.vocabulary
        self.places.append(np.fromiter((number.setdefault(t, len(number)) for t in found), np.int32, len(found)))
        self.times.append(np.fromiter(found.values(), np.int32, len(found)))
        self.sizes.append(len(found))
        self.doc_ids.append(doc_id)
        self.n_bytes.append(n_bytes)
        self.chars += len(text)

    def row(self, block: int, slices: int) -> dict:
        """The block with its pre-tokens by slice, then alphabet; places are in
        that order, and each document's are kept as differences."""
        coded = [t.encode() for t in self.vocabulary]
        part = np.fromiter((zlib.crc32(t) % slices for t in coded), np.int32, len(coded))
        order = np.argsort(part, kind="stable")
        number, out, at = np.empty(len(order), np.int64), [], 0
        for own in np.split(order, np.flatnonzero(np.diff(part[order])) + 1) if len(order) else []:
            mine = sorted((coded[i], i) for i in own.tolist())
            number[[i for _, i in mine]] = np.arange(at, at + len(mine))
            at += len(mine)
            out.append({"slice": int(part[own[0]]), "lengths": packed(np.array([len(t) for t, _ in mine])),
                        "tokens": joined([t for t, _ in mine])})
        steps, times = [], []
        for places, n in zip(self.places, self.times, strict=True):
            mine = number[places]
            by = np.argsort(mine)
            steps.append(np.diff(mine[by], prepend=0))
            times.append(n[by])
        return {"block": block, "doc_ids": self.doc_ids, "n_bytes": self.n_bytes, "sizes": self.sizes,
                "steps": packed(np.concatenate(steps)), "times": packed(np.concatenate(times)), "slices": out}


def blocks_of(docs: DataFrame, slices: int, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """docs: (doc_id, n_bytes, t) -> one row per block, as ``BLOCK`` has it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_bytes", pa.list_(pa.int64())),
                            ("sizes", pa.list_(pa.int32())), ("steps", pa.binary()), ("times", pa.binary()),
                            ("slices", pa.list_(pa.struct([("slice", pa.int32()), ("lengths", pa.binary()), ("tokens", pa.binary())])))])
        number, block = TaskContext.get().partitionId() << 32, Block()
        for b in batches:
            for doc_id, n_bytes, text in zip(b.column("doc_id").to_pylist(), b.column("n_bytes").to_pylist(), b.column("t"), strict=True):
                block.add(doc_id, n_bytes, text.as_py())
                if block.chars >= block_chars:
                    yield pa.RecordBatch.from_pylist([block.row(number, slices)], schema)
                    number, block = number + 1, Block()
        if block.sizes:
            yield pa.RecordBatch.from_pylist([block.row(number, slices)], schema)

    return docs.mapInArrow(run, BLOCK)


def slice_counts(sliced: DataFrame, model) -> DataFrame:
    """(slice, block, lengths, tokens), a slice's rows together -> (block,
    slice, counts): pieces of each token, encoded once per slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = worker_state(f"pieces-{hash(model.value)}", lambda: load_model(model.value))
        known, current = {}, None
        for b in batches:
            counts = []
            for part, lengths, tokens in zip(*(b.column(c).to_pylist() for c in ("slice", "lengths", "tokens")), strict=True):
                if part != current:
                    known, current = {}, part
                mine = split(unpacked(lengths), tokens)
                fresh = [t for t in mine if t not in known]
                known.update(zip(fresh, n_pieces(sp, [t.decode() for t in fresh]), strict=True))
                counts.append(packed(np.array([known[t] for t in mine])))
            yield pa.record_batch([b.column("block"), b.column("slice"), pa.array(counts, pa.binary())], names=["block", "slice", "counts"])

    return sliced.mapInArrow(run, "block long, slice int, counts binary")


def summed(found: DataFrame) -> DataFrame:
    """Blocks with their counts -> (doc_id, n_bytes, n_tokens)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                counts = [unpacked(c["counts"]) for c in sorted(row["counts"] or [], key=lambda c: c["slice"])]
                sizes, steps = np.array(row["sizes"], np.int64), np.cumsum(unpacked(row["steps"]))
                ends = np.cumsum(sizes)
                places = steps - np.repeat(np.concatenate([[0], steps])[ends - sizes], sizes)
                each = np.concatenate([*counts, np.zeros(0, np.int64)])[places] * unpacked(row["times"])
                sums = np.concatenate([[0], np.cumsum(each)])
                totals = sums[ends] - sums[ends - sizes]
                yield pa.record_batch([pa.array(row["doc_ids"], pa.int64()), pa.array(row["n_bytes"], pa.int64()), pa.array(totals, pa.int64())],
                                      names=["doc_id", "n_bytes", "n_tokens"])

    return found.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")


def token_counts(docs: DataFrame, model_file: str, limit: int = 4096, text: str = "text", doc_id: str = "doc_id",
                 slices: int | None = None, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per input row: doc_id, n_bytes (UTF-8), n_tokens, over_limit
    (more than ``limit`` tokens), counts as the vocabulary's library gives them,
    without begin and end tokens.

    ``model_file`` is a local path on the driver; its content goes to the
    tasks. Null and empty texts have no bytes and no tokens. Repeated rows and
    null ids stay as they are, each with its own count; other columns are
    ignored; an empty table gives an empty result. ``slices`` (by default by
    the session's shuffle partitions) bounds what one task counts.
    """
    spark = docs.sparkSession
    with open(model_file, "rb") as f:
        content = f.read()
    check_model(content)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slices = slices or SLICES * parts
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.octet_length(t).cast("long").alias("n_bytes"), t.alias("t"))
    blocks = written(blocks_of(rows, slices, block_chars), "token-blocks")
    sliced = blocks.select("block", F.explode("slices").alias("s")).select("block", "s.*")
    sliced = sliced.repartition(parts, "slice").sortWithinPartitions("slice")
    counts = slice_counts(sliced, spark.sparkContext.broadcast(content))
    back = counts.groupBy("block").agg(F.collect_list(F.struct("slice", "counts")).alias("counts"))
    return summed(blocks.drop("slices").join(back, "block", "left")).withColumn("over_limit", F.col("n_tokens") > limit)
