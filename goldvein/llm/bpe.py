"""Byte-pair encoding and decoding as streaming transducers.

``StreamEncoder`` takes text in parts and gives out token ids as soon as no
later text can change them. Two things bound what it holds back:

* the pre-tokenizer: a piece is closed by the character after it, so text up
  to the last place between a visible character and white space is settled;
* inside a piece too long to hold (a run of 100,000 letters), the *sufficient
  lookahead* of the merge list: the number of bytes from the end of the
  known text within which a token may still change. It follows from the merge
  list alone (``sufficient_lookahead``).

``StreamDecoder`` turns ids into text with an incremental UTF-8 decoder, so a
character that is split over tokens is given out once it is whole.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldvein.llm.common import map_batches, worker_state

#: Fixed value: the pre-tokenizer pattern of byte-level BPE vocabularies of this kind.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space other than blank, newline, return and tab; texts that have it take the pattern alone.
RARE_SPACE = "[\x0b\x0c\x85\xa0  -     　]"
#: Characters held while no settled place is found; a longer piece is opened and streamed.
HOLD = 1 << 14
MEMO_ENTRIES = 400_000
#: Characters of texts whose new stretches are merged together.
LEARN = 1 << 20
#: Value of a pair that doesn't merge, beyond all ranks.
NEVER = 1 << 62


def byte_names() -> dict[str, int]:
    """The printable character that stands for each byte in such vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(moved)}


def sufficient_lookahead(merges: list[tuple[int, int, int]], size: dict[int, int]) -> int:
    """Bytes before the end of the known text within which tokens may change.

    ``merges`` has (left, right, result) by rank. Unknown text can decide
    whether a merge (x, y) at the border happens; that leaves open what stands
    right of the place |x| bytes further left, where a merge of higher rank
    whose right side begins with x (has it on its left spine) may or may not
    happen in turn. The longest such chain of rising ranks, plus the longest
    token, bounds the reach. Merges of equal rank go from left to right and
    carry nothing leftwards. Every operand is made by a lower rank than its
    merge (checked), so no merge can be undone later.
    """
    made_at, left_of, best, reach = {}, {}, {}, 0
    for rank, (x, _, xy) in enumerate(merges):
        made_at.setdefault(xy, rank)
        left_of.setdefault(xy, x)
    if any(made_at.get(t, -1) >= rank for rank, (x, y, _) in enumerate(merges) for t in (x, y)):
        raise ValueError("a merge uses a token that is made later")
    for x, y, _ in reversed(merges):
        chain = size[x] + best.get(x, 0)
        reach, t = max(reach, chain), y
        while t is not None:
            best[t] = max(best.get(t, 0), chain)
            t = left_of.get(t)
    return reach + max(size.values(), default=1)


class Codec:
    """A vocabulary read from a tokenizer file's content."""

    def __init__(self, spec: str):
        import regex

        j = json.loads(spec)
        names, vocab = byte_names(), j["model"]["vocab"]
        raw = {i: bytes(names[c] for c in t) for t, i in vocab.items() if all(c in names for c in t)}
        self.start = [vocab[c] for c, _ in sorted(names.items(), key=lambda x: x[1])]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in j["model"]["merges"]]
        merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b, ab) in enumerate(merges):
            self.ranks.setdefault((a, b), (rank, ab))
        self.packed = {p: r << 24 | ab for p, (r, ab) in self.ranks.items()}
        order = sorted(self.packed)
        self.pair_keys = np.array([a << 32 | b for a, b in order], np.int64)
        self.pair_packed = np.array([self.packed[p] for p in order], np.int64)
        self.lookahead = sufficient_lookahead(merges, {i: len(b) for i, b in raw.items()})
        self.specials = {t["content"]: t["id"] for t in j.get("added_tokens") or []}
        self.bytes_of = raw | {i: t.encode() for t, i in self.specials.items()}
        self.decimals = {i: f",{i}".encode() for i in self.bytes_of}
        self.raw = self.bytes_of
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True)))) if self.specials else None
        self.pieces = regex.compile(PIECES)
        self.rare = regex.compile(RARE_SPACE)
        self.chunks = regex.compile(r"[ \n\r\t]*[^ \n\r\t]+|[ \n\r\t]+")
        self.runs = [regex.compile(r"\p{L}+"), regex.compile(r"\p{N}+"), regex.compile(r"[^\s\p{L}\p{N}]+")]
        self.space = regex.compile(r"\s+")
        # Ids of stretches, and of the pieces that make up new stretches; the last full memo is looked into before it goes.
        self.memo: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}
        self.known: dict[str, list[int]] = {}
        # The same stretches as (comma and decimal of each id, bytes of all ids).
        self.coded_memo: dict[str, tuple[bytes, bytes]] = {}
        self.coded_old: dict[str, tuple[bytes, bytes]] = {}

    def merge_short(self, data: bytes) -> list[int]:
        """As ``merge``, for few symbols: the list of possible merges is
        searched instead of kept in order."""
        sym = [self.start[b] for b in data]
        get, never = self.packed.get, 1 << 62
        todo = [get(p, never) for p in zip(sym, sym[1:], strict=False)]
        while todo and (best := min(todo)) != never:
            i = todo.index(best)
            made = sym[i] = best & 0xFFFFFF
            del sym[i + 1], todo[i]
            if i < len(todo):
                todo[i] = get((made, sym[i + 1]), never)
            if i:
                todo[i - 1] = get((sym[i - 1], made), never)
        return sym

    def merge(self, data: bytes) -> list[int]:
        """Lowest rank first, leftmost of equals first, with a heap over the
        possible merges and neighbour links over the symbols."""
        sym = [self.start[b] for b in data]
        n, ranks = len(sym), self.ranks
        if n < 2:
            return sym
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*ranks[p], i, p) for i, p in enumerate(zip(sym, sym[1:], strict=False)) if p in ranks]
        heapq.heapify(heap)
        while heap:
            _, made, i, pair = heapq.heappop(heap)
            k = nxt[i]
            if sym[i] != pair[0] or k >= n or sym[k] != pair[1]:
                continue
            sym[i], sym[k] = made, -1
            nxt[i] = k = nxt[k]
            if k < n:
                prv[k] = i
                if (p := (made, sym[k])) in ranks:
                    heapq.heappush(heap, (*ranks[p], i, p))
            if (h := prv[i]) >= 0 and (p := (sym[h], made)) in ranks:
                heapq.heappush(heap, (*ranks[p], h, p))
        return [s for s in sym if s >= 0]

    def chunk(self, text: str) -> tuple[int, ...]:
        """Ids of a stretch that no piece crosses; short ones are remembered."""
        if (ids := self.memo.get(text)) is None:
            if (ids := self.old.get(text)) is None:
                ids = tuple(i for p in self.pieces.findall(text) for i in self.piece(p))
            if len(text) < 64:
                if len(self.memo) >= MEMO_ENTRIES:
                    self.old, self.memo = self.memo, {}
                self.memo[text] = ids
        return ids

    def coded(self, ids: list[int] | tuple[int, ...]) -> tuple[bytes, bytes]:
        """(comma and decimal of each id, bytes of all ids)."""
        decimals, raw = self.decimals, self.raw
        return b"".join([decimals[i] for i in ids]), b"".join([raw[i] for i in ids])

    def coded_stretches(self, stretches: list[str]) -> list[tuple[bytes, bytes]]:
        """``coded`` of stretches that no piece crosses; short ones are remembered."""
        get = self.coded_memo.get
        found = [get(x) for x in stretches]
        if None not in found:
            return found
        fresh = {x: self.coded_old.get(x) for x, f in zip(stretches, found, strict=True) if f is None}
        new = [x for x, f in fresh.items() if f is None]
        fresh |= zip(new, self._first_seen(new), strict=True)
        if len(self.coded_memo) >= MEMO_ENTRIES:
            self.coded_old, self.coded_memo = self.coded_memo, {}
        self.coded_memo |= {x: f for x, f in fresh.items() if len(x) < 64}
        return [f or fresh[x] for x, f in zip(stretches, found, strict=True)]

    def _first_seen(self, stretches: list[str]) -> list[tuple[bytes, bytes]]:
        """Pieces of all stretches, those not known merged together."""
        # Pieces don't cross from a visible character to white space: such stretches are cut in one go.
        plain = [x for x in stretches if x[0].isspace() and not x[-1].isspace()]
        cut = self.pieces.findall("".join(plain))
        ends = np.cumsum([len(x) for x in plain])
        upto = np.searchsorted(np.cumsum([len(p) for p in cut]), ends, side="right").tolist() if plain else []
        pieces = dict(zip(plain, map(cut.__getitem__, map(slice, [0, *upto], upto)), strict=False))
        for x in stretches:
            if x not in pieces:
                cut += pieces.setdefault(x, self.pieces.findall(x))
        if len(self.known) >= MEMO_ENTRIES:
            self.known.clear()
        known = self.known
        unknown = [p for p in set(cut) if len(p) < 64 and p not in known]
        coded = [p.encode() for p in unknown]
        short = [k for k, x in enumerate(coded) if len(x) <= 64]
        known.update(zip([unknown[k] for k in short], self.merge_many([coded[k] for k in short]), strict=True))
        return [self.coded([i for p in pieces[x] for i in known.get(p) or self.piece(p)]) for x in stretches]

    def pair_values(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """rank << 24 | result of each pair, ``NEVER`` where it doesn't merge."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_packed[at], NEVER)

    def merge_many(self, pieces: list[bytes]) -> list[list[int]]:
        """As ``merge`` of each piece: all pieces at once, a merge each per round."""
        if not pieces:
            return []
        size = np.array([len(x) for x in pieces])
        sym = np.array(self.start)[np.frombuffer(b"".join(pieces), np.uint8)]
        word = np.repeat(np.arange(len(pieces)), size)
        done: dict[int, list[int]] = {}
        value = np.full(len(sym), NEVER)
        inner = np.flatnonzero(word[1:] == word[:-1])
        value[inner] = self.pair_values(sym[inner], sym[inner + 1])
        while len(sym):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.minimum.reduceat(value, starts)
            size = np.diff(starts, append=len(sym))
            over = best == NEVER
            if over.any():  # settled pieces leave
                for k in np.flatnonzero(over):
                    done[int(word[starts[k]])] = sym[starts[k]:starts[k] + size[k]].tolist()
                stay = np.repeat(~over, size)
                sym, word, value = sym[stay], word[stay], value[stay]
                best, size = best[~over], size[~over]
                if not len(sym):
                    break
            at = np.flatnonzero(value == np.repeat(best, size))
            at = at[np.concatenate([[True], word[at[1:]] != word[at[:-1]]])]  # the leftmost of each piece
            sym[at] = value[at] & 0xFFFFFF
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            sym, word, value = sym[keep], word[keep], value[keep]
            at -= np.arange(len(at))
            # New neighbours: of the merged symbol to the right, and of the one left of it.
            for p in (at, at[at > 0] - 1):
                p = p[p + 1 < len(sym)]
                value[p] = np.where(word[p] == word[p + 1], self.pair_values(sym[p], sym[p + 1]), NEVER)
            value[-1] = NEVER
        return [done[k] for k in range(len(pieces))]

    def piece(self, text: str) -> list[int]:
        if (ids := self.known.get(text)) is not None:
            return ids
        data = text.encode()
        if len(data) > 4 * self.lookahead:
            stream = PieceStream(self)
            return stream.feed(data) + stream.finish()
        if len(data) > 64:
            return self.merge(data)
        if len(self.known) >= MEMO_ENTRIES:
            self.known.clear()
        ids = self.known[text] = self.merge_short(data)
        return ids


class PieceStream:
    """Streams the bytes of one long piece: of every window, the tokens that
    end more than the lookahead before its end are settled."""

    def __init__(self, codec: Codec):
        self.codec, self.held = codec, b""

    def feed(self, data: bytes) -> list[int]:
        out, c = [], self.codec
        window = 4 * c.lookahead
        for at in range(0, len(data), window):
            self.held += data[at:at + window]
            if len(self.held) < window:
                continue
            settled, end = len(self.held) - c.lookahead, 0
            for t in c.merge(self.held):
                if end + len(c.bytes_of[t]) > settled:
                    break
                end += len(c.bytes_of[t])
                out.append(t)
            self.held = self.held[end:]
        return out

    def finish(self) -> list[int]:
        out, self.held = self.codec.merge(self.held), b""
        return out


class Digest:
    """A sink of ids that keeps their number, the SHA-256 of their decimals
    joined by commas and that of the text they decode to: both are fed as ids
    come in, and the bytes of ids run through an incremental UTF-8 decoder."""

    def __init__(self, codec: Codec):
        self.codec, self.n = codec, 0
        self.ids, self.text = hashlib.sha256(), hashlib.sha256()
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def add(self, decimals: bytes, raw: bytes) -> None:
        if decimals:
            self.ids.update(decimals if self.n else decimals[1:])
            self.n += decimals.count(b",")
            self.text.update(self.state.decode(raw).encode())

    def add_stretches(self, stretches: list[str]) -> None:
        found = self.codec.coded_stretches(stretches)
        self.add(b"".join([x for x, _ in found]), b"".join([x for _, x in found]))

    def __iadd__(self, ids: list[int]) -> Digest:
        self.add(*self.codec.coded(ids))
        return self

    def append(self, token: int) -> None:
        self += [token]

    def result(self) -> tuple[int, str, str]:
        self.text.update(self.state.decode(b"", True).encode())
        return self.n, self.ids.hexdigest(), self.text.hexdigest()


class StreamEncoder:
    """feed(text part) -> settled ids; finish() -> the rest. With a sink (what
    has ``append`` and ``+=`` as a list has), they go there."""

    def __init__(self, codec: Codec):
        self.codec, self.buf = codec, ""
        self.open: tuple | None = None  # a long piece: (its run pattern, its PieceStream)

    def feed(self, text: str, out: list[int] | Digest | None = None) -> list[int] | Digest:
        out = [] if out is None else out
        self.buf += text
        c = self.codec
        while c.special and (m := c.special.search(self.buf)):
            rest, self.buf = self.buf[m.end():], self.buf[:m.start()]
            self._drain(out, final=True)
            out.append(c.specials[m[0]])
            self.buf = rest
        back = max((k for s in c.specials for k in range(1, len(s)) if self.buf.endswith(s[:k])), default=0)
        tail, self.buf = self.buf[len(self.buf) - back:], self.buf[:len(self.buf) - back]
        self._drain(out, final=False)
        self.buf += tail
        return out

    def finish(self, out: list[int] | Digest | None = None) -> list[int] | Digest:
        out = [] if out is None else out
        self._drain(out, final=True)
        return out

    def _drain(self, out: list[int] | Digest, final: bool) -> None:
        c = self.codec
        while True:
            if self.open:
                run, stream = self.open
                m = run.match(self.buf)
                end = m.end() if m else 0
                if run is c.space and end and (not final or end < len(self.buf)):
                    end -= 1  # the last space goes to what follows, if anything visible does
                out += stream.feed(self.buf[:end].encode())
                reached = end + (run is c.space) >= len(self.buf) if end else not self.buf
                self.buf = self.buf[end:]
                if not final and reached:
                    return
                out += stream.finish()
                self.open = None
            cut = len(self.buf) if final else self._settled()
            if cut:
                part, self.buf = self.buf[:cut], self.buf[cut:]
                if c.rare.search(part):
                    for p in c.pieces.findall(part):
                        out += c.piece(p)
                elif isinstance(out, Digest):
                    out.add_stretches(c.chunks.findall(part))
                else:
                    memo = c.memo
                    for x in c.chunks.findall(part):
                        out += memo.get(x) or c.chunk(x)
            if final or len(self.buf) <= HOLD:
                return
            self._open(out)
            if not self.open:
                return

    def _settled(self) -> int:
        """Up to the last white space that has a visible character before it."""
        at = len(self.buf)
        while (at := max(self.buf.rfind(" ", 0, at), self.buf.rfind("\n", 0, at))) > 0:
            if not self.buf[at - 1].isspace():
                return at
        return 0

    def _open(self, out: list[int]) -> None:
        """Nothing settled in HOLD characters: take whole pieces off the
        front, and open the one that reaches (nearly) to the end if it is long."""
        c = self.codec
        for m in c.pieces.finditer(self.buf):
            if m.end() >= len(self.buf) - 4:
                break
            out += c.piece(m[0])
        head = self.buf = self.buf[m.start():]
        if len(head) <= HOLD // 2:
            return
        visible = head[1:] if head[0] == " " and not head[1:2].isspace() else head
        run = next((r for r in c.runs if r.match(visible)), c.space)
        stream, skip = PieceStream(c), len(head) - len(visible)
        out += stream.feed(head[:skip].encode())
        self.buf, self.open = visible, (run, stream)


class StreamDecoder:
    """feed(ids) -> text; bytes that aren't UTF-8 become U+FFFD."""

    def __init__(self, codec: Codec):
        self.bytes_of, self.state = codec.bytes_of, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> str:
        return self.state.decode(b"".join([self.bytes_of.get(i, b"") for i in ids]))

    def finish(self) -> str:
        return self.state.decode(b"", True)


def codec_of(spec: str) -> Codec:
    return worker_state(f"bpe-{hash(spec)}", lambda: Codec(spec))


def encode_text(codec: Codec, text: str, part: int = 1 << 16) -> list[int]:
    enc, out = StreamEncoder(codec), []
    for at in range(0, len(text), part):
        out += enc.feed(text[at:at + part])
    return out + enc.finish()


def decode_ids(codec: Codec, ids: list[int], part: int = 1 << 16) -> str:
    dec = StreamDecoder(codec)
    return "".join([*(dec.feed(ids[at:at + part]) for at in range(0, len(ids), part)), dec.finish()])


def digest_text(codec: Codec, text: str, part: int = 1 << 16) -> tuple[int, str, str]:
    """(number of ids, SHA-256 of the ids, SHA-256 of the decoded text), in
    memory that doesn't grow with the text."""
    enc, out = StreamEncoder(codec), Digest(codec)
    for at in range(0, len(text), part):
        enc.feed(text[at:at + part], out)
    enc.finish(out)
    return out.result()


def text_groups(column: pa.Array) -> Iterator[list[str]]:
    """The texts in lists of some ``LEARN`` characters."""
    group, chars = [], 0
    for t in column:
        group.append(t.as_py())
        chars += len(group[-1])
        if chars >= LEARN:
            yield group
            group, chars = [], 0
    if group:
        yield group


def digest_texts(codec: Codec, texts: list[str]) -> list[tuple[int, str, str]]:
    """``digest_text`` of each. A text that is one settled part of the stream, as
    it has neither special strings nor rare white space and is short, is cut
    into stretches here; those that all of them show for the first time are
    merged together."""
    cut = [codec.chunks.findall(t) if len(t) < HOLD and not codec.rare.search(t) and not (codec.special and codec.special.search(t)) else None
           for t in texts]
    memo = codec.coded_memo
    codec.coded_stretches(list({x for own in cut if own for x in own if x not in memo}))
    out = []
    for t, own in zip(texts, cut, strict=True):
        if own is None:
            out.append(digest_text(codec, t))
        else:
            d = Digest(codec)
            d.add_stretches(own)
            out.append(d.result())
    return out


def bpe_digests(docs: DataFrame, tokenizer_file: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids_sha256 (decimal ids joined
    by commas), decoded_sha256 (UTF-8 of the decoded text).

    As ``bpe_round_trip``, whose ids and texts these are of, but ids and decoded
    text are only fed to the hashes while they stream, never held or sent.
    """
    with open(tokenizer_file, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(spec.value)
        for b in batches:
            found = [x for texts in text_groups(b.column("t")) for x in digest_texts(codec, texts)]
            n, ids, decoded = zip(*found, strict=True) if found else ((), (), ())
            yield pa.record_batch([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                                  names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("t"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def bpe_round_trip(docs: DataFrame, tokenizer_file: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, ids (array<int>), decoded (string).

    ``tokenizer_file`` is a local path on the driver; its content goes to the
    tasks. Null and empty texts give no ids and an empty text. Repeated rows
    and null ids stay as they are; other columns are ignored; an empty table
    gives an empty result. Special tokens written in a text are found as the
    vocabulary's library does.
    """
    with open(tokenizer_file, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(spec.value)
        for b in batches:
            ids = [encode_text(codec, t) for t in b.column("t").to_pylist()]
            yield pa.record_batch([b.column("doc_id"), pa.array(ids, pa.list_(pa.int32())),
                                   pa.array([decode_ids(codec, x) for x in ids], pa.string())],
                                  names=["doc_id", "ids", "decoded"])

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("t"))
    return map_batches(rows, run, "doc_id long, ids array<int>, decoded string", arrow=True)
