"""Main-text extraction by a recurrent block labeller.

A page is cut into blocks: runs of text between block-level tags, in page
order. Every block becomes a vector of its hashed tag path, its hashed words
and a few measures; a bidirectional LSTM reads the whole sequence, so each
block is judged in the context of the page, and gives the probability that it
belongs to the article. The network is plain numpy, for training on the
driver and for labelling in the tasks.

No page comes with labels. The training set is a bounded sample of the pages
themselves, labelled from what their markup says (``markup_label``), and
variations of them: blocks of the sample wrapped in or moved under other
containers (side bars, notices, reader comments, forms, bare bodies without an
article element), so that the labeller also knows page plans that the
sample does not show.
"""

from __future__ import annotations

import html as html_lib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldvein.llm.common import map_batches
from goldvein.llm.words import words_of

#: Pages that training reads at most: those with the smallest hashes of their ids.
SAMPLE_PAGES = 300
#: Blocks that the pages of the training sample have together at most; a page is trained on whole or not at all.
SAMPLE_BLOCKS = 20_000

# Element names of HTML by how they show.
RAW = "script|style|noscript|template|textarea|svg|iframe|object|math"
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
             "samp small span strike strong sub sup time tt u var wbr".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}

#: Names (elements, classes, ids, roles) that say what a container is.
BOILERPLATE = set("ad ads adv advert advertisement alert aside banner breadcrumb breadcrumbs button byline comment comments complementary "
                  "consent contentinfo cookie cookies copyright dialog dropdown fieldset footer form gdpr head header login masthead "
                  "menu menubar modal nav navbar navigation newsletter notice notification pager pagination popup promo "
                  "promotion related replies reply respond search select share sharing sidebar signup skip social "
                  "sponsor sponsored subscribe teaser title toc toolbar widget".split())
ARTICLE = set("article main content post entry story body text".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(" + RAW + r")\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.I | re.S)
ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

PATH_DIM, WORD_DIM, MEASURES, HIDDEN = 64, 32, 8, 24
DIM = PATH_DIM + WORD_DIM + MEASURES


def names_of(attributes: str) -> tuple[str, ...]:
    found = (a or b or c for a, b, c in ATTRIBUTE.findall(attributes)) if attributes else ()
    return tuple(x.lower() for v in found for x in NAME.findall(v))


def blocks_of(page: str) -> list[tuple[tuple, str, float]]:
    """[(path, text, share of its characters in links)] in page order.
    path: for each open block-level element (tag, names in its attributes)."""
    out: list[tuple[tuple, str, float]] = []
    stack: list[tuple[str, tuple]] = []
    held: list[str] = []
    linked, in_link, at = 0, False, 0

    def close() -> None:
        nonlocal linked, held
        text = " ".join(html_lib.unescape("".join(held)).split())
        if text:
            out.append((tuple(stack), text, min(1.0, linked / len(text))))
        held, linked = [], 0

    def take(upto: int) -> None:
        nonlocal linked
        if upto > at:
            held.append(page[at:upto])
            linked += (upto - at) * in_link

    for m in TOKEN.finditer(page):
        take(m.start())
        at = m.end()
        if m[3] is None:
            if m[1]:
                held.append(" ")
            continue
        tag = m[3].lower()
        if tag in INLINE:
            if tag == "a":
                in_link = not m[2]
            elif tag == "br":
                held.append(" ")
            continue
        close()
        if tag in VOID:
            continue
        if m[2]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            continue
        ends = CLOSED_BY.get(tag)
        if stack and stack[-1][0] == "p" or ends and stack and stack[-1][0] in ends:
            stack.pop()
        if ends and stack and stack[-1][0] in ends:
            stack.pop()
        if not m[4].rstrip().endswith("/"):
            stack.append((tag, names_of(m[4])))
    take(len(page))
    close()
    return out


def markup_label(path: tuple) -> int:
    """1 if the markup around a block says article, 0 if it says anything else."""
    inside = [i for i, (tag, names) in enumerate(path) if tag in ("article", "main") or ARTICLE & set(names)]
    for i, (tag, names) in enumerate(path):
        if tag == "header" and any(j < i for j in inside):
            continue
        if tag in BOILERPLATE or BOILERPLATE & set(names):
            return 0
    return 1


def _slot(x: str, n: int) -> int:
    return zlib.crc32(x.encode()) % n


def path_vector(path: tuple) -> np.ndarray:
    """Hashed tags and names, the nearer the block the heavier; each feature
    sets two places, so that two features seldom share both."""
    v = np.zeros(PATH_DIM, np.float32)
    for depth, (tag, names) in enumerate(reversed(path)):
        for x in (f"<{tag}", *names):
            # A name that is also an element name means the same container.
            for k in "ab":
                v[_slot(k + x.lstrip("<"), PATH_DIM)] += 1.0 if depth < 2 else 0.7
    return v


def block_vectors(blocks: list[tuple[tuple, str, float]]) -> np.ndarray:
    n = len(blocks)
    x = np.zeros((n, DIM), np.float32)
    seen: dict[tuple, np.ndarray] = {}
    texts = [b[1] for b in blocks]
    joined = "\n".join(texts).encode()
    breaks = np.cumsum([len(t.encode()) + 1 for t in texts]) if n else np.zeros(0, np.int64)
    starts, _, h = words_of(joined)
    owner = np.searchsorted(breaks, starts, side="right")
    counts = np.bincount(owner * WORD_DIM + (h % np.uint64(WORD_DIM)).astype(np.int64), minlength=n * WORD_DIM)
    counts = counts.reshape(n, WORD_DIM).astype(np.float32)
    total = counts.sum(axis=1, keepdims=True)
    x[:, PATH_DIM:PATH_DIM + WORD_DIM] = counts / np.maximum(total, 1)
    for i, (path, text, links) in enumerate(blocks):
        if path not in seen:
            seen[path] = path_vector(path)
        x[i, :PATH_DIM] = seen[path]
        x[i, -MEASURES:] = (np.log1p(total[i, 0]) / 4, links, text[-1] in ".!?", len(path) / 6, i / n, (n - i) / n,
                            text[:1] in "©", min(1.0, 8 / n))
    return x


class Labeller:
    """One bidirectional LSTM layer and a logistic output per block."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        draw = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {}
        for d in "fb":
            self.p |= {f"wx{d}": draw(DIM, 4 * HIDDEN), f"wh{d}": draw(HIDDEN, 4 * HIDDEN), f"b{d}": np.zeros(4 * HIDDEN, np.float32)}
            self.p[f"b{d}"][HIDDEN:2 * HIDDEN] = 1
        self.p |= {"wo": draw(2 * HIDDEN + DIM, 1)[:, 0], "bo": np.zeros(1, np.float32)}

    def _scan(self, x: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """x: (steps, sequences, DIM); steps past a sequence's end are zero vectors."""
        steps, n, _ = x.shape
        h = c = np.zeros((n, HIDDEN), np.float32)
        out = np.empty((steps, n, HIDDEN), np.float32)
        given = x.reshape(steps * n, DIM) @ self.p[f"wx{d}"] + self.p[f"b{d}"]
        given = given.reshape(steps, n, 4 * HIDDEN)
        for t in range(steps):
            z = given[t] + h @ self.p[f"wh{d}"]
            gates = 1 / (1 + np.exp(-z[:, :3 * HIDDEN]))
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
            g = np.tanh(z[:, 3 * HIDDEN:])
            if keep is not None:
                keep.append((h, c, i, f, o, g))
            c = f * c + i * g
            h = o * np.tanh(c)
            out[t] = h
        return out

    @staticmethod
    def _flip(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Each sequence backwards, its padding still at the end."""
        t = np.arange(x.shape[0])[:, None]
        at = np.where(t < lengths[None], lengths[None] - 1 - t, t)
        return x[at, np.arange(x.shape[1])[None]]

    def probabilities(self, x: np.ndarray, lengths: np.ndarray, keep: dict | None = None) -> np.ndarray:
        back = self._flip(x, lengths)
        kf, kb = ([], []) if keep is not None else (None, None)
        hf = self._scan(x, "f", kf)
        hb = self._flip(self._scan(back, "b", kb), lengths)
        all_h = np.concatenate([hf, hb, x], axis=2)
        if keep is not None:
            keep |= {"f": kf, "b": kb, "h": all_h, "back": back}
        return 1 / (1 + np.exp(-(all_h @ self.p["wo"] + self.p["bo"])))

    def gradients(self, x: np.ndarray, lengths: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        kept: dict = {}
        p = self.probabilities(x, lengths, kept)
        mask = (np.arange(x.shape[0])[:, None] < lengths[None]).astype(np.float32)
        dz = (p - y) * mask / mask.sum()
        g = {"wo": np.einsum("tn,tnk->k", dz, kept["h"]), "bo": np.array([dz.sum()], np.float32)}
        dh = dz[..., None] * self.p["wo"][:2 * HIDDEN]
        for d, part, given in (("f", dh[..., :HIDDEN], x), ("b", self._flip(dh[..., HIDDEN:], lengths), kept["back"])):
            wh = self.p[f"wh{d}"]
            g[f"wx{d}"], g[f"wh{d}"], g[f"b{d}"] = (np.zeros_like(self.p[k + d]) for k in ("wx", "wh", "b"))
            nh = nc = 0
            for t in range(x.shape[0] - 1, -1, -1):
                h0, c0, i, f, o, u = kept[d][t]
                c = f * c0 + i * u
                tc = np.tanh(c)
                a = part[t] + nh
                dc = a * o * (1 - tc * tc) + nc
                z = np.concatenate([dc * u * i * (1 - i), dc * c0 * f * (1 - f), a * tc * o * (1 - o), dc * i * (1 - u * u)], axis=1)
                g[f"wx{d}"] += given[t].T @ z
                g[f"wh{d}"] += h0.T @ z
                g[f"b{d}"] += z.sum(axis=0)
                nh, nc = z @ wh.T, dc * f
        return g

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = 8, batch: int = 32, rate: float = 0.01, seed: int = 11) -> None:
        r, m, v, step = np.random.default_rng(seed), {}, {}, 0
        for epoch in range(epochs):
            for group in groups_of(r.permutation(len(pages)), [len(p[1]) for p in pages], batch):
                x, lengths = padded([pages[k][0] for k in group])
                y = np.zeros(x.shape[:2], np.float32)
                for j, k in enumerate(group):
                    y[:lengths[j], j] = pages[k][1]
                step += 1
                for k, g in self.gradients(x, lengths, y).items():
                    m[k] = 0.9 * m.get(k, 0) + 0.1 * g
                    v[k] = 0.99 * v.get(k, 0) + 0.01 * g * g
                    self.p[k] = (self.p[k] - rate * (0.3 if epoch >= epochs - 3 else 1) * (m[k] / (1 - 0.9**step))
                                 / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)

    def label(self, pages: list[np.ndarray], most: int = 200_000) -> list[np.ndarray]:
        """Probability per block of each page; pages of like length go together, at most ``most`` blocks at once."""
        out: list = [np.zeros(0, np.float32)] * len(pages)
        order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
        while order:
            n = max(1, min(len(order), 64, most // len(pages[order[-1]])))
            group, order = order[-n:], order[:-n]
            x, lengths = padded([pages[k] for k in group])
            p = self.probabilities(x, lengths)
            for j, k in enumerate(group):
                out[k] = p[:lengths[j], j]
        return out


def groups_of(order: np.ndarray, lengths: list[int], batch: int, most: int = 16_384) -> Iterator[list[int]]:
    """``order`` cut into groups of ``batch`` pages, fewer where padding them would take over ``most`` blocks."""
    group: list[int] = []
    for k in order.tolist():
        if group and (len(group) == batch or (len(group) + 1) * max(lengths[k], *(lengths[j] for j in group)) > most):
            yield group
            group = []
        group.append(k)
    if group:
        yield group


def padded(seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(s) for s in seqs])
    x = np.zeros((lengths.max(), len(seqs), DIM), np.float32)
    for j, s in enumerate(seqs):
        x[:len(s), j] = s
    return x, lengths


def variation(blocks: list[tuple[tuple, str, float]], r: np.random.Generator, names: list[str]) -> list[tuple[tuple, str, float]]:
    """The page on another plan: the article under another (or no) element,
    and blocks of its own text again under containers that aren't articles."""
    labels = [markup_label(p) for p, _, _ in blocks]
    texts = [t for _, t, _ in blocks]
    root = (("html", ()), ("body", ()))
    style = r.integers(6)
    holder = [(("article", ()),), (("main", ()),), (("div", (str(r.choice(["content", "post", "entry", "story"])),)),),
              (), (("div", ("wrapper",)), ("article", ("post",))), (("section", ()),)][style]
    out = []
    for (path, text, links), y in zip(blocks, labels, strict=True):
        if y:
            tag = str(r.choice(["p", "p", "p", "h2", "li", "blockquote", "div", "pre", "td"]))
            tail = ((tag, ()),) if not path or path[-1][0] in ("article", "main", "body", "div") or r.random() < 0.3 else (path[-1],)
            out.append((root + holder + tail, text, links))
        else:
            out.append((path, text, links))
    for _ in range(int(r.integers(1, 6))):
        name = str(r.choice(names))
        box = (name, ()) if name in ("aside", "footer", "form", "header", "nav", "dialog", "menu", "button", "select") and r.random() < 0.6 else \
            (str(r.choice(["div", "section", "ul", "p"])), (name,) if r.random() < 0.6 else (str(r.choice(["site", "page", "block", "box", "list"])), name))
        inner = holder if r.random() < 0.25 else ()
        at = int(r.integers(0, len(out) + 1))
        for _ in range(int(r.integers(1, 5))):
            text = str(r.choice(texts))
            words = text.split()
            text = " ".join(words[:int(r.integers(1, 60))]) or text
            tail = ((str(r.choice(["p", "li", "div", "h3"])), ()),) if r.random() < 0.7 else ()
            out.insert(at, (root + inner + (box,) + tail, text, float(r.random() < 0.3)))
    return out


def train_labeller(pages: list[str], variations: int = 3, seed: int = 5, sample_blocks: int = SAMPLE_BLOCKS) -> Labeller:
    """A network fitted to the whole block sequences of the pages and variations
    of them; a page that would take the sample over ``sample_blocks`` blocks is left out."""
    r, net = np.random.default_rng(seed), Labeller()
    names = sorted(BOILERPLATE - {"head", "title", "byline"})
    given, left = [], sample_blocks
    for page in pages:
        blocks = blocks_of(page)
        if not blocks or len(blocks) > left:
            continue
        left -= len(blocks)
        for k in range(1 + variations):
            seq = variation(blocks, r, names) if k else blocks
            given.append((block_vectors(seq), np.array([markup_label(p) for p, _, _ in seq], np.float32)))
    if given:
        net.fit(given)
    return net


def extract_main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
                      sample_pages: int = SAMPLE_PAGES, sample_blocks: int = SAMPLE_BLOCKS) -> DataFrame:
    """One row per page: page_id, url, text, n_blocks, n_main.

    ``text`` joins the blocks judged to be the article, in page order, by one
    blank; empty if there are none. Null html counts as empty; null ids and
    urls stay null, repeated rows stay, other columns are ignored; an empty
    table gives an empty result. Training reads at most ``sample_pages`` different
    pages, whole, of ``sample_blocks`` blocks together; labelling reads every page whole.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
                        F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).alias("html"))
    # Which pages are in the sample is settled on their hashes, so only its own pages are sent.
    hashed = rows.where("html != ''").withColumn("hash", F.xxhash64("page_id", "url", "html"))
    least = [r["hash"] for r in hashed.select("hash").distinct().orderBy("hash").limit(sample_pages).collect()]
    sample = []
    if least:
        # One row of each hash: equal rows, however many, are one page of the sample.
        once = hashed.where(F.col("hash") <= least[-1]).groupBy("hash").agg(F.min("html").alias("html"))
        sample = once.orderBy("hash").limit(sample_pages).collect()
    net = spark.sparkContext.broadcast(train_labeller([r["html"] for r in sample], sample_blocks=sample_blocks).p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller()
        labeller.p = net.value
        for b in batches:
            blocks = [blocks_of(h) for h in b.column("html").to_pylist()]
            probs = labeller.label([block_vectors(x) for x in blocks])
            kept = [[t for (_, t, _), p in zip(x, q, strict=True) if p >= 0.5] for x, q in zip(blocks, probs, strict=True)]
            yield pa.record_batch([b.column("page_id"), b.column("url"), pa.array([" ".join(k) for k in kept], pa.string()),
                                   pa.array([len(x) for x in blocks], pa.int64()), pa.array([len(k) for k in kept], pa.int64())],
                                  names=["page_id", "url", "text", "n_blocks", "n_main"])

    return map_batches(rows, run, "page_id long, url string, text string, n_blocks long, n_main long", arrow=True)
