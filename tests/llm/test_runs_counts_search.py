"""Periodic runs, token counts and lexical search against brute force, and
their edge rows."""

import hashlib
import math
import os
import random
import re
import subprocess
import sys
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from goldvein.llm import bpe
from goldvein.llm import lexical_search as ls
from goldvein.llm import periodic_runs as pr
from goldvein.llm import token_counts as tc
from goldvein.llm.queries import ORACLE, QUERIES, tokenizer_path

MODEL = tokenizer_path("piece_bpe_32k.model")
# Extra columns with the names that operators use inside.
SCHEMA = "doc_id long, text string, source string, t string, n long, ids string, runs string, item long, block string, slices int"
LONG = " ".join(f"w{i % 997}" for i in range(60_000))
EDGE = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "one two"), (5, "one two"), (None, "one"), (None, None),
        (6, LONG), (7, "x" * 50_000), (8, "ÀÉ one two \x0b three"), (9, "la " * 40), (10, "  two  blanks ")]


def docs(spark, rows=EDGE):
    return spark.createDataFrame([(*r, "a", "t", 1, "i", "r", 2, "b", 3) for r in rows], SCHEMA)


# ---------------------------------------------------------------- periodic runs

def brute_runs(w):
    n, found = len(w), {}
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            if j > i and j + p - i >= max(6, 4 * p):
                found.setdefault((i, j + p - i), p)
            i = j + 1
    return sorted(((s, length, p) for (s, length), p in found.items()), key=lambda x: (x[0], x[2]))


def random_words(r):
    n, k = r.choice([0, 1, 5, 6, 7, 20, 60, 120]), r.choice([1, 2, 3, 5])
    if r.random() < 0.4:
        return [r.randrange(k) for _ in range(n)]
    out = []
    while len(out) < n:
        out += [r.randrange(k) for _ in range(r.randint(1, 8))] * r.randint(1, 9)
    return out[:n]


def test_runs_of_random_texts_against_brute_force():
    r = random.Random(3)
    for _ in range(600):
        texts = [random_words(r) for _ in range(r.randint(1, 6))]
        for t, g in zip(texts, pr.runs_of([np.array(t, np.int64) for t in texts]), strict=True):
            assert [tuple(x) for x in g.tolist()] == brute_runs(t)


def test_grammar_extensions_against_brute_force():
    r = random.Random(4)
    for _ in range(400):
        s = np.array([90, *random_words(r), 91, *random_words(r), 92])
        g, m = pr.Grammar(s), len(s)
        i = np.array([r.randrange(1, m - 1) for _ in range(20)])
        j = np.array([r.randrange(x + 1, m) for x in i])
        for back in (False, True):
            for x, y, e in zip(i, j, g.extension(i, j, back), strict=True):
                k = 0
                while (s[x - 1 - k] == s[y - 1 - k] if back else s[x + k] == s[y + k]):
                    k += 1
                assert e == k


def test_grammar_of_one_repeated_symbol_is_small():
    s = np.concatenate([[7], np.zeros(100_000, np.int64), [8]])
    g = pr.Grammar(s)
    assert len(g.symbols[1]) == 3 and g.width[-1].tolist() == [len(s)]
    assert [x.tolist() for x in pr.runs_of([np.zeros(5000, np.int64)])] == [[[0, 5000, 1]]]


def test_grid_points_in_small_steps_give_the_same(monkeypatch):
    r = random.Random(5)
    texts = [np.array(random_words(r), np.int64) for _ in range(50)]
    whole = pr.runs_of(texts)
    monkeypatch.setattr(pr, "GRID_POINTS", 7)
    assert all((a == b).all() for a, b in zip(whole, pr.runs_of(texts), strict=True))


def expected_runs(doc_id, text):
    """The contract of op11_periodic_runs, word by word."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(w)
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    best = None
    for x in runs:
        if best is None or x[1] * best[2] > best[1] * x[2]:
            best = x
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in drop)))


def tables(spark, folder, **frames):
    for name, df in frames.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_runs_query_against_brute_force(spark, tmp_path):
    r = random.Random(6)
    rows = EDGE[:8] + EDGE[9:] + [(100 + i, r.choice([" ", "\n"]).join(f"w{x}" for x in random_words(r))) for i in range(150)]
    found = QUERIES["op11_periodic_runs"](spark, tables(spark, tmp_path / "d", documents=docs(spark, rows).repartition(3))).collect()
    columns = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    assert sorted((tuple(x[c] for c in columns) for x in found), key=repr) == sorted((expected_runs(*x) for x in rows), key=repr)


def test_runs_edges(spark):
    found = {(x["doc_id"], x["n_words"], x["collapsed"]): x["runs"] for x in pr.periodic_runs(docs(spark)).collect()}
    assert found[1, 0, ""] == found[2, 0, ""] == found[3, 0, ""] == found[None, 0, ""] == []
    assert found[9, 40, "la"] == [(0, 40, 1)]
    long = next(v for k, v in found.items() if k[0] == 6)
    assert long == [(0, 60_000, 997)]
    assert sum(1 for x in pr.periodic_runs(docs(spark)).collect() if x["doc_id"] == 5) == 2
    assert pr.periodic_runs(docs(spark, [])).count() == 0


# ---------------------------------------------------------------- token counts

ALPHABET = [" ", " ", " ", "▁", "a", "b", "é", "\n", "\t", "\r", "<s>", "</s>", "the", "日", "　", "\x00", "ｆ", "😀", "in", ";"]


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.mark.parametrize("part", [1 << 20, 3, 8])
def test_pre_tokens_add_up_to_the_library(library, monkeypatch, part):
    monkeypatch.setattr(tc, "PART", part)
    r = random.Random(part)
    for _ in range(3000):
        t = "".join(r.choice(ALPHABET) for _ in range(r.randint(0, 30)))
        found = tc.pre_tokens(t)
        counts = tc.n_pieces(library, list(found))
        assert sum(n * c for n, c in zip(counts, found.values(), strict=True)) == len(library.encode(t)), repr(t)


def test_packing_of_numbers_and_tokens():
    r = random.Random(7)
    for n in (0, 1, 5, 1000):
        x = np.array([r.choice([0, 1, 300, 70_000, 2**31 - 1]) for _ in range(n)], np.int64)
        assert (tc.unpacked(tc.packed(x)) == x).all()
        tokens = [bytes(r.choices(range(256), k=r.randint(0, 9))) for _ in range(n)]
        assert tc.split(np.array([len(t) for t in tokens], np.int64), tc.joined(tokens)) == tokens


@pytest.mark.parametrize("block_chars, slices", [(tc.BLOCK_CHARS, None), (20, 3), (1, 1)])
def test_token_counts_equal_the_library(spark, library, block_chars, slices):
    r = random.Random(8)
    rows = EDGE + [(100 + i, "".join(r.choice(ALPHABET) for _ in range(r.randint(0, 60)))) for i in range(60)]
    found = tc.token_counts(docs(spark, rows).repartition(3), MODEL, limit=30, slices=slices, block_chars=block_chars).collect()
    want = []
    for doc_id, t in rows:
        n = len(library.encode(t or ""))
        want.append((doc_id, len((t or "").encode()), n, n > 30))
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)
    assert tc.token_counts(docs(spark, []), MODEL).count() == 0


def test_a_vocabulary_with_blanks_inside_pieces_is_refused(monkeypatch):
    class Pieces:
        def get_piece_size(self): return 2
        def id_to_piece(self, i): return ["▁a", "a▁b"][i]
    monkeypatch.setattr(tc, "load_model", lambda content: Pieces())
    with pytest.raises(ValueError, match="blank"):
        tc.check_model(b"")


# ---------------------------------------------------------------- lexical search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute_search(rows, items, k=50):
    held = [(d, TERM.findall(lower(t))) for d, t in rows]
    held = [(d, t) for d, t in held if t]
    n_docs, total, out = len(held), sum(len(t) for _, t in held), []
    df = {}
    for _, t in held:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    for item_id, text in items:
        found = []
        for d, t in held:
            m, score = 50 + (50 * len(t) * n_docs) // total, 0
            for x in set(TERM.findall(lower(text))):
                if tf := t.count(x):
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1)))
                    score += w * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
            if score > 0:
                found.append((-score, d is None, d))
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item_id, i + 1, d, -s) for i, (s, _, d) in enumerate(found[:k])]
    return out


def corpus(r, n):
    words = [f"t{i}" for i in range(60)] + ["Été", "日本", "A1", "a1"]
    weight = [1 / (i + 1) for i in range(len(words))]
    rows = [(i, r.choice([" ", "-", "\n"]).join(r.choices(words, weight, k=r.randint(0, 40)))) for i in range(n)]
    return rows + [(1000 + i, rows[3][1]) for i in range(n // 3)]  # a third are copies


@pytest.mark.parametrize("leaf, tree, k", [(32, 1024, 50), (2, 20, 5), (1, 1, 3)])
def test_search_against_brute_force(spark, monkeypatch, leaf, tree, k):
    monkeypatch.setattr(ls, "LEAF_DOCS", leaf)
    monkeypatch.setattr(ls, "TREE_DOCS", tree)
    r = random.Random(9)
    rows = corpus(r, 120) + EDGE[:8]
    items = [(i, " ".join(r.choices([f"T{x}" for x in range(70)] + ["日本", "été"], k=r.randint(1, 12)))) for i in range(12)]
    items += [(50, None), (51, "..."), (None, "t1 t2"), (2, "t9")]
    found = ls.lexical_search(docs(spark, rows).repartition(3), spark.createDataFrame(items, "item_id long, text string"), k=k).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(brute_search(rows, items, k), key=repr)


def test_search_in_several_blocks_of_items(spark, monkeypatch):
    r = random.Random(10)
    rows = corpus(r, 40)
    items = [(i, " ".join(r.choices([f"t{x}" for x in range(70)], k=6))) for i in range(9)]
    monkeypatch.setattr(ls, "ITEM_BYTES", 80)
    found = ls.lexical_search(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string"), k=4).collect()
    assert sorted(map(tuple, found)) == sorted(brute_search(rows, items, 4))


def test_search_of_nothing(spark):
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert ls.lexical_search(docs(spark, []), items).count() == 0
    assert ls.lexical_search(docs(spark), items.limit(0)).count() == 0
    assert ls.lexical_search(docs(spark), items.select("item_id", F.lit("zzz").alias("text"))).count() == 0


def test_bounds_hold_for_every_subtree():
    r = np.random.default_rng(11)
    n, v = 200, 50
    ids = [np.sort(r.choice(v, r.integers(1, 12), replace=False)).astype(np.int32) for _ in range(n)]
    values = [r.integers(0, 10**6, len(x)).astype(np.int32) for x in ids]
    weights = r.integers(0, 15_000, v)
    tree = ls.Tree(np.cumsum([len(x) for x in ids]), np.concatenate(ids), np.concatenate(values), weights)
    order, lo, hi, radius = tree.build()
    assert sorted(order.tolist()) == list(range(n))
    at, _ = tree.entries(order)
    row = {"doc_ids": order.tolist(), "ends": np.cumsum([len(ids[k]) for k in order]).tolist(),
           "places": np.concatenate(ids)[at].tobytes(), "values": tree.values[at].astype(np.int32).tobytes(),
           "node_lo": lo.tobytes(), "node_hi": hi.tobytes(), "radius": radius.tobytes()}
    items = [np.sort(r.choice(v, 6, replace=False)).astype(np.int32) for _ in range(10)]
    s = ls.Search(row, weights, np.cumsum([6] * 10), np.concatenate(items))
    for q, item in enumerate(s.items):
        exact = np.array([sum(int(weights[t]) * int(x) for t, x in zip(ids[k], values[k]) if t in items[item]) for k in order])
        for node in range(len(lo)):
            assert exact[lo[node]:hi[node]].max() <= s.bounds[node, q]
        assert np.concatenate([x for _, x in sorted(s.leaves(q, lambda: 0), key=lambda y: s.lo[y[0]])]).tolist() == exact.tolist()


def test_rounded_down_scores():
    x = np.array([1, 5, 1023, 1024, 1025, 2**40 + 12345, 2**53 - 1, 2**60 + 1])
    y = ls.rounded_down(x)
    assert (y <= x).all() and (y >= x - x // 256).all()


# ---------------------------------------------------------------- byte-pair digests, shipped objects

@pytest.fixture(scope="module")
def codec():
    with open(tokenizer_path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return bpe.Codec(f.read())


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def test_digests_equal_the_library(spark, codec, tmp_path):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    tok.no_truncation()
    tok.no_padding()
    r = random.Random(12)
    parts = ["a", " ", "  ", "\n", "'s", "é", "日本", "1", "!", "<|endoftext|>", "<|endof", "\xa0", "\x0b", "the", "🙂", "\r\n", "xyz" * 30]
    texts = ["".join(r.choices(parts, k=r.randint(0, 60))) for _ in range(300)] + ["a" * 60_000, " " * 40_000 + "x", LONG, "theing" * 9_000]

    def want(t):
        ids = tok.encode(t, add_special_tokens=False).ids
        return len(ids), sha(",".join(map(str, ids))), sha(tok.decode(ids, skip_special_tokens=False))
    expected = [want(t) for t in texts]
    assert bpe.digest_texts(codec, texts) == expected
    for t, e in zip(texts, expected, strict=True):
        if len(t) < 100:
            assert bpe.digest_text(codec, t, 3) == e
    rows = EDGE + [(100 + i, t) for i, t in enumerate(texts)]
    found = QUERIES["op10_bpe_round_trip"](spark, tables(spark, tmp_path / "d", documents=docs(spark, rows).repartition(3))).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(((d, *want(t or "")) for d, t in rows), key=repr)


def test_pieces_merged_together_are_those_merged_alone(codec):
    r = random.Random(13)
    pieces = [bytes(r.choices(b" etaoinshrdlu\xc3\xa9", k=r.randint(1, 64))) for _ in range(500)]
    assert codec.merge_many(pieces) == [codec.merge(p) for p in pieces] and codec.merge_many([]) == []


def test_a_long_text_is_hashed_in_bounded_memory(codec):
    text = "etaoin shrdlu the of and " * 400_000
    bpe.digest_text(codec, text[:100_000])
    tracemalloc.start()
    n, _, decoded = bpe.digest_text(codec, text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n > 10**6 and decoded == sha(text) and peak < 20 << 20


def test_shipped_objects_load_without_the_package(tmp_path):
    from goldvein.llm import toxicity
    from goldvein.llm.common import shipped
    voters = toxicity.Voters(np.zeros(0, np.uint64), np.zeros(0, np.uint64))
    code = "import pickle, sys; v = pickle.loads(sys.stdin.buffer.read()); v('some text'); assert 'goldvein' not in sys.modules"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], input=shipped(voters), cwd=tmp_path, env=env, check=True)


# ---------------------------------------------------------------- SQL of the subpackage

@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_equal_their_sql(spark, name):
    from tests.conftest import SF_SMALL
    from tools.oracle_check import check, duck
    result = check(spark, duck(SF_SMALL), name, SF_SMALL, QUERIES, ORACLE, verbose=True)
    assert result["hash_match"], result
