"""Edge rows of every training-data operator: nulls in any column, empty and
very long texts, ties and repeated rows, empty tables, clashing columns."""

import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from goldvein.llm import bpe, html_extract, packing, suffix_dedup as S
from goldvein.llm.chat_format import rotate_perspectives
from goldvein.llm.exact_dedup import exact_dedup
from goldvein.llm.jaccard_join import PartEnum, jaccard_components
from goldvein.llm.quality_classifier import isotonic, quality_scores, statistics_of
from goldvein.llm.quality_rules import quality_rules
from goldvein.llm.queries import tokenizer_path
from goldvein.llm.suffix_dedup import LENGTH, cut, repeated_passages, without_later_passages
from goldvein.llm.toxicity import toxicity_scores
from goldvein.llm.words import windows, words_of

# Extra columns with the names that operators use inside.
SCHEMA = "doc_id long, text string, source string, h long, n int, t string, score double, bucket string, kept string, key string"
LONG = " ".join(f"w{i % 997}" for i in range(60_000))
EDGE = [(1, None, "a"), (2, "", "a"), (3, " \n\t", None), (4, "one", "b"), (5, "one", "b"), (5, "one", "b"), (None, "one", None),
        (None, None, None), (6, LONG, "b"), (7, "x" * 50_000, "b"), (8, "ÀÉ one two \x0b three", "c")]


def docs(spark, rows=EDGE):
    return spark.createDataFrame([(*r, 1, 2, "t", 0.5, "b", "k", "key") for r in rows], SCHEMA)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def got(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


# ---------------------------------------------------------------- words

def test_words_hash_by_content_only():
    r = random.Random(1)
    for _ in range(50):
        words = ["".join(r.choices("abÄ日x", k=r.randint(1, 6))) for _ in range(40)]
        text = "".join(w + r.choice([" ", "\n", "\t  "]) for w in words)
        starts, ends, h = words_of(text)
        raw = text.encode()
        assert [raw[a:b].decode() for a, b in zip(starts, ends)] == words
        folded = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words]
        for i, j in itertools.combinations(range(40), 2):
            assert (h[i] == h[j]) == (folded[i] == folded[j])
        w3 = windows(h, 3)
        for i, j in itertools.combinations(range(38), 2):
            assert (w3[i] == w3[j]) == (folded[i:i + 3] == folded[j:j + 3])
    assert len(words_of("")[2]) == 0 and len(windows(words_of("a b")[2], 3)) == 0


def test_words_across_segments():
    text = ("word " * 300_000) + "x" * 1_200_000 + " end"
    starts, _, h = words_of(text)
    assert len(starts) == 300_002 and len(np.unique(h)) == 3


# ---------------------------------------------------------------- quality rules

def test_quality_rules_edges(spark):
    out = {r.doc_id: r for r in quality_rules(docs(spark)).collect()}
    assert quality_rules(docs(spark)).count() == len(EDGE)
    assert (out[1].n_words, out[1].word_chars, out[1].base_failed, out[1].kept) == (0, 0, True, False)
    assert out[6].n_words == 60_000 and out[6].n_repeat_words == 60_000 and out[6].base_failed
    assert out[8].n_words == 3 and quality_rules(docs(spark, [])).count() == 0


def test_repeat_words_against_brute_force(spark):
    r = random.Random(2)
    rows = [(i, " ".join(r.choices("abc", k=r.randint(0, 60)) if i % 2 else r.choices("abcdefgh", k=r.randint(0, 40)) * r.randint(1, 2)), "s")
            for i in range(60)]

    def brute(text):
        w = text.split()
        grams = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
        return len({p for i, g in enumerate(grams) if grams.count(g) > 1 for p in range(i, i + 8)})

    out = {x.doc_id: x.n_repeat_words for x in quality_rules(docs(spark, rows)).collect()}
    assert out == {i: brute(t) for i, t, _ in rows}


def test_hosts_that_mostly_fail_are_rejected_and_others_are_not(spark):
    good = " ".join(f"v{i}" for i in range(40))
    rows = [(i, good if i % 10 == 0 else "short", "bad") for i in range(200)]
    rows += [(1000 + i, good if i % 10 else "short", f"host{i % 7}") for i in range(700)] + [(5000, "short", "tiny"), (5001, good, "tiny2"), (5002, good, None)]
    out = {x.doc_id: x.kept for x in quality_rules(docs(spark, rows)).collect()}
    assert not any(out[i] for i in range(200))
    assert all(out[1000 + i] == bool(i % 10) for i in range(700)) and out[5001] and out[5002]


# ---------------------------------------------------------------- exact dedup

@pytest.mark.parametrize("largest", [True, False])
def test_exact_dedup_edges(spark, largest):
    out = got(exact_dedup(docs(spark), largest=largest, fan_in=2), "doc_id", "keep_id", "group_size", "kept")
    keep = 5 if largest else 4
    assert (4, keep, 4, not largest) in out and out.count((5, 5, 4, True)) == (2 if largest else 0) and (None, keep, 4, False) in out
    assert (1, 2 if largest else 1, 3, not largest) in out and (None, 2 if largest else 1, 3, False) in out
    assert exact_dedup(docs(spark, [])).count() == 0
    only_null = got(exact_dedup(docs(spark, [(None, "z", "s"), (None, "z", "s")])), "keep_id", "group_size", "kept")
    assert only_null == [(None, 2, True)] * 2


def test_exact_dedup_many_runs_and_a_hot_group(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"t{i % 50}", "s") for i in range(600)]
    out = {r.doc_id: r for r in exact_dedup(docs(spark, rows).repartition(13), fan_in=2, slices=5).collect()}
    sizes = {}
    for i, t, _ in rows:
        sizes.setdefault(t, []).append(i)
    for i, t, _ in rows:
        assert (out[i].keep_id, out[i].group_size, out[i].kept) == (max(sizes[t]), len(sizes[t]), i == max(sizes[t]))
        assert out[i].text_sha256 == hashlib.sha256(t.encode()).hexdigest()


# ---------------------------------------------------------------- perspectives

def test_perspectives_by_hand(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 2, "ann", "<|end|>"), (2, None, None, "alone"),
            (3, 0, "system", "no one"), (None, 5, "eve", "a"), (None, 300, "eve", "b"), (None, 300, "eve", "b")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, n int, perspective string")
    out = rotate_perspectives(df).orderBy("conv_id", "perspective", "position").collect()
    views = {}
    for r in out:
        views.setdefault((r.conv_id, r.perspective), []).append(r)
    assert set(views) == {(1, "ann"), (1, "bob"), (2, "unknown"), (None, "eve")}
    ann = "".join(r.segment for r in views[1, "ann"])
    assert ann == ("<|system|>\nbe kind<|end|>\n<|assistant|>\nhi<|end|>\n<|assistant|>\n<\\|end|><|end|>\n<|user name=bob|>\n<|end|>\n")
    for v in views.values():
        text = "".join(r.segment for r in v)
        assert [r.position for r in v] == list(range(len(v)))
        for r in v:
            assert text[r.start:r.start + r.length] == r.segment
            if r.speaker == r.perspective:
                assert text[r.loss_start:r.loss_end].endswith("<|end|>\n") and text[:r.loss_start].endswith("<|assistant|>\n")
            else:
                assert r.loss_start is None and r.loss_end is None
    assert [r.segment for r in views[None, "eve"]].count("<|assistant|>\nb<|end|>\n") == 2
    assert rotate_perspectives(df.limit(0)).count() == 0


def test_perspectives_of_equal_turns_spread(spark):
    """One conversation whose turns are all null or all equal, most rows repeated: every
    rendering equals the one put together by hand, and no range holds it whole."""
    import goldvein.llm.chat_format as chat

    rng = random.Random(5)
    for turn in (None, 7):
        rows = [(1, turn, rng.choice(["ann", "bob"]), rng.choice(["x", "yy", "zzz"])) for _ in range(400)] + [(2, turn, "eve", "w")]
        kept = []
        real = chat.written
        chat.written = lambda df, name: kept.append(real(df, name)) or kept[-1]
        try:
            out = rotate_perspectives(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
        finally:
            chat.written = real
        assert max(r["count"] for r in kept[0].where("conv_id = 1").groupBy("bucket").count().collect()) < 300
        for who in ("ann", "bob"):
            got = sorted((r for r in out if r.conv_id == 1 and r.perspective == who), key=lambda r: r.position)
            assert [r.position for r in got] == list(range(400))
            assert [(r.speaker, r.segment.split(">\n", 1)[1]) for r in got] == [(s, t + "<|end|>\n") for _, _, s, t in sorted(rows[:400], key=lambda r: r[2:])]
            text = "".join(r.segment for r in got)
            assert all(text[r.start:r.start + r.length] == r.segment for r in got)


# ---------------------------------------------------------------- Jaccard join

def brute_components(rows):
    sets = []
    for d, x, _ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), x or ""))
        sets.append((d, {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()))
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for (a, s), (b, t) in itertools.combinations(sets, 2):
        if s and t and 100 * len(s & t) >= 75 * len(s | t) and find(a) != find(b):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets}


def test_jaccard_components_against_brute_force(spark):
    r = random.Random(4)
    voc = [f"w{i}" for i in range(2000)]
    base, passage, rows = r.choices(voc, k=120), r.choices(voc, k=60), []
    for i in range(150):
        w = [list(base), r.choices(voc, k=r.randint(0, 70)) + passage, r.choices(voc, k=r.randint(0, 12)), base[:r.randint(3, 120)]][i % 4]
        for _ in range(r.randint(0, 9) if w else 0):
            w[r.randrange(len(w))] = r.choice(voc)
        rows.append((i, " ".join(w), "s"))
    rows += [(900, "", "s"), (901, None, "s"), (902, "A b", "s"), (903, "a B", "s"), (904, rows[0][1].upper(), "s")]
    out = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard_components(docs(spark, rows)).collect()}
    assert out == brute_components(rows)


def test_jaccard_edges(spark):
    out = got(jaccard_components(docs(spark)), "doc_id", "n_shingles", "component_id")
    assert len(out) == len(EDGE) and (1, 0, 1) in out and (2, 0, 2) in out and out.count((5, 1, 4)) == 2
    assert (None, 1, 4) in out and (None, 0, None) in out
    assert jaccard_components(docs(spark, [])).count() == 0


def brute_links(rows):
    """doc_id -> how many other distinct shingle sets are similar to its own."""
    sets = {}
    for d, x, _ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), x or ""))
        sets[d] = frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
    distinct = [s for s in set(sets.values()) if s]
    links = dict.fromkeys(sets.values(), 0)
    for s, t in itertools.combinations(distinct, 2):
        if 100 * len(s & t) >= 75 * len(s | t):
            links[s] += 1
            links[t] += 1
    return {d: links[s] for d, s in sets.items()}


@pytest.mark.parametrize("block", [256, 7])
def test_jaccard_links_are_all_counted(spark, monkeypatch, block):
    monkeypatch.setattr("goldvein.llm.jaccard_join.BLOCK", block)
    r = random.Random(6)
    voc, rows = [f"w{i}" for i in range(2000)], []
    base = [r.choices(voc, k=200) for _ in range(3)]
    for i in range(90):
        w = list(base[min(i % 5, 2)])
        for _ in range(r.randint(0, 4)):
            w[r.randrange(len(w))] = r.choice(voc)
        rows.append((i, " ".join(w), "s"))
    rows += [(900, "", "s"), (901, None, "s"), (902, rows[0][1].upper(), "s"), (903, "alone", "s")]
    expected = brute_links(rows)
    assert max(expected.values()) > 10
    assert {x.doc_id: x.n_links for x in jaccard_components(docs(spark, rows)).collect()} == expected


def test_jaccard_links_cost_nothing_where_left_out(spark):
    out = jaccard_components(docs(spark, [(1, "a b c", "s"), (2, "a b c d", "s")]))
    plan = out.select("doc_id", "component_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "links" not in plan and "links" in out._jdf.queryExecution().optimizedPlan().toString()


def test_partenum_similar_sets_share_a_signature():
    r = np.random.default_rng(5)
    scheme, similar = PartEnum(), 0
    for _ in range(1500):
        n = int(np.exp(r.uniform(0, 6.5)))
        s = np.unique(r.integers(0, 2**63, n, dtype=np.uint64))
        t = np.unique(np.concatenate([r.permutation(s)[r.integers(0, n // 7 + 1):], r.integers(0, 2**63, r.integers(0, n // 3 + 1), dtype=np.uint64)]))
        i = len(np.intersect1d(s, t))
        if 4 * i >= 3 * (len(s) + len(t) - i):
            similar += 1
            assert len(np.intersect1d(scheme.signatures(s), scheme.signatures(t)))
    assert similar > 500


def test_signatures_are_as_few_as_the_errors_allow():
    """No more than one beyond the errors in each of a set's two bands, besides the bands' common ones."""
    r = np.random.default_rng(8)
    scheme = PartEnum()
    for n in (40, 90, 200, 450, 1500):
        s = np.unique(r.integers(0, 2**63, n, dtype=np.uint64))
        own = scheme.band(len(s))
        errors = sum(groups - good for groups, _, _, good in map(scheme.plan, (own - 1, own)))
        assert errors // 2 < len(scheme.signatures(s)) <= errors + 4


@pytest.mark.parametrize("settled", [1 << 20, 50, 1])
def test_rows_of_shared_sigs_whatever_their_blocks(monkeypatch, settled):
    from goldvein.llm import jaccard_join as J
    monkeypatch.setattr(J, "PACKED", 40)
    monkeypatch.setattr(J, "SETTLED", settled)
    r = np.random.default_rng(7)
    x = np.stack([r.integers(-150, 150, 600) << 40, r.integers(0, 9, 600), np.zeros(600, np.int64)])
    x[:2, ::5] = np.array([[7], [3]])  # a sig of many copies of one node
    x[0, ::7] = 11  # and one of all nodes
    x[2] = x[1] * 10
    nodes = {}
    for sig, node, _ in x.T.tolist():
        nodes.setdefault(sig, set()).add(node)
    packed = [b.to_pydict() for b in J._packed((x[:, i:i + 9] for i in range(0, 600, 9)), 3)]
    out = []
    for part in range(3):
        blocks = [[v for k, v in zip(b["part"], b["block"], strict=True) if k == part] for b in packed]
        found = J._settled((pa.array(b, pa.binary()) for b in blocks), ["sig", "node", "n"])
        out += [tuple(row.values()) for b in found for row in b.to_pylist()]
    assert set(out) == {(s, n, 10 * n) for s, some in nodes.items() if len(some) > 1 for n in some}
    assert settled < 1 << 20 or len(out) == len(set(out))
    assert list(J._settled(iter([]), ["sig", "node"])) == list(J._packed(iter([]), 3)) == []


def test_signatures_cross_the_exchange_in_blocks(spark):
    """Few of the signatures are shared: the others never become rows that Spark sorts."""
    from goldvein.llm import jaccard_join as J
    r = random.Random(3)
    texts = [" ".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=300)) for _ in range(40)]
    texts.append(texts[0] + " z")
    m = J.buckets(docs(spark, [(i, t, "s") for i, t in enumerate(texts)]).select(F.col("text").alias("t")))
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert "block" in plan and "Sort" not in plan
    by_sig = {}
    for sig, node, n in m.collect():
        by_sig.setdefault(sig, set()).add((node, n))
    assert by_sig and all({n for _, n in x} == {len(J.shingles(texts[0])), len(J.shingles(texts[-1]))} for x in by_sig.values())


# ---------------------------------------------------------------- repeated passages

def brute_spans(rows):
    places = {}
    for d, t, _ in rows:
        w = (t or "").split()
        for i in range(len(w) - LENGTH + 1):
            places.setdefault(tuple(w[i:i + LENGTH]), []).append((d, i))
    hit, later = {}, {}
    for at in places.values():
        for k, (d, i) in enumerate(sorted(at)):
            if len(at) > 1:
                hit.setdefault(d, set()).update(range(i, i + LENGTH))
                if k:
                    later.setdefault(d, set()).update(range(i, i + LENGTH))
    return hit, later


def test_repeated_passages_against_brute_force(spark):
    r = random.Random(6)
    voc = [f"w{i}" for i in range(3000)]
    passages = [r.choices(voc, k=k) for k in (49, 50, 51, 80, 200)]
    rows = []
    for i in range(60):
        w = []
        for _ in range(r.randint(1, 3)):
            p = r.choice(passages)
            a = r.randint(0, 5)
            w += r.choices(voc, k=r.randint(0, 40)) + p[a if len(p) > 60 else 0:]
        rows.append((i, " ".join(w), "s"))
    rows += [(100, rows[3][1], "s"), (101, rows[3][1], "s"), (102, " ".join(["la"] * 120), "s")]
    hit, later = brute_spans(rows)
    out = repeated_passages(docs(spark, rows)).collect()
    cover = lambda spans: {p for s in spans for p in range(s["start"], s["end"])}
    assert {r.doc_id: cover(r.spans) for r in out} == hit
    assert {r.doc_id: cover(r.later) for r in out if r.later} == later
    kept = {r.doc_id: r.text for r in without_later_passages(docs(spark, rows)).collect()}
    for d, t, _ in rows:
        rest = " ".join(w for i, w in enumerate(t.split()) if i not in later.get(d, set()))
        assert kept.get(d, "").split() == rest.split()
        assert (d in kept) == bool(rest)


def test_spans_of_texts_are_built_few_texts_at_a_time(spark, monkeypatch):
    """The hits of all texts of a task are never one batch: batches of the span step hold few texts, their hits as numbers."""
    seen, write = {}, S.written

    def watched(df, name):
        seen[name] = (int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")), df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)
    monkeypatch.setattr(S, "written", watched)
    assert repeated_passages(docs(spark, [(i, LONG, "s") for i in range(3)])).count() == 3
    batch, plan = seen["placed"]
    assert batch <= 256 and "MapInArrow" in plan and "MapInPandas" not in plan
    # Against one text after another, with texts without a start between others.
    r = random.Random(8)
    starts = [sorted(r.sample(range(400), r.choice([0, 0, 1, 2, 9, 60]))) for _ in range(40)]
    want = []
    for at in starts:
        want.append([])
        for p in at:
            if want[-1] and p <= want[-1][-1]["end"]:
                want[-1][-1]["end"] = p + LENGTH
            else:
                want[-1].append({"start": p, "end": p + LENGTH})
    flat, text = np.array([p for at in starts for p in at]), np.repeat(np.arange(40), [len(at) for at in starts])
    assert S.span_lists(flat, text, 40).to_pylist() == want
    assert S.span_lists(flat[:0], text[:0], 2).to_pylist() == [[], []] and len(S.span_lists(flat[:0], text[:0], 0)) == 0


def test_repeated_passages_edges(spark):
    two = [(9, LONG, "b"), (None, LONG, "b")]
    out = {r.doc_id: r for r in repeated_passages(docs(spark, EDGE + two)).collect()}
    assert set(out) == {6, 9, None}
    assert out[6].spans[0].asDict() == {"start": 0, "end": 60_000} and out[9].later == out[9].spans and out[None].later == out[None].spans
    assert out[6].later[0]["start"] > 0      # its own later rounds
    same = docs(spark)
    after = without_later_passages(same)
    assert after.columns == same.columns and after.count() == len(EDGE) and without_later_passages(docs(spark, [])).count() == 0
    assert cut("a b  c\nd", [{"start": 1, "end": 3}]) == "a d" and cut("a b", [{"start": 0, "end": 2}]) == ""


# ---------------------------------------------------------------- quality and toxicity

def test_isotonic_is_monotone_and_keeps_the_mean():
    r = np.random.default_rng(7)
    x, w = np.sort(r.random(200)), r.integers(1, 9, 200).astype(float)
    y = (r.random(200) < x).astype(float)
    at, value = isotonic(x, y, w)
    assert (np.diff(value) > 0).all() and (np.diff(at) > 0).all()
    assert np.allclose(isotonic(x, x, w)[1], x)
    assert statistics_of("").sum() == 0 and np.isfinite(statistics_of(LONG)).all()


def test_quality_edges(spark):
    out = quality_scores(docs(spark), labels(spark, [(1, None, None), (None, 1, 0)]))
    assert got(out, "score", "predicted") == [(0.5, 1)] * len(EDGE)
    assert quality_scores(docs(spark, []), labels(spark, [])).count() == 0
    one = quality_scores(docs(spark), labels(spark, [(i, 1, 0) for i in range(1, 9)])).collect()
    assert all(0 <= r.score <= 1 for r in one) and len(one) == len(EDGE)


def test_quality_held_out_accuracy(spark):
    r = random.Random(8)
    voc = ["".join(r.choices("aeioulnrst", k=r.randint(2, 8))) for _ in range(3000)]
    rows, marks = [], []
    for i in range(500):
        w = r.choices(voc, k=r.randint(30, 200))
        bad = i % 4 == 0
        rows.append((i, " ".join(x + "$$$" if bad and r.random() < 0.6 else x for x in w), "s"))
        marks.append((i, int(not bad), 0))
    out = quality_scores(docs(spark, rows), labels(spark, marks)).where("held_out").collect()
    assert len(out) > 60 and np.mean([r.predicted == int(r.doc_id % 4 != 0) for r in out]) > 0.95


def test_toxicity_held_out_accuracy_and_edges(spark):
    r = random.Random(9)
    voc = ["".join(r.choices("aeioulnrst", k=r.randint(3, 9))) for _ in range(1500)]
    rows, marks = [], []
    for i in range(600):
        w = r.choices(voc, k=r.randint(30, 120))
        if i % 5 == 0:
            for _ in range(r.randint(1, 4)):
                w[r.randrange(len(w))] = r.choice(["idiot", "Moron,", "zubrik", "zubrikam", "zubrikol"])
        rows.append((i, " ".join(w), "s"))
        marks.append((i, 1, int(i % 5 == 0)))
    out = toxicity_scores(docs(spark, rows + [(None, None, "s"), (7000, "", "s")]), labels(spark, marks)).collect()
    held = [x for x in out if x.held_out and x.doc_id < 600]
    wrong = sum(x.predicted != int(x.doc_id % 5 == 0) for x in held)
    assert len(out) == 602 and len(held) > 150 and wrong <= 0.05 * len(held)
    assert all(x.predicted == 0 for x in out if x.doc_id is None or x.doc_id == 7000)
    plain = got(toxicity_scores(docs(spark, [(1, "you idiot", "s"), (2, None, "s")]), labels(spark, [])), "doc_id", "score", "predicted")
    assert plain == [(1, 0.9, 1), (2, 0.1, 0)] and toxicity_scores(docs(spark, []), labels(spark, [])).count() == 0


def test_toxicity_scores_keep_the_share_beyond_the_caps(spark, monkeypatch):
    r = random.Random(11)
    voc = ["".join(r.choices("aeioulnrst", k=r.randint(3, 9))) for _ in range(300)]
    rows, marks = [], []
    for i in range(1500):
        # Half of the texts with an insult are labelled clean: their score tells the share that was learned from.
        w = r.choices(voc, k=40) + (["idiot"] if i % 10 < 2 else [])
        rows.append((i, " ".join(w), "s"))
        marks.append((i, 1, int(i % 10 == 0)))

    def mean_score():
        out = toxicity_scores(docs(spark, rows), labels(spark, marks)).where("doc_id % 10 < 2").agg(F.avg("score")).first()[0]
        return np.log(out / (1 - out))

    whole = mean_score()
    monkeypatch.setattr("goldvein.llm.toxicity.SAMPLE_TOXIC", 60)
    monkeypatch.setattr("goldvein.llm.toxicity.SAMPLE_CLEAN", 120)
    assert abs(mean_score() - whole) < 0.5  # 1:2 instead of 1:9 would shift it by about 1.5


# ---------------------------------------------------------------- packing

def test_plans_use_every_piece_and_never_overflow():
    for seed in range(8):
        r = np.random.default_rng(seed)
        lengths = np.clip(r.lognormal(5.5, 1.2, [1, 7, 60, 700, 6000, 40, 300, 20000][seed]).astype(int), 1, 1024)
        histogram = {int(a): int(b) for a, b in zip(*np.unique(lengths, return_counts=True))}
        plan = packing.plan_patterns(histogram, 1024)
        used = {}
        for group, times in plan:
            assert sum(group) <= 1024 and times > 0
            for x in group:
                used[x] = used.get(x, 0) + times
        assert used == histogram
        assert sum(t for _, t in plan) <= -(-int(lengths.sum()) * 1.03 // 1024) + 1


def test_complements_are_exact():
    lengths = packing.Lengths({5: 1, 3: 2, 2: 1}, 20)
    assert lengths.complement(5) == [5] and lengths.complement(6) == [3, 3] and lengths.complement(10) == [5, 3, 2]
    assert lengths.complement(11) == [5, 3, 3] and lengths.complement(9) is None and lengths.complement(4) is None


def test_pack_documents(spark):
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    rows = EDGE + [(20 + i, "Don't <|endoftext|> stop " * i, "s") for i in range(60)]
    out = packing.pack_documents(docs(spark, rows), path).collect()
    by_seq = {}
    for r in out:
        by_seq.setdefault(r.sequence_id, []).append(r)
    for rs in by_seq.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
    want = sorted(len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, _ in rows)
    assert sum(r.length for r in out) == sum(want) and sum(r.piece == 0 for r in out) == len(rows)
    assert all(r.length == 4096 for r in out if any(s.doc_id == r.doc_id and s.piece == r.piece + 1 for s in out))
    assert len(by_seq) <= -(-sum(want) // 4096) + 1
    assert packing.pack_documents(docs(spark, []), path).count() == 0


# ---------------------------------------------------------------- byte-pair coding

@pytest.fixture(scope="module")
def codec():
    with open(tokenizer_path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return bpe.Codec(f.read())


def test_round_trip_equals_the_library(spark, codec):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    r = random.Random(10)
    parts = ["a", " ", "  ", "\n", "'s", "'", "é", "日本", "1", "!", "<|endoftext|>", "<|endof", "\xa0", "\x0b", "\x1c", "the", "́", "🙂", "\r\n"]
    texts = ["".join(r.choices(parts, k=r.randint(0, 60))) for _ in range(400)]
    texts += ["a" * 60_000, " " * 40_000 + "x", "\n" * 30_000, "'s" * 12_000, "theing" * 9_000 + "'s" + "z" * 9_000, LONG,
              "".join(r.choices("etaoin", k=40_000)) + " " * 20_000]
    for t in texts:
        ids = bpe.encode_text(codec, t)
        e = tok.encode(t, add_special_tokens=False).ids
        assert ids == e and bpe.decode_ids(codec, ids) == tok.decode(e, skip_special_tokens=False)
        if len(t) < 100:
            for n in (1, 2, 7):
                assert bpe.encode_text(codec, t, n) == e and bpe.decode_ids(codec, e, n) == bpe.decode_ids(codec, e)
    out = {x.doc_id: x for x in bpe.bpe_round_trip(docs(spark), tokenizer_path("byte_bpe_50k.json")).collect()}
    assert out[1].ids == [] and out[1].decoded == "" and out[6].decoded == LONG and out[8].decoded == EDGE[-1][1]
    assert bpe.bpe_round_trip(docs(spark, []), tokenizer_path("byte_bpe_50k.json")).count() == 0


def test_decoder_replaces_broken_bytes(codec):
    byte = {v[0]: i for i, v in codec.bytes_of.items() if len(v) == 1}
    assert bpe.decode_ids(codec, [byte[0xE6], byte[0x97], byte[0x41]], 1) == "�A"


def test_lookahead_is_sufficient(codec):
    # Windows that start at a settled place and see the lookahead give the tokens of the whole.
    r = random.Random(12)
    for letters in ("ab", "etaoinshr", "aaab", "sie"):
        data = "".join(r.choices(letters, k=6 * codec.lookahead)).encode()
        stream = bpe.PieceStream(codec)
        assert stream.feed(data) + stream.finish() == codec.merge(data)
    for n in (0, 1, 2, 9, 60):
        data = bytes(r.choices(b"theinglya", k=n))
        assert codec.merge_short(data) == codec.merge(data)
    with pytest.raises(ValueError):
        bpe.sufficient_lookahead([(0, 2, 3), (0, 1, 2)], {0: 1, 1: 1, 2: 2, 3: 3})


# ---------------------------------------------------------------- main text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav><!-- ad --><div class="ad">Buy this now.</div>
<article><h1>Head &amp; line</h1><p>First <b>bold</b>ly&nbsp;said.<br>More words of the story go here.<p>Second paragraph
with   a break, and enough words to be one.</article><div id="comments"><p>Nice post!</div><footer>&copy; us</footer></body></html>"""


def test_blocks_of_a_page():
    blocks = html_extract.blocks_of(PAGE)
    texts = [t for _, t, _ in blocks]
    assert texts == ["T", "One", "Two", "Buy this now.", "Head & line", "First boldly said. More words of the story go here.",
                     "Second paragraph with a break, and enough words to be one.", "Nice post!", "© us"]
    assert [html_extract.markup_label(p) for p, _, _ in blocks] == [0, 0, 0, 0, 1, 1, 1, 0, 0]
    assert html_extract.blocks_of("") == [] and html_extract.blocks_of("<!-- <p>x") == [] and html_extract.blocks_of("<script>x") == []
    assert [t for _, t, _ in html_extract.blocks_of("plain <3 & text")] == ["plain <3 & text"]


def test_gradients_agree_with_differences():
    r = np.random.default_rng(13)
    net = html_extract.Labeller()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, lengths = r.standard_normal((5, 3, html_extract.DIM)), np.array([5, 3, 1])
    x *= (np.arange(5)[:, None] < lengths[None])[..., None]
    y = (r.random((5, 3)) < 0.5).astype(float)

    def loss():
        p = net.probabilities(x, lengths)
        m = np.arange(5)[:, None] < lengths[None]
        return -np.log(np.where(y > 0.5, p, 1 - p))[m].mean()

    g = net.gradients(x, lengths, y)
    for k in ("wxf", "whb", "bb", "wo", "wxb", "whf"):
        i = tuple(r.integers(s) for s in net.p[k].shape)
        was = net.p[k][i]
        net.p[k][i] = was + 1e-4
        up = loss()
        net.p[k][i] = was - 1e-4
        down = loss()
        net.p[k][i] = was
        assert abs(g[k][i] - (up - down) / 2e-4) < 1e-3


def test_extract_main_text(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    extra = spark.createDataFrame([(900, "u", None), (901, None, ""), (902, "u", PAGE), (None, "u", "<p>" + "word " * 50_000)],
                                  "page_id long, url string, html string")
    out = {r.page_id: r for r in html_extract.extract_main_text(pages.unionByName(extra).withColumn("text", F.lit(1))).collect()}
    assert out[900].text == "" and out[901].text == "" and len(out) == pages.count() + 4
    wrong = 0
    for r in pages.collect():
        want = " ".join(t for p, t, _ in html_extract.blocks_of(r.html) if html_extract.markup_label(p))
        wrong += out[r.page_id].text != want
    assert wrong <= 1
    assert "First boldly said." in out[902].text and "Nice post" not in out[902].text and "Buy this" not in out[902].text
    assert html_extract.extract_main_text(pages.limit(0)).count() == 0


def test_labeller_trains_on_whole_pages(monkeypatch):
    from goldvein.llm import html_extract as he
    seen = []
    monkeypatch.setattr(he.Labeller, "fit", lambda self, pages: seen.extend(len(y) for _, y in pages))
    page = "<html><body><article>" + "".join(f"<p>Paragraph number {i} of a long page.</p>" for i in range(200)) + "</article></body></html>"
    he.train_labeller([page], variations=0)
    he.train_labeller([page, page, "<p>short</p>"], variations=0, sample_blocks=300)  # the second does not fit, the third does
    assert seen == [200, 200, 1]


def test_labeller_groups_bound_padding():
    from goldvein.llm.html_extract import groups_of
    lengths = [10, 9000, 3, 5, 20000, 7]
    got_groups = list(groups_of(np.arange(6), lengths, 2))
    assert [k for g in got_groups for k in g] == list(range(6))
    assert all(len(g) == 1 or len(g) <= 2 and len(g) * max(lengths[k] for k in g) <= 16_384 for g in got_groups)


def test_shingle_sets_equal_single_texts():
    from goldvein.llm.jaccard_join import shingle_sets, shingles
    texts = ["", " \n ", "a", "a b c", "a b c d e", " x y z a b c x y z a b c x y z a b c\n", "A B c D e f", "\u00e9t\u00e9 " * 30]
    values, bounds = shingle_sets(texts)
    assert all(np.array_equal(values[bounds[i]:bounds[i + 1]], shingles(t)) for i, t in enumerate(texts))


def test_sketches_of_unlike_sizes_bound_the_difference():
    from goldvein.llm.jaccard_join import _apart, sketch
    r = np.random.default_rng(3)
    for n, m in ((60, 70), (300, 250), (1000, 1100), (5, 5)):
        both = np.unique(r.integers(0, 2**63, n + m, dtype=np.uint64))
        a, b = both[:n], both[n // 2:]
        assert _apart([sketch(a)], [sketch(b)])[0] <= len(np.setxor1d(a, b))
        assert _apart([sketch(a)], [sketch(a)])[0] == 0


@pytest.mark.parametrize("block", [8, 512])
def test_prefix_pairs_of_a_family_are_told_apart_within_their_key(spark, monkeypatch, block):
    """Sixty texts that share much but are not similar, and five similar ones: all similar pairs come, hardly any other."""
    from goldvein.llm import jaccard_join as J
    monkeypatch.setattr(J, "KEY_BLOCK", block)
    rng = random.Random(9)
    base = [f"b{i}" for i in range(100)]
    texts = []
    for k in range(60):
        own = rng.sample(range(100), 8)
        texts.append(" ".join(f"x{k}-{i}" if i in own else w for i, w in enumerate(base)))
    texts += [" ".join([*base[:90], *[f"y{k}{i}" for i in range(4)]]) for k in range(5)]
    rows = list(enumerate(texts))
    sets = [set(J.shingles(t).tolist()) for t in texts]
    similar = {(a, b) for a in range(len(rows)) for b in range(a + 1, len(rows)) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    nodes = spark.createDataFrame([(i, i) for i, _ in rows], "node long, component long")
    reps = spark.createDataFrame([(i, bytearray(J.sketch(J.shingles(t), J.CELLS))) for i, t in rows], "node long, sketch binary")
    out = [tuple(r) for r in J.prefix_pairs(nodes, spark.createDataFrame(rows, "node long, t string"), reps).collect()]
    assert len(out) == len(set(out)) and similar <= set(out) and len(similar) >= 10
    assert len(out) < 0.2 * 65 * 64 / 2
