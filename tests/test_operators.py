"""Operators against brute-force Python on hand-made and small inputs."""

import collections
import datetime as dt
import itertools
import math
import random

import pytest
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from goldvein.operators import anomaly, duplicates, features, incremental, mdm, quality, security, skew
from goldvein.functions.masks import AccessContext
from goldvein.sources.fixtures import ts

D = dt.date


# ---------------------------------------------------------------- features

def brute_features(rows, lookback=365):
    out = {}
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    for k, rs in by.items():
        rs = sorted(rs, key=lambda r: (r[2], r[0]))
        for i, r in enumerate(rs):
            gap = None if i == 0 else (r[2] - rs[i - 1][2]).days
            frame = [x for x in rs if 0 <= (r[2] - x[2]).days <= lookback]
            vals = [x[3] for x in frame if x[3] is not None]
            out[r[0]] = (gap, len(frame), sum(vals) if vals else None)
    return out


def test_engagement_features_edges(spark):
    rows = [("e1", "c1", D(2024, 1, 1), Decimal("10.00")), ("e2", "c1", D(2024, 1, 1), Decimal("5.00")),
            ("e3", "c1", D(2024, 12, 31), None), ("e4", "c1", D(2025, 1, 1), Decimal("1.00")),
            ("e5", "c1", D(2025, 1, 2), Decimal("2.00")), ("e6", "c2", D(2024, 5, 5), None),
            ("e7", None, D(2024, 1, 1), Decimal("3.00")), ("e8", None, D(2024, 1, 3), Decimal("4.00")),
            ("e9", "c1", D(2024, 1, 2), Decimal("1.00"))]
    df = spark.createDataFrame(rows, "event_id string, contact_key string, event_date date, "
                                     "revenue_amount decimal(12,2)")
    got = {r.event_id: (r.days_since_last_event, r.events_last_12m,
                        r.revenue_last_12m) for r in features.engagement_features(df).collect()}
    exp = brute_features(rows)
    assert got == exp
    assert got["e2"][0] == 0 and got["e1"][0] is None        # same date: first sees the gap
    # 2025-01-01: 2024-01-02 is day -365 (in), 2024-01-01 is day -366 (out)
    assert got["e4"][1] == 3 and got["e5"][1] == 3
    assert got["e6"][2] is None                              # all-NULL revenue stays NULL


def test_engagement_features_random(spark):
    rnd = random.Random(7)
    rows = [(f"e{i:04d}", f"c{rnd.randrange(6)}", D(2020, 1, 1) + dt.timedelta(days=rnd.randrange(900)),
             Decimal(rnd.randrange(0, 100000)) / 100 if rnd.random() > 0.1 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "event_id string, contact_key string, event_date date, "
                                     "revenue_amount decimal(12,2)")
    got = {r.event_id: (r.days_since_last_event, r.events_last_12m, r.revenue_last_12m)
           for r in features.engagement_features(df).collect()}
    assert got == brute_features(rows)


# ---------------------------------------------------------------- mdm

def _scored(spark, rows):
    return spark.createDataFrame(rows, "email string, contact_key string, dq_score int, "
                                       "created_at timestamp_ntz, source_system string, source_id string")


def _full(df):
    cols = {"first_name": F.lit("F"), "last_name": F.lit("L"), "phone": F.lit(None).cast("string"),
            "company_name": F.lit(None).cast("string"), "job_title": F.lit(None).cast("string"),
            "updated_at": F.col("created_at"), "ingested_at": F.col("created_at")}
    return df.withColumns(cols)


def test_golden_ties_and_null_created(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("a@x.io", "k1", 80, t, "CRM", "2"), ("a@x.io", "k2", 80, t, "CRM", "1"),
            ("a@x.io", "k3", 40, None, "EVENTS", "9"), ("a@x.io", "k4", 40, t - dt.timedelta(days=1), "Z", "0"),
            ("b@x.io", "k5", 25, None, "CRM", "5")]
    g = mdm.golden_records(_full(_scored(spark, rows)), ts("2024-02-01 00:00:00"))
    got = {r.email: (r.contact_key, r.mdm_golden_id, r.dedup_rank) for r in g.collect()}
    # best score, then earliest, then source: k2 survives; golden id = earliest created (k4)
    assert got == {"a@x.io": ("k2", "k4", 1), "b@x.io": ("k5", "k5", 1)}
    earliest = mdm.golden_records(_full(_scored(spark, rows)), ts("2024-02-01 00:00:00"), prefer="earliest")
    assert {r.email: r.contact_key for r in earliest.collect()}["a@x.io"] == "k4"


def test_row_number_hot_path_matches_window(spark):
    rnd = random.Random(3)
    rows = [(("hot" if rnd.random() < 0.6 else f"k{rnd.randrange(20)}"), rnd.randrange(5), i) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, s int, i int")
    order = [F.col("s").desc(), F.col("i").asc()]
    plain = {r.i: r.rn for r in df.withColumn("rn", F.row_number().over(
        Window.partitionBy("k").orderBy(*order))).collect()}
    split = {r.i: r.rn for r in skew.row_number_within(df, ["k"], order, "rn",
                                                           range_partitions=6).collect()}
    assert split == plain


def test_pairs_within_groups_blocks(spark):
    rows = [("g1", i) for i in range(37)] + [("g2", i) for i in range(5)] + [("g3", 1)]
    df = spark.createDataFrame(rows, "g string, item int")
    got = sorted((r.g, r.item_a, r.item_b) for r in skew.pairs_within_groups(df, "g", "item", 8).collect())
    exp = sorted((g, a, b) for g in ("g1", "g2", "g3") for a, b in itertools.combinations(
        sorted(i for gg, i in rows if gg == g), 2))
    assert got == exp


def test_steward_queue_ranks(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("a@x.io", f"k{i}", 100 - i, t, "CRM", str(i)) for i in range(5)]
    q = mdm.steward_queue(_full(_scored(spark, rows)), ts("2024-02-01 00:00:00"))
    assert sorted((r.contact_key, r.dedup_rank) for r in q.collect()) == [
        ("k1", 2), ("k2", 3), ("k3", 4), ("k4", 5)]


# ---------------------------------------------------------------- duplicates

def brute_pairs(texts, t, inclusive=False):
    def vec(s):
        s = s.lower()
        v = {}
        for i in range(len(s) - 2):
            v[s[i:i + 3]] = v.get(s[i:i + 3], 0) + 1
        return v
    vs = {k: vec(s) for k, s in texts.items()}
    out = {}
    for a, b in itertools.combinations(sorted(texts), 2):
        va, vb = vs[a], vs[b]
        if not va or not vb:
            continue
        dot = sum(c * vb.get(g, 0) for g, c in va.items())
        sim = dot / math.sqrt(sum(c * c for c in va.values()) * sum(c * c for c in vb.values()))
        if sim > t or (inclusive and sim >= t):
            out[(a, b)] = sim
    return out


def test_similar_pairs_equals_brute_force_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    # whole texts of the short documents keep the brute force cheap
    small = docs.where(F.length("text") < 400)
    texts = {r.doc_id: r.text for r in small.collect()}
    for t in (0.5, 0.92):
        got = {(r.doc_id_a, r.doc_id_b): r.similarity for r in
               duplicates.similar_pairs(small, "doc_id", "text", t, block_rows=7).collect()}
        exp = brute_pairs(texts, t)
        assert set(got) == set(exp)
        assert all(abs(got[k] - exp[k]) < 1e-12 for k in exp)


def test_similar_pairs_repeated_terms_and_bounds(spark):
    # Short strings over a tiny alphabet: many repeated trigrams (tf > 1),
    # very different lengths, and scores close to every threshold, so the
    # candidate bounds and the repeat correction are both exercised.
    rng = random.Random(7)
    texts = {i: "".join(rng.choice("ab ") for _ in range(rng.randint(3, 40))) for i in range(160)}
    texts.update({1000 + i: texts[i] + "a" for i in range(0, 160, 9)})
    df = spark.createDataFrame(sorted(texts.items()), "id int, text string")
    for t, inclusive in ((0.6, False), (0.85, True), (0.95, False), (0.999, True)):
        got = {(r.id_a, r.id_b): r.similarity for r in
               duplicates.similar_pairs(df, "id", "text", t, block_rows=5, inclusive=inclusive).collect()}
        exp = brute_pairs(texts, t, inclusive)
        assert set(got) == set(exp), (t, len(got), len(exp))
        assert all(abs(got[k] - exp[k]) < 1e-12 for k in exp)


def test_potential_duplicates_copies_and_threshold(spark):
    rows = [("k1", "a@x", "Ann", "Lee", "Acme"), ("k2", "b@x", "Ann", "Lee", "Acme"),
            ("k3", "c@x", "Ann", "Lee", "Acme"), ("k4", "a@x", "Ann", "Lee", "Acme"),
            ("k5", "d@x", "Ann", "Lee", "Acmf"), ("k6", "e@x", "Bob", None, "Acme"),
            ("k7", "f@x", "Zed", "Quux", None)]
    df = spark.createDataFrame(rows, "contact_key string, email string, first_name string, "
                                     "last_name string, company_name string")
    got = {(r.contact_key_a, r.contact_key_b): round(r.similarity_score, 9)
           for r in duplicates.potential_duplicates(df, threshold=0.8).collect()}
    names = {k: f"{f} {l} {c or ''}" for k, e, f, l, c in rows if l is not None}
    emails = {k: e for k, e, *_ in rows}
    exp = {}
    for (a, b), s in brute_pairs(names, 0.8).items():
        exp[(a, b)] = round(s, 9)
    for a, b in itertools.combinations(sorted(names), 2):
        if names[a] == names[b]:
            exp[(a, b)] = 1.0
    exp = {k: v for k, v in exp.items() if emails[k[0]] != emails[k[1]]}
    assert got == exp
    assert ("k1", "k4") not in got                          # same e-mail excluded


def test_connected_groups(spark):
    edges = [("a", "b"), ("b", "c"), ("d", "e"), ("f", "f"), ("c", "a"), ("x", "y"), ("y", "z"), ("z", "w")]
    df = spark.createDataFrame(edges, "contact_key_a string, contact_key_b string")
    got = sorted(map(tuple, mdm.connected_groups(df).collect()))
    assert got == [("a", "a"), ("b", "a"), ("c", "a"), ("d", "d"), ("e", "d"), ("w", "w"), ("x", "w"), ("y", "w"), ("z", "w")]


def test_connected_groups_leaf_between_two_centres(spark):
    # Stopping as soon as no centre is a leaf would leave node 3 in two groups.
    df = spark.createDataFrame([(4, 3), (5, 3), (4, 1), (5, 2)], "contact_key_a long, contact_key_b long")
    assert sorted(map(tuple, mdm.connected_groups(df).collect())) == [(i, 1) for i in range(1, 6)]


def test_connected_groups_random_sparse_graphs(spark):
    # 200 random graphs at once, as disjoint ranges of node numbers.
    rng = random.Random(11)
    edges = [(1000 * g + rng.randrange(12), 1000 * g + rng.randrange(12)) for g in range(200) for _ in range(rng.randrange(1, 10))]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for u, v in edges:
        a, b = find(u), find(v)
        parent[max(a, b)] = min(a, b)
    nodes = {x for u, v in edges if u != v for x in (u, v)}
    df = spark.createDataFrame(edges, "contact_key_a long, contact_key_b long")
    assert sorted(map(tuple, mdm.connected_groups(df).collect())) == sorted((x, find(x)) for x in nodes)


def test_merge_fails_on_a_repeated_source_key(spark):
    target = _silver_rows(spark, [("k1", "a@x", "1", 50, "s1")])
    source = _silver_rows(spark, [("k1", "b@x", "2", 60, "s2"), ("k1", "c@x", "3", 70, "s3")])
    with pytest.raises(Exception, match="repeats the key"):
        incremental.merge_upsert(target, source, update_columns=("email",)).collect()


def test_connected_groups_long_chains_match_union_find(spark):
    # Shuffled node names on long paths plus random extra edges: the
    # propagation with pointer jumps must give every node its component's
    # smallest name, as a union-find does.
    rng = random.Random(3)
    names = [f"n{i:04d}" for i in range(300)]
    rng.shuffle(names)
    edges = [(names[i], names[i + 1]) for i in range(0, 199)]          # one path of 200 nodes
    edges += [(names[i], names[i + 1]) for i in range(200, 259)]       # one path of 60 nodes
    edges += [(rng.choice(names[260:]), rng.choice(names[260:])) for _ in range(30)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for u, v in edges:
        if u != v:
            ru, rv = find(u), find(v)
            parent[max(ru, rv)] = min(ru, rv)
    nodes = {x for u, v in edges if u != v for x in (u, v)}
    df = spark.createDataFrame(edges, "contact_key_a string, contact_key_b string")
    got = sorted(map(tuple, mdm.connected_groups(df).collect()))
    assert got == sorted((x, find(x)) for x in nodes)


# ---------------------------------------------------------------- incremental

def _silver_rows(spark, rows):
    return spark.createDataFrame(rows, "contact_key string, email string, phone string, dq_score int, "
                                       "source_id string")


def test_merge_semantics_and_idempotence(spark):
    target = _silver_rows(spark, [("k1", "a@x", "1", 50, "s1"), ("k2", "b@x", "2", 60, "s2")])
    source = _silver_rows(spark, [("k2", "b2@x", "22", 70, "new"), ("k3", "c@x", "3", 80, "s3")]) \
        .withColumn("extra", F.lit("E"))
    upd = ("email", "phone", "dq_score")
    m1 = incremental.merge_upsert(target, source, "contact_key", upd)
    got = {r.contact_key: tuple(r) for r in m1.collect()}
    assert got["k1"] == ("k1", "a@x", "1", 50, "s1", None)        # untouched target row
    assert got["k2"] == ("k2", "b2@x", "22", 70, "s2", None)      # only listed columns change
    assert got["k3"] == ("k3", "c@x", "3", 80, "s3", "E")         # inserted whole
    m2 = incremental.merge_upsert(m1, source, "contact_key", upd)
    assert sorted(map(tuple, m2.collect()), key=str) == sorted(map(tuple, m1.collect()), key=str)


def test_incremental_scan_bound_is_strict(spark):
    t = dt.datetime(2024, 1, 20)
    target = spark.createDataFrame([(t,)], "ingested_at timestamp_ntz")
    src = spark.createDataFrame([(t - dt.timedelta(days=3),), (t - dt.timedelta(days=3, seconds=-1),), (t,)],
                                "ingested_at timestamp_ntz")
    got = sorted(r[0] for r in incremental.incremental_scan(src, target).collect())
    assert got == [t - dt.timedelta(days=3, seconds=-1), t]
    assert incremental.incremental_scan(src, None).count() == 3
    fetched = sorted(r[0] for r in incremental.incremental_scan(src, target, fetch_bound=True).collect())
    assert fetched == got
    empty = spark.createDataFrame([], "ingested_at timestamp_ntz")
    assert incremental.incremental_scan(src, empty).count() == 3     # 1900-01-01 default


# ---------------------------------------------------------------- quality

def test_null_rate_empty_and_boundary(spark):
    empty = spark.createDataFrame([], "a string")
    r = quality.null_rates(empty, "m", ["a"]).collect()[0]
    assert (r.total_rows, r.null_pct, r.result) == (0, None, "PASS")
    rows = [(None,)] + [("x",)] * 19            # exactly 5.00 %
    r = quality.null_rates(spark.createDataFrame(rows, "a string"), "m", ["a"]).collect()[0]
    assert (r.null_count, r.null_pct, r.result) == (1, 5.0, "PASS")
    r = quality.null_rates(spark.createDataFrame(rows[:19], "a string"), "m", ["a"]).collect()[0]
    assert (r.null_pct, r.result) == (5.26, "FAIL")


def test_freshness_boundaries(spark):
    asof = dt.datetime(2024, 2, 1)
    def res(delta):
        df = spark.createDataFrame([(asof - delta,)], "t timestamp_ntz")
        return quality.freshness(df, "m", "t", ts("2024-02-01 00:00:00")).collect()[0]
    assert res(dt.timedelta(hours=24)).result == "PASS"
    assert res(dt.timedelta(hours=25)).result == "WARN"
    assert res(dt.timedelta(hours=48)).result == "WARN"
    assert res(dt.timedelta(hours=49)).result == "ERROR"
    empty = spark.createDataFrame([], "t timestamp_ntz")
    assert quality.freshness(empty, "m", "t", ts("2024-02-01 00:00:00")).collect()[0].result == "PASS"


def test_dq_gate(spark):
    def gate(rows):
        df = spark.createDataFrame(rows, "dq_score int, silver_processed_at timestamp_ntz")
        return tuple(quality.dq_gate(df, ts("2024-02-01 10:00:00")).collect()[0])
    today, old = dt.datetime(2024, 2, 1, 1), dt.datetime(2024, 1, 31)
    assert gate([(75, today), (100, old)]) == (75.0, "dq_passed")
    assert gate([(74, today), (76, today), (0, old)]) == (75.0, "dq_passed")
    assert gate([(100, old)]) == (0.0, "dq_failed_quarantine")


def test_dq_summary_boundaries(spark):
    df = spark.createDataFrame([(49,), (50,), (79,), (80,)], "dq_score int")
    r = quality.dq_summary(df, "m", ts("2024-02-01 00:00:00")).collect()[0]
    assert (r.total_rows, r.avg_dq_score, r.min_dq_score, r.low_quality_rows, r.high_quality_rows) == \
        (4, 64.5, 49, 1, 1)


# ---------------------------------------------------------------- anomaly, security

def test_anomaly_groups(spark):
    rows = [(str(i), "g1", float(v)) for i, v in enumerate([10] * 20 + [1000])] + \
           [("s", "single", 5.0), ("c1", "const", 2.0), ("c2", "const", 2.0), ("n", "neg", -1.0),
            ("z", None, 3.0)]
    df = spark.createDataFrame(rows, "k string, g string, v double")
    got = {r.k: r for r in anomaly.anomaly_flags(df, "k", "g", "v", ts("2024-02-01 00:00:00")).collect()}
    assert got["20"].is_anomaly and not got["0"].is_anomaly
    assert got["s"].std_value is None and got["s"].is_anomaly is False     # one-row group
    assert got["c1"].z_score is None and got["c1"].is_anomaly is False     # sd 0
    assert "n" not in got and "z" not in got                               # no statistics


def test_brand_filter_roles(spark):
    facts = spark.createDataFrame([("1", "b1"), ("2", "b2"), ("3", None)], "event_id string, brand_id string")
    grants = spark.createDataFrame([("u@x", "b1"), ("v@x", "b1"), ("v@x", "b2")], "user_email string, brand_id string")
    ids = lambda ctx: sorted(r.event_id for r in security.brand_filter(facts, ctx, grants).collect())
    assert ids(AccessContext("u@x", "ROLE_ANALYST")) == ["1"]
    assert ids(AccessContext("v@x", "ROLE_ANALYST")) == ["1", "2"]
    assert ids(AccessContext("w@x", "ROLE_ANALYST")) == []
    assert ids(AccessContext("w@x", "ROLE_DATA_ENGINEER")) == ["1", "2", "3"]


def test_pii_flags_select_masks(spark):
    df = spark.createDataFrame([("k", "john.doe@mail.com", "(555) 123-4567", "Acme")],
                               "contact_key string, email string, phone string, company_name string")
    df = quality.attach_dictionary(df, quality.CONTACT_DICTIONARY)
    pol = security.pii_policy(df)
    assert set(pol) == {"email", "phone"}
    named = quality.attach_dictionary(spark.createDataFrame([("John", None)], "first_name string, last_name string"),
                                      quality.CONTACT_DICTIONARY)
    shown = security.apply_masks(named, AccessContext("u@x", "ROLE_ANALYST"), security.pii_policy(named)).first()
    assert tuple(shown) == ("J***", None)
    r = security.apply_masks(df, AccessContext("u@x", "ROLE_ANALYST"), pol).collect()[0]
    assert (r.email, r.phone, r.company_name) == ("j*******@****.***", "***-***-4567", "Acme")
    rules, uniques = quality.rules_from_schema(df, "t")
    assert uniques == [["contact_key"], ["email"]] and any(x.kind == "valid_email" for x in rules)


@pytest.mark.parametrize("block, bunch", [(512, 16 << 20), (7, 40 * 6 * 8), (1, 6 * 8 * 8)])
def test_similar_vectors_exact_at_every_threshold(spark, monkeypatch, block, bunch):
    from goldvein.operators import vector_pairs
    monkeypatch.setattr(vector_pairs, "BLOCK_ROWS", block)
    monkeypatch.setattr(vector_pairs, "BUNCH_BYTES", bunch)
    rng = random.Random(21)
    rows = [(i, [rng.gauss(0, 1) + 3 * (j == i % 4) for j in range(6)]) for i in range(120 if block > 1 else 40)]
    rows += [(200, None), (201, [0.0] * 6), (202, list(rows[0][1])), (203, [2 * x for x in rows[1][1]]), (204, [float("nan")] * 6)]
    df = spark.createDataFrame(rows, "id long, v array<float>").repartition(3)
    norm = {i: sum(x * x for x in v) ** 0.5 for i, v in rows if v}
    for t in (0.97, 0.2) if block > 1 else (0.9,):
        got = [(r.id_a, r.id_b) for r in vector_pairs.similar_vectors(df, "id", "v", t).collect()]
        exp = {(a, b) for (a, u), (b, v) in itertools.combinations([r for r in rows if r[1]], 2)
               if norm[a] and norm[b] and sum(x * y for x, y in zip(u, v)) / norm[a] / norm[b] > t}
        assert set(got) == exp and len(got) == len(exp)


def test_similar_vectors_edges(spark):
    from goldvein.operators.vector_pairs import similar_vectors
    none = spark.createDataFrame([], "id string, v array<double>")
    assert similar_vectors(none, "id", "v", 0.5).count() == 0
    assert similar_vectors(spark.createDataFrame([("a", [0.0]), ("b", None)], none.schema), "id", "v", 0.5).count() == 0
    twins = spark.createDataFrame([("a", [1.0, 0.0]), ("a", [1.0, 0.0]), ("b", [2.0, 0.0]), (None, [1.0, 0.0])], none.schema)
    assert sorted(map(tuple, similar_vectors(twins, "id", "v", 0.5).collect())) == [("a", "b", 1.0)] * 2
    with pytest.raises(Exception, match="numbers"):
        similar_vectors(spark.createDataFrame([("a", [1.0]), ("b", [1.0, 2.0])], none.schema), "id", "v", 0.5).collect()


def test_balls_that_are_apart_hold_no_similar_vectors():
    import numpy as np
    from goldvein.operators.vector_pairs import apart, ball
    rng, seen = np.random.default_rng(5), 0
    for _ in range(400):
        x, y = (rng.normal(size=4) + rng.uniform(0.05, 0.4) * rng.normal(size=(8, 4)) for _ in range(2))
        x, y = (v / np.linalg.norm(v, axis=1)[:, None] for v in (x, y))
        limit = rng.uniform(0.05, 1.0)
        if apart(*ball(x), *ball(y), limit):
            seen += 1
            assert np.arccos(np.clip(x @ y.T, -1, 1)).min() > limit
    assert seen > 20


def test_pairs_of_copies_are_ordered_and_not_joined_again(spark, capsys):
    """Equal similarities are ordered by keys, so copies spread over the tasks of the sort; e-mails and names come along with a pair."""
    from goldvein.operators.duplicates import potential_duplicates
    rows = [(f"k{i:02d}", f"u{i % 7}@x.org", "Ann", "Lee", "Acme") for i in range(30)] + [("z1", "z@x.org", "Ann", "Leer", "Acme"), ("z2", None, "Ann", "Lee", "Acme")]
    contacts = spark.createDataFrame(rows, "contact_key string, email string, first_name string, last_name string, company_name string")
    out = potential_duplicates(contacts, threshold=0.5, block_rows=4)
    got = [tuple(r) for r in out.select("similarity_score", "contact_key_a", "contact_key_b").collect()]
    assert got == sorted(got, key=lambda r: (-r[0], r[1], r[2]))
    copies = {(a[0], b[0]) for a in rows[:30] for b in rows[:30] if a[0] < b[0] and a[1] != b[1]}
    assert sorted(r[1:] for r in got if r[0] == 1.0) == sorted(copies)
    assert len(got) == len(copies) + 30 and all(r.email_a != r.email_b and r.name_b.startswith("Ann Lee") for r in out.collect())
    potential_duplicates(contacts, sort=False).explain()
    assert capsys.readouterr().out.count("Join") <= 2 * 6


def test_contact_pairs_are_formed_after_the_last_exchange(spark, monkeypatch):
    """Only blocks of contacts are shuffled, however many pairs they make; blocks, places and splits of any size give all pairs,
    also with null and repeated keys and e-mails."""
    r = random.Random(11)
    names = ["Ann Lee Acme", "Ann Lee Acmf", "Ann Leer Acme", "Ann Lee Acme Inc", "Bob Marley Wailers", "Bob Marley Wailer", "Zed Quux "]
    rows = [(r.choice([None, *(f"k{i:03d}" for i in range(90))]), r.choice([None, *(f"u{i}@x" for i in range(40))]), *r.choice(names).split(" ", 2))
            for _ in range(110)] + [("k1000", f"v{i}@x", "Ann", "Lee", "Acme") for i in range(12)]
    contacts = spark.createDataFrame(rows, "contact_key string, email string, first_name string, last_name string, company_name string")
    sim = brute_pairs({n: n for n in names}, 0.7)
    want = collections.Counter()
    for a, b in itertools.product(rows, rows):
        x, y = (f"{c[2]} {c[3]} {c[4]}" for c in (a, b))
        score = 1.0 if x == y else sim.get((x, y), sim.get((y, x)))
        if score and None not in (a[0], b[0], a[1], b[1]) and a[0] < b[0] and a[1] != b[1]:
            want[(a[0], b[0], a[1], b[1], x, y, round(score, 9))] += 1
    dealt, repartition = {}, type(contacts).repartition

    def watched(df, n, *cols):
        if cols == ("lead", "slot", "split"):
            dealt["there" if "there" in df.columns else "sent"] = {tuple(x) for x in df.select(*cols).collect()}
        return repartition(df, n, *cols)
    monkeypatch.setattr(type(contacts), "repartition", watched)
    for block in (2, 2_000):
        out = duplicates.potential_duplicates(contacts, threshold=0.7, sort=False, block_rows=block)
        assert collections.Counter((*x[:6], round(x[6], 9)) for x in map(tuple, out.collect())) == want
        assert dealt["sent"] <= dealt["there"]
        assert block == 2_000 or {s for _, s, _ in dealt["sent"]} > {0} and {s for _, _, s in dealt["sent"]} > {0}
    top = out._jdf.queryExecution().sparkPlan().toString().split("Exchange")[0]
    assert top.count("Generate explode(members") == 2 and len(want) > 500
