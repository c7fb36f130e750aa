"""Trained labels: counts and weights against plain loops, held-out titles."""

import hashlib
import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from goldvein.operators import enrich, text_model


def buckets(text):
    out = []
    for w in re.findall(r"[^\W\d_]+", (text or "").lower()):
        marked = f"^{w}$"
        out += ["w" + w] + ["c" + marked[i:i + 3] for i in range(len(w))]
    return [hashlib.md5(x.encode()).hexdigest()[:text_model.DIGITS] for x in out]


def brute(known, labels, asked):
    """(label, margin, weights, n_features) per text."""
    counts = {x: Counter() for x in labels}
    texts = Counter()
    for t, x in known:
        if x in counts:
            counts[x].update(buckets(t))
            texts[x] += 1
    ln = lambda a, b: round(text_model.UNIT * math.log(a / b))
    out = {}
    for t in asked:
        w = [ln(texts[x] + 1, sum(texts.values()) + len(labels)) for x in labels]
        for i, x in enumerate(labels):
            total = sum(counts[x].values()) + text_model.BUCKETS
            w[i] += sum(ln(counts[x][b] + 1, total) for b in buckets(t))
        ranked = sorted(range(len(labels)), key=lambda i: (-w[i], i))
        out[t] = (labels[ranked[0]], w[ranked[0]] - w[ranked[1]], w, len(buckets(t)))
    return out


def test_weights_equal_plain_loops(spark):
    rng = random.Random(3)
    words = ["good", "gut", "élan", "bad", "so-so", "x1y", "x", "", "a b"]
    known = [(" ".join(rng.choices(words, k=rng.randrange(6))), rng.choice(["P", "N", "M", None])) for _ in range(80)]
    known += [(None, "P"), ("good good", "P")] * 3
    labels = ("N", "P", "Z")
    asked = sorted({t for t, _ in known if t is not None}) + ["unseen words here", "GOOD"]
    model = text_model.train(spark.createDataFrame(known, "t string, label string"), "t", "label", labels)
    want = brute(known, labels, [*asked, None])
    df = spark.createDataFrame([(t, i) for i, t in enumerate([*asked, None, "good good", "good good"])], "t string, n int")
    got = text_model.classify(df, model, "t").collect()
    assert sorted(r.n for r in got) == list(range(len(asked) + 3))  # repeated and null texts stay
    for r in got:
        assert (r.label, r.margin, r.weights, r.n_features) == want[r.t], r.t


def test_empty_tables(spark):
    none = spark.createDataFrame([], "t string, label string")
    model = text_model.train(none, "t", "label", ("A", "B"))
    got = text_model.classify(spark.createDataFrame([("x y", 1)], "t string, n int"), model, "t").first()
    assert (got.label, got.margin) == ("A", 0)
    assert text_model.classify(none, model, "t").count() == 0


def test_held_out_titles(spark):
    """Titles whose stem a rule knows, in forms that it does not: the model names them, and leaves strangers alone."""
    stems = {"CLINICIAN": "nurse", "ENGINEERING": "engineer", "RESEARCHER": "researcher", "MARKETING": "marketing"}
    known = [(f"k{i}", f"{a} {stem} {b}") for i, (a, stem, b) in enumerate(
        (a, s, b) for a in ("Senior", "Junior", "Lead") for s in stems.values() for b in ("North", "South", "East", "West"))]
    asked = [(f"q{i}", f"{stem}s of wards", label) for i, (label, stem) in enumerate(stems.items())]
    strange = [("s1", "Qzx"), ("s2", "Yvv Kjj")]
    titles = spark.createDataFrame([*known, *[(k, t) for k, t, _ in asked], *strange, ("n", None)], "contact_key string, job_title string")
    out = enrich.contact_personas(titles, F.lit(0), model=text_model.trained_personas(titles))
    got = {r.contact_key: r.ai_persona for r in out.collect()}
    rules = {r.contact_key: r.ai_persona for r in enrich.contact_personas(titles, F.lit(0)).collect()}
    assert "n" not in got
    assert all(rules[k] == "OTHER" and got[k] == label for k, _, label in asked)
    assert [got["s1"], got["s2"]] == ["OTHER", "OTHER"]
    assert all(got[k] == rules[k] for k, _ in known)


def test_trained_sentiment(spark):
    rows = [(f"f{i}", "e", "c", t) for i, t in enumerate(
        ["great parking near venue", "excellent parking lot", "terrible queue outside", "awful queue again"] * 5
        + ["the parking place", "a queue of people", "some other thing here", "good but bad food", "short", None])]
    fb = spark.createDataFrame(rows, "feedback_id string, event_id string, contact_key string, feedback_text string")
    got = {r.feedback_text: r for r in enrich.feedback_scored(fb, F.lit(0), model=text_model.trained_sentiment(fb)).collect()}
    assert got["the parking place"].sentiment_score > 0 > got["a queue of people"].sentiment_score
    assert got["great parking near venue"].sentiment_score == 1.0
    assert all(-1 <= r.sentiment_score <= 1 for r in got.values()) and "short" not in got


def test_texts_are_scored_where_they_are(spark, capsys):
    """Neither texts nor their words are sent to other tasks to be scored; training sends each word once per task."""
    known = spark.createDataFrame([("good parking", "P"), ("bad queue", "N")], "t string, label string")
    model = text_model.train(known, "t", "label", ("N", "P"))
    df = spark.createDataFrame([(i, "parking " * 50) for i in range(20)], "n int, t string")
    out = text_model.classify(df, model, "t")
    out.explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Join" not in plan and plan.count("ArrowEvalPython") == 1
    assert {(r.label, r.n_features) for r in out.collect()} == {("P", 50 * 8)}
