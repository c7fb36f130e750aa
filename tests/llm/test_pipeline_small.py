"""The two document de-duplication stages of the corpus pipeline against brute force, null and repeated ids included."""

import itertools
import random
import re

import corpus_pipeline

SCHEMA = "doc_id long, text string, source string, n_chars int"


def table(spark, rows):
    return spark.createDataFrame([(d, t, "s", len(t or "")) for d, t in rows], SCHEMA)


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def near_rows():
    r = random.Random(3)
    voc = [f"w{i}" for i in range(3000)]
    rows = []
    for base in range(12):
        w = r.choices(voc, k=120)
        for i in range(4):
            x = list(w)
            if i:
                x[r.randrange(len(x))] = r.choice(voc)
            rows.append((None if base < 4 or i == 2 else base % 7 if i == 3 else 100 * base + i, " ".join(x)))
    # One id with two texts that are near copies, one id with two unlike texts, a null id beside nothing.
    return rows + [(5000, rows[20][1] + " end"), (5000, rows[20][1] + " stop"), (6000, rows[40][1] + " end"), (6000, "quite another text"),
                   (None, "alone and unlike all others"), (7000, ""), (7001, None)]


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())


def classes(rows):
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    out = {}
    for i, row in enumerate(rows):
        out.setdefault(find(i), []).append(row)
    return list(out.values())


def test_near_keeps_one_row_of_each_class(spark):
    rows = near_rows()
    kept = pairs(corpus_pipeline.near(spark, table(spark, rows), ""))
    groups = classes(rows)
    assert len(kept) == len(groups)
    for g in groups:
        ids = [d for d, _ in g if d is not None]
        (one,) = [k for k in kept if k in g]
        assert one[0] == (min(ids) if ids else None)


def test_exact_keeps_one_row_of_each_text(spark):
    rows = near_rows() + [(1, "same"), (2, "same"), (2, "same"), (None, "same"), (None, "twin"), (None, "twin")]
    kept = pairs(corpus_pipeline.exact(spark, table(spark, rows), ""))
    by_text = {}
    for d, t in rows:
        by_text.setdefault(t or "", []).append(d)
    largest = {t: max((d for d in ids if d is not None), default=None) for t, ids in by_text.items()}
    assert sorted(((d, t or "") for d, t in kept), key=repr) == sorted(((d, t) for t, d in largest.items()), key=repr)
