"""Column functions on hand-made edge rows."""

import datetime as dt

from pyspark.sql import functions as F

from goldvein import functions as G
from goldvein.functions.masks import ROLE_ARCHITECT, ROLE_STEWARD


def one_col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_valid_email_edges(spark):
    vals = [None, "", "a@b.c", "ab@c.d", "a b@c.de", "x@y", "@.", "ok@mail.com"]
    assert one_col(spark, vals, G.is_valid_email) == [False, False, False, True, False, False, False, True]


def test_mvr_email_accepts_space(spark):
    # the silver filter is looser than the macro: a space passes
    assert one_col(spark, ["a b@c.d", None, "x@y"], G.mvr_email) == [True, False, False]


def test_initcap_delimiters(spark):
    vals = ["mary-jane o'brien", "a.b", "two  spaces", "ALL CAPS", None, "", "x_y/z"]
    assert one_col(spark, vals, G.initcap_words) == [
        "Mary-Jane O'brien", "A.B", "Two  Spaces", "All Caps", None, "", "X_Y/Z"]


def test_format_phone(spark):
    vals = ["(555) 123-4567", "1-555-123-4567", "2-555-123-4567", "123456789", "abc", "", None]
    assert one_col(spark, vals, G.format_phone) == [
        "555-123-4567", "555-123-4567", "555-123-4567", "123456789", "abc", "", None]


def test_contact_key_no_separator(spark):
    df = spark.createDataFrame([(" A@x.io ", "Ab", "c"), ("a@x.io", "a", "bc"), (None, None, None)],
                               "e string, f string, l string")
    keys = [r[0] for r in df.select(G.contact_key(F.col("e"), F.col("f"), F.col("l"))).collect()]
    import hashlib
    assert keys[0] == keys[1] == hashlib.md5(b"a@x.ioabc").hexdigest()   # collision kept
    assert keys[2] == hashlib.md5(b"").hexdigest()
    sep = [r[0] for r in df.select(G.contact_key(F.col("e"), F.col("f"), F.col("l"), sep="|")).collect()]
    assert sep[0] != sep[1]


def test_surrogate_key_null_marker_and_order(spark):
    df = spark.createDataFrame([("1", None), ("a", "b"), ("b", "a")], "p string, q string")
    ks = [r[0] for r in df.select(G.surrogate_key(F.col("p"), F.col("q"))).collect()]
    import hashlib
    assert ks[0] == hashlib.md5(b"1-_dbt_utils_surrogate_key_null_").hexdigest()
    assert ks[1] != ks[2]


def test_dq_score(spark):
    df = spark.createDataFrame([("e", "f", "l", "p", "c", "t"), ("e", None, None, None, None, None),
                                ("e", "", "", "", "", "")], ",".join(f"{c} string" for c in "eflpct"))
    cols = {"email": F.col("e"), "first_name": F.col("f"), "last_name": F.col("l"), "phone": F.col("p"),
            "company_name": F.col("c"), "job_title": F.col("t")}
    assert [r[0] for r in df.select(G.dq_score(cols)).collect()] == [100, 25, 25]


def test_rfm_boundaries(spark):
    rows = [(5, 1000.0, 100), (5, 999.99, 100), (3, 500.0, 100), (2, 10.0, 30), (2, 10.0, 31),
            (1, 10.0, None), (None, None, None)]
    df = spark.createDataFrame(rows, "f int, m double, r int")
    got = [x[0] for x in df.select(G.rfm_segment(F.col("f"), F.col("m"), F.col("r"))).collect()]
    assert got == ["CHAMPION", "LOYAL", "LOYAL", "RECENT", "POTENTIAL", "AT_RISK", "AT_RISK"]


def test_sentiment_label_cutoffs(spark):
    got = one_col(spark, [-0.3, -0.31, 0.3, 0.31, None], G.sentiment_label, "double")
    assert got == ["NEUTRAL", "NEGATIVE", "NEUTRAL", "POSITIVE", "NEUTRAL"]


def test_match_tier(spark):
    df = spark.createDataFrame([(False, 0.95), (False, 0.92), (False, 0.9199), (True, 0.1)],
                               "same boolean, s double")
    got = [r[0] for r in df.select(G.match_tier(F.col("same"), F.col("s"))).collect()]
    assert got == ["HIGH", "MEDIUM", "LOW", "EXACT"]


def test_masks(spark):
    vals = [None, "j@x.com", "john.doe@mail.ex.com", "noat", ""]
    assert one_col(spark, vals, lambda c: G.mask_email(c, "ROLE_ANALYST")) == [
        None, "j@*.***", "j*******@****.**.***", "n***@", "@"]
    assert one_col(spark, vals, lambda c: G.mask_email(c, ROLE_STEWARD)) == vals
    assert one_col(spark, [None, "123", "(555) 123-4567"], lambda c: G.mask_phone(c, "X")) == [
        None, "***-***-123", "***-***-4567"]
    assert one_col(spark, [None, "1"], lambda c: G.mask_ssn(c, "X")) == ["***-**-****", "***-**-****"]
    assert one_col(spark, [None, "1"], lambda c: G.mask_ssn(c, ROLE_ARCHITECT)) == [None, "1"]


def test_hours_between_counts_boundaries(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 59), dt.datetime(2024, 1, 1, 1, 1)),
                                (dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 2, 0, 0)),
                                (dt.datetime(2024, 1, 2, 0, 0), dt.datetime(2024, 1, 1, 23, 59))],
                               "a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.select(G.hours_between(F.col("a"), F.col("b"))).collect()]
    assert got == [1, 24, -1]


def test_cosine(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0]), ([1.0, 1.0], [1.0, 0.0]), ([0.0, 0.0], [1.0, 0.0])],
                               "a array<double>, b array<double>")
    got = [r[0] for r in df.select(G.cosine(F.col("a"), F.col("b"))).collect()]
    assert abs(got[0] - 1.0) < 1e-12 and abs(got[1] - 2 ** -0.5) < 1e-12 and got[2] is None


def test_soft_delete_and_opt_out_flags_drop_null(spark):
    from goldvein.sources.contacts import crm_scan, marketing_scan
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    crm = spark.createDataFrame(
        [(str(i), "a", "b", "e@x.io", None, None, None, t, t, t, flag) for i, flag in enumerate([True, False, None])],
        "id string, first_name string, last_name string, email string, phone string, company_name string, "
        "job_title string, created_at timestamp_ntz, updated_at timestamp_ntz, _fivetran_synced timestamp_ntz, "
        "_fivetran_deleted boolean")
    assert [r.source_id for r in crm_scan(crm).collect()] == ["1"]
    subs = spark.createDataFrame(
        [(str(i), "a", "b", "e@x.io", None, None, None, t, t, t, flag) for i, flag in enumerate([True, False, None])],
        "contact_id string, fname string, lname string, email_address string, mobile string, organization string, "
        "title string, created_date timestamp_ntz, last_modified timestamp_ntz, _fivetran_synced timestamp_ntz, "
        "unsubscribed boolean")
    assert [r.source_id for r in marketing_scan(subs).collect()] == ["1"]


def test_cosine_unequal_length_raises(spark):
    import pytest
    df = spark.createDataFrame([([1.0, 0.0], [1.0])], "a array<double>, b array<double>")
    with pytest.raises(Exception, match="vector dimensions differ"):
        df.select(G.cosine(F.col("a"), F.col("b"))).collect()
    nul = spark.createDataFrame([(None, [1.0])], "a array<double>, b array<double>")
    assert nul.select(G.cosine(F.col("a"), F.col("b"))).collect()[0][0] is None
