"""Adapters from the driver's test tables to the pipeline's input shapes.

The pipeline reads three contact sources (CRM contacts, marketing
subscribers, event registrations), silver events, a brand dimension, event
feedback and brand grants. The test tables hold none of these, so each is
derived row-by-row from a driver table with plain column expressions (the
same derivations are written in SQL for the DuckDB oracle). The
derivations plant the cases the pipeline must handle: shared e-mails across
and within sources, NULL and malformed e-mails, soft deletes, opt-outs,
phones in several formats, NULL names and titles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldvein.functions.keys import contact_key
from goldvein.sources.tables import read

# The fixed "now" of every test query (the pipeline takes ``as_of`` as a
# parameter so results are reproducible).
AS_OF = "2024-02-01 00:00:00"

EVENT_TYPE_BY_PRIORITY = {"1-URGENT": "CONFERENCE", "2-HIGH": "WEBINAR",
                          "3-MEDIUM": "WORKSHOP", "4-NOT SPECIFIED": "ROUNDTABLE",
                          "5-LOW": "MEETUP"}
SOURCE_BY_STATUS = {"F": "EMAIL", "O": "ORGANIC", "P": "PAID"}
VERTICALS = ["ONCOLOGY", "CARDIOLOGY", "PRIMARY_CARE", "NEUROLOGY", "DERMATOLOGY"]
# Job titles derived from the second word of a part name.
TITLE_BY_PART_WORD = {"anvil": "Staff Nurse", "bolt": "Research Scientist",
                      "gear": "Office Administrator", "gizmo": "Chief Executive Officer",
                      "plate": "Account Executive", "ring": "Marketing Director",
                      "rod": "Software Engineer", "widget": "Intern"}


def ts(s: str) -> Column:
    return F.to_timestamp_ntz(F.lit(s))


def plus_days(t: Column, n: Column) -> Column:
    return t + F.make_dt_interval(days=n.cast("int"))


def _s(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _map(c: Column, mapping: dict, default=None) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(c == k, v) if out is None else out.when(c == k, v)
    return out.otherwise(F.lit(default).cast("string"))


def _three_digits(k: Column) -> Column:
    return F.lpad(_s(k % 1000), 3, "0")


def _crm_columns(df: DataFrame, k: Column) -> DataFrame:
    """E-mail and names of a CRM contact derived from its customer row."""
    return df.withColumns({
        "first_name": F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" ")),
        "last_name": F.when(k % 11 == 0, F.lit(None).cast("string"))
                      .otherwise(F.concat(F.lit("name-"), _s(k % 97))),
        "email": F.when(k % 13 == 0, F.lit(None).cast("string"))
                  .when(k % 17 == 0, F.lit("bad-address"))
                  .otherwise(F.concat(F.lit(" User"), _s(F.floor(k / 2)), F.lit("@Example.com"))),
    })


def crm_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer x nation x part -> CRM contact rows."""
    c = read(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = read(spark, sf_dir, "nation", "n_nationkey", "n_name")
    p = read(spark, sf_dir, "part", "p_partkey", "p_name")
    k = F.col("c_custkey")
    df = (c.join(n, c.c_nationkey == n.n_nationkey, "left")
          .join(p, p.p_partkey == c.c_custkey, "left"))
    created = plus_days(ts("2024-01-01 00:00:00"), k % 300)
    names = _crm_columns(df, k)
    return names.select(
        _s(k).alias("id"), "first_name", "last_name", "email",
        F.when(k % 4 == 0, F.concat(F.lit("(555) "), _three_digits(k), F.lit("-0199")))
         .when(k % 4 == 1, F.concat(F.lit("1-555-"), _three_digits(k), F.lit("-0100")))
         .when(k % 4 == 2, F.lit("12345"))
         .otherwise(F.lit(None).cast("string")).alias("phone"),
        F.col("n_name").alias("company_name"),
        F.when(k % 5 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(_map(F.split_part("p_name", F.lit(" "), F.lit(2)), TITLE_BY_PART_WORD),
                             F.lit(" ("), F.split_part("p_name", F.lit(" "), F.lit(1)), F.lit(")")))
         .alias("job_title"),
        created.alias("created_at"),
        plus_days(created, k % 10).alias("updated_at"),
        plus_days(ts("2024-01-01 00:00:00"), k % 30).alias("_fivetran_synced"),
        (F.col("c_acctbal") < 0).alias("_fivetran_deleted"),
    )


def marketing_subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as a marketing subscriber (upper-case values)."""
    c = read(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    k = F.col("c_custkey")
    created = plus_days(ts("2023-06-01 00:00:00"), k % 200)
    return c.select(
        F.concat(F.lit("M"), _s(k)).alias("contact_id"),
        F.upper("c_mktsegment").alias("fname"),
        F.upper(F.concat(F.lit("name-"), _s(k % 97))).alias("lname"),
        F.concat(F.lit("USER"), _s(F.floor(k / 2)), F.lit("@EXAMPLE.COM")).alias("email_address"),
        F.concat(F.lit("555."), _three_digits(k), F.lit(".0111")).alias("mobile"),
        F.lit(None).cast("string").alias("organization"),
        F.lit(None).cast("string").alias("title"),
        created.alias("created_date"),
        plus_days(created, F.lit(1)).alias("last_modified"),
        plus_days(ts("2024-01-01 00:00:00"), k % 30).alias("_fivetran_synced"),
        (k % 7 == 0).alias("unsubscribed"),
    )


def event_registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> registrations (one per event, e-mail per user)."""
    e = read(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type")
    null = F.lit(None).cast("string")
    return e.select(
        _s("event_id").alias("registration_id"),
        F.col("event_type").alias("registrant_first_name"),
        F.concat(F.lit("name-"), _s(F.col("user_id") % 97)).alias("registrant_last_name"),
        F.concat(F.lit("user"), _s("user_id"), F.lit("@example.com")).alias("registrant_email"),
        null.alias("registrant_phone"),
        null.alias("registrant_company"),
        null.alias("registrant_title"),
        F.col("ts").alias("registration_date"),
    )


def crm_contact_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(c_custkey, c_nationkey, contact_key) using the CRM row's raw values,
    so facts point at the key the silver build derives."""
    # The key uses e-mail and names only, which come from the customer row:
    # no need for the nation and part joins of the full CRM adapter.
    c = read(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    crm = _crm_columns(c, F.col("c_custkey"))
    return crm.select(F.col("c_custkey"),
                      contact_key(F.col("email"), F.col("first_name"), F.col("last_name"))
                      .alias("contact_key"))


def silver_events(spark: SparkSession, sf_dir: str, keyed_by: str = "crm") -> DataFrame:
    """orders -> silver events. ``keyed_by='customer'`` uses the customer
    number as contact key (RFM queries); ``'crm'`` the CRM contact key
    (fact queries: customers deduplicated away become orphans)."""
    o = read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
             "o_totalprice", "o_orderdate", "o_orderpriority")
    c = read(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    df = o.join(c, o.o_custkey == c.c_custkey, "left")
    if keyed_by == "crm":
        keys = crm_contact_keys(spark, sf_dir)
        df = df.join(keys, "c_custkey", "left")
        ck = F.col("contact_key")
    else:
        ck = _s("o_custkey")
    return df.select(
        _s("o_orderkey").alias("event_id"),
        ck.alias("contact_key"),
        _s("c_nationkey").alias("brand_id"),
        F.to_date("o_orderdate").alias("event_date"),
        _map(F.col("o_orderpriority"), EVENT_TYPE_BY_PRIORITY).alias("event_type"),
        _map(F.col("o_orderstatus"), SOURCE_BY_STATUS, "REFERRAL").alias("registration_source"),
        (F.col("o_orderstatus") == "F").alias("attended_flag"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("revenue_amount"),
    )


def silver_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation x region -> brand dimension."""
    n = read(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = read(spark, sf_dir, "region", "r_regionkey", "r_name")
    k = F.col("n_nationkey")
    vertical = F.element_at(F.array(*[F.lit(v) for v in VERTICALS]), (k % len(VERTICALS) + 1).cast("int"))
    return n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        _s(k).alias("brand_id"),
        F.col("n_name").alias("brand_name"),
        vertical.alias("brand_vertical"),
        F.col("r_name").alias("brand_region"),
        (k % 4 != 0).alias("is_active"),
        F.date_add(F.lit("2010-01-01").cast("date"), (k * 30).cast("int")).alias("launch_date"),
    )


def event_feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns of conversations as event feedback."""
    cv = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return cv.where(F.col("role") == "user").select(
        F.concat_ws("-", _s("conv_id"), _s("turn")).alias("feedback_id"),
        _s("conv_id").alias("event_id"),
        _s(F.col("conv_id") % 97).alias("contact_key"),
        F.col("text").alias("feedback_text"),
    )


def brand_grants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands of even number granted to a@x, the others to b@x; c@x has none."""
    n = read(spark, sf_dir, "nation", "n_nationkey")
    k = F.col("n_nationkey")
    return n.select(
        F.when(k % 2 == 0, "a@x").otherwise("b@x").alias("user_email"),
        _s(k).alias("brand_id"),
        F.lit("admin@x").alias("granted_by"),
        ts(AS_OF).alias("granted_at"),
    )
