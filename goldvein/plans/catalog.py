"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query reads the driver tables at ``sf_dir`` (whole tables), derives
the pipeline inputs with the fixture adapters and runs one operator or job.
Money columns are exact decimals inside the pipeline and are cast to
double only here, at the comparison boundary.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldvein.operators import gold, mdm, merges
from goldvein.operators.features import engagement_features, with_rfm_segment
from goldvein.session import cut_to_table, scratch_path
from goldvein.sources import fixtures as fx
from goldvein.sources.contacts import bronze_contacts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: _doubles(fn(spark, sf_dir))
        QUERIES[name].__doc__ = fn.__doc__
        return fn
    return deco


def _doubles(df: DataFrame) -> DataFrame:
    cols = [F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


def as_of():
    return fx.ts(fx.AS_OF)


# ---------------------------------------------------------------- inputs

def bronze(spark: SparkSession, d: str) -> DataFrame:
    return bronze_contacts(fx.crm_contacts(spark, d), fx.marketing_subscribers(spark, d),
                           fx.event_registrations(spark, d), as_of())


def scored(spark: SparkSession, d: str) -> DataFrame:
    return mdm.quality_scored(mdm.standardize(bronze(spark, d)))


def golden(spark: SparkSession, d: str) -> DataFrame:
    return mdm.golden_records(scored(spark, d), as_of())


def identities(spark: SparkSession, d: str) -> DataFrame:
    """What the merges read of the golden contacts."""
    return mdm.golden_identities(bronze(spark, d))


def fact(spark: SparkSession, d: str, contacts: DataFrame | None = None) -> DataFrame:
    return gold.fact_events(fx.silver_events(spark, d, "crm"), golden(spark, d) if contacts is None else contacts,
                            fx.silver_brands(spark, d), as_of())


# ---------------------------------------------------------------- bronze / silver

@register("bronze_contacts")
def q_bronze_contacts(spark, d):
    """Three conformed scans, UNION ALL."""
    return bronze(spark, d)


@register("standardized_contacts")
def q_standardized(spark, d):
    """Trim, INITCAP, lower e-mail, phone, key."""
    return mdm.standardize(bronze(spark, d))


@register("contact_quality")
def q_contact_quality(spark, d):
    """Completeness score per standardised record."""
    return scored(spark, d).select("source_system", "source_id", "contact_key", "email", "dq_score")


@register("golden_contacts")
def q_golden(spark, d):
    """One survivor per e-mail with golden id."""
    return golden(spark, d)


@register("steward_queue")
def q_steward_queue(spark, d):
    """L4: records ranked below the survivor, with exact rank."""
    return mdm.steward_queue(scored(spark, d), as_of())


# ---------------------------------------------------------------- gold

@register("rfm_features")
def q_rfm_features(spark, d):
    """Recency, 365-day frequency and revenue per event."""
    f = engagement_features(fx.silver_events(spark, d, "customer"))
    return f.select("event_id", "contact_key", "event_date", "days_since_last_event",
                    "events_last_12m", "revenue_last_12m")


@register("rfm_segments")
def q_rfm_segments(spark, d):
    """Segment per event, summarised per segment."""
    f = with_rfm_segment(engagement_features(fx.silver_events(spark, d, "customer")))
    return f.groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("events"),
        F.countDistinct("contact_key").alias("contacts"),
        F.sum("revenue_amount").cast("decimal(18,2)").alias("revenue"))


@register("fact_events")
def q_fact_events(spark, d):
    """O3 (C1, C2, H23, B14): the gold fact table."""
    return fact(spark, d)


@register("orphan_facts")
def q_orphan_facts(spark, d):
    """Events whose contact key has no golden contact."""
    ev = fx.silver_events(spark, d, "crm")
    return gold.orphan_facts(ev, golden(spark, d)).select("event_id", "contact_key", "brand_id")


# ---------------------------------------------------------------- column functions

from goldvein.functions.dates import days_between, hours_between  # noqa: E402
from goldvein.functions.masks import (AccessContext, ROLE_ARCHITECT, ROLE_STEWARD,  # noqa: E402
                                      mask_email, mask_phone, mask_ssn)
from goldvein.functions.text import is_valid_email, mvr_email  # noqa: E402
from goldvein.sources.tables import read  # noqa: E402

ANALYST = "ROLE_ANALYST"


@register("valid_email")
def q_valid_email(spark, d):
    """E-mail predicates on raw bronze values."""
    e = F.col("email")
    return bronze(spark, d).select("source_system", "source_id", "email",
                                   is_valid_email(e).alias("valid_email"),
                                   mvr_email(e).alias("mvr_email"),
                                   F.length(e).alias("email_length"))


@register("mask_email")
def q_mask_email(spark, d):
    """E-mail mask for an analyst and a steward."""
    e = F.col("email")
    return bronze(spark, d).select("source_system", "source_id", "email",
                                   mask_email(e, ANALYST).alias("email_analyst"),
                                   mask_email(e, ROLE_STEWARD).alias("email_steward"))


@register("mask_phone")
def q_mask_phone(spark, d):
    """Phone mask (last four digits) for an analyst and a steward."""
    p = F.col("phone")
    return bronze(spark, d).select("source_system", "source_id", "phone",
                                   mask_phone(p, ANALYST).alias("phone_analyst"),
                                   mask_phone(p, ROLE_STEWARD).alias("phone_steward"))


@register("mask_ssn")
def q_mask_ssn(spark, d):
    """Constant mask for all but the architect (NULL masked too); the
    phone column stands in for an SSN column."""
    p = F.col("phone")
    return bronze(spark, d).select("source_system", "source_id",
                                   mask_ssn(p, ANALYST).alias("ssn_analyst"),
                                   mask_ssn(p, ROLE_ARCHITECT).alias("ssn_architect"))


@register("scalar_dates")
def q_scalar_dates(spark, d):
    """Day and hour-boundary differences, interval arithmetic."""
    o = read(spark, d, "orders", "o_orderkey", "o_orderdate")
    t = F.col("o_orderdate")
    iv = F.make_dt_interval(days=F.lit(3))
    return o.select("o_orderkey", "o_orderdate",
                    days_between(t, as_of()).cast("bigint").alias("days_to_as_of"),
                    hours_between(t, as_of()).cast("bigint").alias("hours_to_as_of"),
                    (t + iv).alias("plus_3_days"), (t - iv).alias("minus_3_days"))


# ---------------------------------------------------------------- quality

from goldvein.operators import quality as Q  # noqa: E402
from goldvein.operators.anomaly import anomaly_flags  # noqa: E402
from goldvein.sources import contacts as C  # noqa: E402

NULL_RATE_COLUMNS = ["first_name", "last_name", "phone", "company_name", "job_title"]


@register("null_rate")
def q_null_rate(spark, d):
    """Null-rate profile of the golden contacts."""
    return Q.null_rates(golden(spark, d), "silver_contacts", NULL_RATE_COLUMNS)


@register("freshness")
def q_freshness(spark, d):
    """Freshness of each bronze source at the as-of time."""
    crm = C.crm_scan(fx.crm_contacts(spark, d))
    mkt = C.marketing_scan(fx.marketing_subscribers(spark, d))
    evs = C.events_scan(fx.event_registrations(spark, d), as_of())
    parts = [Q.freshness(crm, "bronze_crm", "ingested_at", as_of()),
             Q.freshness(mkt, "bronze_marketing", "ingested_at", as_of()),
             Q.freshness(evs, "bronze_events", "created_at", as_of()),
             Q.freshness(evs, "bronze_events", "ingested_at", as_of())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("dq_summary")
def q_dq_summary(spark, d):
    """Score summary of the golden contacts."""
    return Q.dq_summary(golden(spark, d), "silver_contacts", as_of())


@register("dq_gate")
def q_dq_gate(spark, d):
    """The daily quality gate."""
    return Q.dq_gate(golden(spark, d), as_of())


@register("dq_rules")
def q_dq_rules(spark, d):
    """Dictionary rules, one pass per table."""
    g = cut_to_table(golden(spark, d), "golden")   # read three times
    return (Q.evaluate_rules(g, Q.CONTACT_RULES)
            .unionByName(Q.evaluate_rules(fact(spark, d, g), Q.FACT_RULES)))


@register("unique_check")
def q_unique_check(spark, d):
    """K2, K8: keys held by more than one row."""
    b = cut_to_table(bronze(spark, d), "bronze")   # each table is read by several checks: written once
    s = cut_to_table(mdm.quality_scored(mdm.standardize(b)), "scored")
    g = cut_to_table(mdm.golden_records(s, as_of()), "golden")
    return (Q.unique_violations(g, "silver.contacts", ["contact_key"])
            .unionByName(Q.unique_violations(g, "silver.contacts", ["email"]))
            .unionByName(Q.unique_violations(s, "silver.standardized", ["email"]))
            .unionByName(Q.unique_violations(b, "bronze.contacts", ["source_system", "source_id"])))


@register("accepted_values")
def q_accepted_values(spark, d):
    """K3: value distribution of coded fact columns against the accepted sets."""
    checks = {"event_type": Q.EVENT_TYPES, "registration_source": Q.REGISTRATION_SOURCES,
              "rfm_segment": Q.RFM_SEGMENTS, "brand_region": Q.BRAND_REGIONS}
    f = fact(spark, d)
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value"),
                 F.col(c).isin(*vals).alias("accepted")) for c, vals in checks.items()]))
    return (f.select(pairs.alias("p")).select("p.*")
            .groupBy("column_name", "value", "accepted").agg(F.count(F.lit(1)).alias("rows")))


@register("range_check")
def q_range_check(spark, d):
    """K4: dq_score within 0-100 on every scored record."""
    rule = Q.Rule("RG-dq_score", "silver.standardized", "dq_score", "range", params=(0, 100))
    return Q.evaluate_rules(scored(spark, d), [rule])


@register("phone_format")
def q_phone_format(spark, d):
    """K5: golden contacts whose phone is not XXX-XXX-XXXX."""
    g = golden(spark, d)
    return g.where(F.col("phone").isNotNull() & ~F.col("phone").rlike(Q.PHONE_PATTERN)) \
            .select("contact_key", "source_system", "phone")


@register("anomaly_flags")
def q_anomaly_flags(spark, d):
    """Z-score flags of event values per type."""
    ev = read(spark, d, "events", "event_id", "event_type", "value")
    a = anomaly_flags(ev, "event_id", "event_type", "value", as_of())
    return a.select("event_id", "event_type", "value",
                    F.round("avg_value", 6).alias("avg_value"),
                    F.round("std_value", 6).alias("std_value"),
                    F.round("z_score", 6).alias("z_score"), "is_anomaly", "detected_at")


# ---------------------------------------------------------------- governance

from goldvein.operators.security import apply_masks, brand_filter, pii_policy, secure  # noqa: E402
from goldvein.sources.sinks import refresh_audit  # noqa: E402


@register("row_filter")
def q_row_filter(spark, d):
    """Fact rows visible to analyst a@x (brands granted to a@x)."""
    ctx = AccessContext("a@x", ANALYST)
    f = brand_filter(fact(spark, d), ctx, fx.brand_grants(spark, d))
    return f.select("fact_key", "event_id", "brand_id", "contact_key")


@register("audit_log")
def q_audit_log(spark, d):
    """Refresh audit row of the gold fact (id and time are
    generated, so only the stable columns are returned)."""
    a = refresh_audit(fact(spark, d), "gold.fact_events", "etl@x", "ROLE_DATA_ENGINEER", as_of())
    return a.select("table_name", "action", "row_count", "user_name", "role_name", "event_time")


@register("audit_ids")
def q_audit_ids(spark, d):
    """Refresh audit rows of the three bronze scans, with the number
    of different ids over all of them and the ids' length."""
    scans = {"bronze.crm": C.crm_scan(fx.crm_contacts(spark, d)), "bronze.marketing": C.marketing_scan(fx.marketing_subscribers(spark, d)),
             "bronze.events": C.events_scan(fx.event_registrations(spark, d), as_of())}
    parts = [refresh_audit(df, name, "etl@x", "ROLE_DATA_ENGINEER", as_of()) for name, df in scans.items()]
    rows = cut_to_table(parts[0].unionByName(parts[1]).unionByName(parts[2]), "audit")
    ids = rows.agg(F.countDistinct("log_id").alias("n"))
    return rows.groupBy("table_name").agg(F.sum("row_count").alias("row_count"), F.count(F.lit(1)).alias("audit_rows"),
                                          F.max(F.length("log_id")).alias("id_length")).withColumn("distinct_ids", ids.scalar())


# ---------------------------------------------------------------- incremental

from goldvein.operators.incremental import incremental_scan, merge_upsert  # noqa: E402

BATCH1_CUTOFF = "2024-01-20 00:00:00"


def _batches(spark, d):
    b = cut_to_table(bronze(spark, d), "bronze")
    target = mdm.golden_records(
        mdm.quality_scored(mdm.standardize(b.where(F.col("ingested_at") < fx.ts(BATCH1_CUTOFF)))),
        as_of())
    return b, cut_to_table(target, "silver")


@register("incremental_scan")
def q_incremental_scan(spark, d):
    """Bronze rows newer than the target's high-water mark
    minus three days."""
    b, target = _batches(spark, d)
    return incremental_scan(b, target)


@register("merge_upsert")
def q_merge_upsert(spark, d):
    """Merge of the second batch into the first, with a new column."""
    b, target = _batches(spark, d)
    src = mdm.golden_records(mdm.quality_scored(mdm.standardize(incremental_scan(b, target))), as_of())
    src = src.withColumn("lead_source", F.lower("source_system"))
    return merge_upsert(target, src)


@register("merge_buckets")
def q_merge_buckets(spark, d):
    """The same merge into a table laid out in hash buckets of the
    key, of which only those that the batch touches are written again."""
    from goldvein.sources import buckets
    b, target = _batches(spark, d)
    src = mdm.golden_records(mdm.quality_scored(mdm.standardize(incremental_scan(b, target))), as_of())
    root = scratch_path(spark, "buckets")
    layout = buckets.write_buckets(target, f"{root}/v1", "contact_key")
    layout = buckets.merge_buckets(spark, layout, src.withColumn("lead_source", F.lower("source_system")), f"{root}/v2")
    return buckets.read_buckets(spark, layout)


@register("table_round_trip")
def q_table_round_trip(spark, d):
    """Bronze written partitioned by ingestion date to
    the shared folder and read back."""
    from goldvein.sources.sinks import write_bronze
    path = scratch_path(spark, "bronze")
    write_bronze(bronze(spark, d), path)
    return spark.read.parquet(path)


# ---------------------------------------------------------------- duplicates, tiers, merges

from goldvein.operators.duplicates import potential_duplicates  # noqa: E402

MDM_MATCH_THRESHOLD = 0.85   # the project's declared match floor


@register("duplicates_exact")
def q_duplicates_exact(spark, d):
    """Contact pairs with identity similarity
    > 0.92 (trigram vectors, prefix-filtered inverted index)."""
    return potential_duplicates(golden(spark, d))


@register("match_tiers")
def q_match_tiers(spark, d):
    """L3: tier and action of every pair above the match floor 0.85."""
    p = potential_duplicates(golden(spark, d), threshold=MDM_MATCH_THRESHOLD, sort=False)
    return mdm.with_match_tier(p).select("contact_key_a", "contact_key_b", "similarity_score",
                                         "match_tier", "tier_action")


@register("merged_groups")
def q_merged_groups(spark, d):
    """Connected groups of HIGH pairs (one golden id per group), from one
    edge per contact and similar pair of strings."""
    return merges.merge_groups(identities(spark, d))


# ---------------------------------------------------------------- enrichment

from goldvein.operators import enrich, text_model  # noqa: E402


@register("personas")
def q_personas(spark, d):
    """Persona of every titled golden contact."""
    return enrich.contact_personas(golden(spark, d), as_of())


@register("feedback_scored")
def q_feedback_scored(spark, d):
    """Lexicon sentiment of user feedback, labelled."""
    return enrich.feedback_scored(fx.event_feedback(spark, d), as_of())


@register("personas_trained")
def q_personas_trained(spark, d):
    """Personas with a model that learns from the titles that keyword rules know."""
    contacts = cut_to_table(golden(spark, d).select("contact_key", "job_title"), "titles")
    return enrich.contact_personas(contacts, as_of(), model=text_model.trained_personas(contacts))


@register("feedback_trained")
def q_feedback_trained(spark, d):
    """Sentiment with a model that learns from the texts that the lexicon knows."""
    feedback = fx.event_feedback(spark, d)
    return enrich.feedback_scored(feedback, as_of(), model=text_model.trained_sentiment(feedback))


@register("dq_narrative")
def q_dq_narrative(spark, d):
    """Narrative from the contact score average, the worst null rate
    and the event anomaly count."""
    g = cut_to_table(golden(spark, d), "golden")
    summ = Q.dq_summary(g, "silver_contacts", as_of()).select("model_name", "avg_dq_score")
    worst = Q.null_rates(g, "silver_contacts", NULL_RATE_COLUMNS).agg(F.max("null_pct").alias("null_pct"))
    ev = read(spark, d, "events", "event_id", "event_type", "value")
    anomalies = (anomaly_flags(ev, "event_id", "event_type", "value", as_of())
                 .agg(F.count_if(F.col("is_anomaly")).alias("anomaly_count")))
    # the other two one-row aggregates enter as scalar subqueries (no join)
    m = summ.select("model_name", "avg_dq_score", worst.scalar().alias("null_pct"),
                    anomalies.scalar().alias("anomaly_count"))
    return enrich.dq_narrative(m)


# ---------------------------------------------------------------- daily run

@register("daily_run")
def q_daily_run(spark, d):
    """The whole daily job into a fresh folder under the shared
    directory; returns the audit rows (table, action, row count)."""
    tables, audit = _daily(spark, d)
    return audit.select("table_name", "action", "row_count", "gate_branch")


def _daily(spark, d):
    from goldvein.plans.jobs import Inputs, Tables, run_daily
    inp = Inputs(fx.crm_contacts(spark, d), fx.marketing_subscribers(spark, d),
                 fx.event_registrations(spark, d), fx.silver_events(spark, d, "crm"),
                 fx.silver_brands(spark, d), fx.event_feedback(spark, d))
    tables = Tables(spark, scratch_path(spark, "lake"))
    return tables, run_daily(tables, inp, as_of())


@register("daily_rules")
def q_daily_rules(spark, d):
    """The rule results that the daily run leaves."""
    return _daily(spark, d)[0].read("governance/rule_results")


@register("bronze_refresh")
def q_bronze_refresh(spark, d):
    """A5, O1: two full refreshes; between them every third CRM contact is
    soft-deleted, and the second table holds no trace of those."""
    from goldvein.plans.jobs import Inputs, Tables, run_bronze
    crm = fx.crm_contacts(spark, d)
    rest = (fx.marketing_subscribers(spark, d), fx.event_registrations(spark, d), None, None, None)
    tables = Tables(spark, scratch_path(spark, "refresh"))
    run_bronze(tables, Inputs(crm, *rest), as_of())
    gone = F.col("_fivetran_deleted") | (F.col("id").cast("long") % 3 == 0)
    later = as_of() + F.make_dt_interval(days=F.lit(1))
    return run_bronze(tables, Inputs(crm.withColumn("_fivetran_deleted", gone), *rest), later)


@register("quarantined_facts")
def q_quarantined_facts(spark, d):
    """The facts that break a rule of the fact table, with the rules they break."""
    return Q.broken_rules(fact(spark, d), Q.FACT_RULES).select("fact_key", "event_id", "broken")


@register("revenue_anomalies")
def q_revenue_anomalies(spark, d):
    """Z-score flags of fact revenue per brand."""
    a = anomaly_flags(fact(spark, d).withColumn("revenue_amount", F.col("revenue_amount").cast("double")),
                      "fact_key", "brand_id", "revenue_amount", as_of())
    return a.select("fact_key", "brand_id", "revenue_amount", F.round("avg_value", 4).alias("avg_revenue"),
                    F.round("std_value", 4).alias("std_revenue"), F.round("z_score", 6).alias("z_score"), "is_anomaly")


@register("revenue_anomalies_in_runs")
def q_revenue_anomalies_in_runs(spark, d):
    """The same flags from moments kept per brand, to which
    three runs each add the facts of their own dates only."""
    from goldvein.operators.anomaly import flags_from_moments, merged_moments, moments
    f = cut_to_table(fact(spark, d).select("fact_key", "event_date", "brand_id", F.col("revenue_amount").cast("double").alias("revenue_amount")), "fact")
    state = None
    for run in range(3):
        new = moments(f.where(F.pmod(F.unix_date("event_date"), F.lit(3)) == run), "brand_id", "revenue_amount")
        state = cut_to_table(merged_moments(state, new, "brand_id"), "moments")
    a = flags_from_moments(f, state, "fact_key", "brand_id", "revenue_amount", as_of())
    return a.select("fact_key", "brand_id", "revenue_amount", F.round("avg_value", 4).alias("avg_revenue"),
                    F.round("std_value", 4).alias("std_revenue"), F.round("z_score", 6).alias("z_score"), "is_anomaly")


@register("secure_contacts")
def q_secure_contacts(spark, d):
    """The contact table as an analyst and as a steward read it, masks chosen by the PII flags."""
    g = Q.attach_dictionary(golden(spark, d), Q.CONTACT_DICTIONARY)
    reads = [apply_masks(g, AccessContext(user, role), pii_policy(g))
             .select(F.lit(role).alias("role"), "contact_key", "first_name", "last_name", "email", "phone", "dq_score")
             for user, role in (("a@x", ANALYST), ("s@x", ROLE_STEWARD))]
    return reads[0].unionByName(reads[1])


@register("secure_facts")
def q_secure_facts(spark, d):
    """The fact as analyst b@x reads it: rows of the granted brands, e-mail masked."""
    f = secure(fact(spark, d), AccessContext("b@x", ANALYST), "gold.fact_events", fx.brand_grants(spark, d), "brand_id")
    return f.select("fact_key", "event_id", "brand_id", "email", "rfm_segment")


@register("merge_audit")
def q_merge_audit(spark, d):
    """Audit row of merging the connected groups of HIGH pairs."""
    return mdm.merge_audit(merges.merge_groups(identities(spark, d)), "etl@x", "ROLE_DATA_ENGINEER", as_of())


@register("merged_contacts")
def q_merged_contacts(spark, d):
    """Every golden contact with the id it is merged under."""
    g = cut_to_table(identities(spark, d), "golden")
    return mdm.merged_contacts(g, merges.merge_groups(g)).select("contact_key", "email", "merged_id")


@register("merged_in_runs")
def q_merged_in_runs(spark, d):
    """The stored groups after two runs, the second of which adds every
    contact whose key ends in a digit: as if all had come at once."""
    g = cut_to_table(identities(spark, d), "golden")
    late = F.substring("contact_key", -1, 1).between("0", "9")
    first = g.where(~late)
    forest = cut_to_table(merges.forest_changes(None, merges.merge_edges(first)), "forest")
    grown = merges.forest_changes(forest, merges.merge_edges(g, fresh=g.where(late).select("contact_key")))
    both = merge_upsert(forest, grown, "node", ("group_id",))
    return both.select(F.col("node").alias("contact_key"), "group_id")


@register("dictionary_rules")
def q_dictionary_rules(spark, d):
    """K15 (K1-K5 from the schema): rules declared in the column metadata of
    the golden contacts, one pass plus one count per unique key."""
    g = Q.attach_dictionary(golden(spark, d), Q.CONTACT_DICTIONARY)
    return Q.check_from_schema(g, "silver.contacts")


@register("dictionary_run")
def q_dictionary_run(spark, d):
    """The dictionaries of contacts, fact, brands and bronze,
    two passes per table."""
    from goldvein.operators.dictionary import dictionary_run
    b = cut_to_table(bronze(spark, d), "bronze")   # each table is read several times: written once
    g = cut_to_table(mdm.golden_records(mdm.quality_scored(mdm.standardize(b)), as_of()), "golden")
    brands = fx.silver_brands(spark, d)
    f = gold.fact_events(fx.silver_events(spark, d, "crm"), g, brands, as_of())
    # The fact's contact key is null for events without a contact: the event's own key is checked.
    f = cut_to_table(f.drop("contact_key").join(
        fx.silver_events(spark, d, "crm").select(F.col("event_id").alias("_e"), "contact_key"), F.col("event_id") == F.col("_e")).drop("_e"), "fact")
    return dictionary_run({"silver.contacts": g, "gold.fact_events": f, "silver.brands": brands, "bronze.contacts": b}, as_of())


@register("review_queue")
def q_review_queue(spark, d):
    """L4: steward queue of rank > 1 records and MEDIUM pairs."""
    s = cut_to_table(scored(spark, d), "scored")   # read four times: written once
    ranked = mdm.ranked_records(s, as_of())
    pairs = mdm.with_match_tier(potential_duplicates(mdm.golden_records(s, as_of()), threshold=MDM_MATCH_THRESHOLD,
                                                     sort=False))
    return mdm.review_queue(ranked, pairs)


@register("embedding_pairs")
def q_embedding_pairs(spark, d):
    """Pairs of the embeddings table with cosine > 0.4."""
    from goldvein.operators.vector_pairs import similar_vectors
    pairs = similar_vectors(read(spark, d, "embeddings", "vec_id", "embedding"), "vec_id", "embedding", 0.4)
    return pairs.select("vec_id_a", "vec_id_b", F.round("cosine", 6).alias("cosine"))
