"""Bronze contact scans (CRM, marketing, events) and their union."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BRONZE_COLUMNS = ("source_system", "source_id", "first_name", "last_name", "email",
                  "phone", "company_name", "job_title", "created_at", "updated_at",
                  "ingested_at")

# Per-source rename onto the common bronze schema.
MARKETING_MAP = {"contact_id": "source_id", "fname": "first_name", "lname": "last_name",
                 "email_address": "email", "mobile": "phone", "organization": "company_name",
                 "title": "job_title", "created_date": "created_at",
                 "last_modified": "updated_at", "_fivetran_synced": "ingested_at"}
EVENTS_MAP = {"registration_id": "source_id", "registrant_first_name": "first_name",
              "registrant_last_name": "last_name", "registrant_email": "email",
              "registrant_phone": "phone", "registrant_company": "company_name",
              "registrant_title": "job_title"}


def _is_false(c: Column) -> Column:
    """``flag = FALSE``: NULL flags drop, like the SQL predicate."""
    return c == F.lit(False)


def crm_scan(crm: DataFrame) -> DataFrame:
    """Soft-deleted rows out; the sync time is the ingestion time."""
    return crm.where(_is_false(F.col("_fivetran_deleted"))).select(
        F.lit("CRM").alias("source_system"), F.col("id").alias("source_id"),
        "first_name", "last_name", "email", "phone", "company_name", "job_title",
        "created_at", "updated_at", F.col("_fivetran_synced").alias("ingested_at"))


def marketing_scan(subs: DataFrame) -> DataFrame:
    """Opted-out subscribers out; columns renamed."""
    return subs.where(_is_false(F.col("unsubscribed"))).select(
        F.lit("MARKETING").alias("source_system"),
        *[F.col(a).alias(b) for a, b in MARKETING_MAP.items()])


def events_scan(regs: DataFrame, as_of: Column) -> DataFrame:
    """No filter; created = updated = registration date; ingested = now."""
    return regs.select(
        F.lit("EVENTS").alias("source_system"),
        *[F.col(a).alias(b) for a, b in EVENTS_MAP.items()],
        F.col("registration_date").alias("created_at"),
        F.col("registration_date").alias("updated_at"),
        as_of.alias("ingested_at"))


def bronze_contacts(crm: DataFrame, subs: DataFrame, regs: DataFrame, as_of: Column) -> DataFrame:
    """UNION ALL of the three conformed scans (duplicates kept). A narrow
    plan: no shuffle; filters and pruning reach each Parquet scan."""
    parts = [crm_scan(crm), marketing_scan(subs), events_scan(regs, as_of)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*BRONZE_COLUMNS)
