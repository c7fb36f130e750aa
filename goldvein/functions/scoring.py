"""Rule-based scores and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Completeness weights of the contact quality score (sum 100).
DQ_WEIGHTS = {"email": 25, "first_name": 15, "last_name": 15, "phone": 15,
              "company_name": 15, "job_title": 15}

# RFM segment thresholds, checked in this order.
RFM_CHAMPION = (5, 1000)   # events_last_12m >= 5 and revenue_last_12m >= 1000
RFM_LOYAL = (3, 500)       # events_last_12m >= 3 and revenue_last_12m >= 500
RFM_RECENT_DAYS = 30       # days_since_last_event <= 30
RFM_POTENTIAL = 2          # events_last_12m >= 2

# Sentiment label cut-offs (strict).
SENTIMENT_CUTOFF = 0.3

# Match tiers of the master-data rules.
TIER_HIGH = 0.95
TIER_MEDIUM = 0.92


def _filled(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def dq_score(cols: dict[str, Column], weights: dict[str, int] | None = None) -> Column:
    """0-100 completeness: weight per column that is neither NULL nor ''."""
    w = weights or DQ_WEIGHTS
    total = None
    for name, weight in w.items():
        term = F.when(_filled(cols[name]), F.lit(weight)).otherwise(F.lit(0))
        total = term if total is None else total + term
    return total


def rfm_segment(freq: Column, money: Column, recency: Column) -> Column:
    """First matching rule wins; NULL comparisons fall through."""
    return (F.when((freq >= RFM_CHAMPION[0]) & (money >= RFM_CHAMPION[1]), "CHAMPION")
            .when((freq >= RFM_LOYAL[0]) & (money >= RFM_LOYAL[1]), "LOYAL")
            .when(recency <= RFM_RECENT_DAYS, "RECENT")
            .when(freq >= RFM_POTENTIAL, "POTENTIAL")
            .otherwise("AT_RISK"))


def sentiment_label(score: Column, cutoff: float = SENTIMENT_CUTOFF) -> Column:
    return (F.when(score > cutoff, "POSITIVE")
            .when(score < -cutoff, "NEGATIVE")
            .otherwise("NEUTRAL"))


def match_tier(same_email: Column, similarity: Column,
               high: float = TIER_HIGH, medium: float = TIER_MEDIUM) -> Column:
    """EXACT (same email), HIGH (>= high), MEDIUM (>= medium), else LOW."""
    return (F.when(same_email, "EXACT")
            .when(similarity >= high, "HIGH")
            .when(similarity >= medium, "MEDIUM")
            .otherwise("LOW"))
