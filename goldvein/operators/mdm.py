"""Silver cleansing and master-data resolution (golden records)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldvein.functions.keys import contact_key
from goldvein.functions.scoring import dq_score
from goldvein.functions.text import clean_email, format_phone, initcap_words, mvr_email, unmarked
from goldvein.operators.skew import row_number_within

# The columns of the silver contact table.
SILVER_COLUMNS = ("contact_key", "source_system", "source_id", "first_name", "last_name",
                  "email", "phone", "company_name", "job_title", "mdm_golden_id", "dq_score",
                  "dedup_rank", "created_at", "updated_at", "ingested_at", "silver_processed_at")


def _standard(key_sep: str = "") -> dict[str, Column]:
    """The standardised columns that differ from the raw ones."""
    return {"first_name": F.trim(initcap_words(F.col("first_name"))),
            "last_name": F.trim(initcap_words(F.col("last_name"))),
            "email": clean_email(F.col("email")),
            "phone": format_phone(F.col("phone")),
            "company_name": F.trim("company_name"),
            "job_title": F.trim("job_title"),
            "contact_key": contact_key(F.col("email"), F.col("first_name"), F.col("last_name"), key_sep)}


def standardize(bronze: DataFrame, key_sep: str = "") -> DataFrame:
    """Trim / capitalise names, clean e-mail, format phone, derive the
    contact key from the raw values; keep rows with a plausible e-mail."""
    std = _standard(key_sep)
    return bronze.where(mvr_email(F.col("email"))).select(*[
        std[c].alias(c) if c in std else F.col(c)
        for c in ("source_system", "source_id", "first_name", "last_name", "email", "phone", "company_name",
                  "job_title", "created_at", "updated_at", "ingested_at", "contact_key")])


def quality_scored(std: DataFrame) -> DataFrame:
    cols = {c: F.col(c) for c in ("email", "first_name", "last_name", "phone", "company_name", "job_title")}
    return std.withColumn("dq_score", dq_score(cols))


def _best_order() -> list[Column]:
    """Survivor order: score desc, created asc (NULLs last), then source."""
    return [F.col("dq_score").desc(), F.col("created_at").asc_nulls_last(),
            F.col("source_system").asc(), F.col("source_id").asc()]


def _best_key() -> Column:
    """The survivor order as a struct whose minimum is the survivor."""
    return F.struct((-F.col("dq_score")).alias("s"), F.col("created_at").isNull().alias("n"),
                    F.col("created_at").alias("c"), F.col("source_system").alias("y"),
                    F.col("source_id").alias("i"))


def _earliest_key() -> Column:
    """Golden-id order: created asc (NULLs last), then source."""
    return F.struct(F.col("created_at").isNull().alias("n"), F.col("created_at").alias("c"),
                    F.col("source_system").alias("y"), F.col("source_id").alias("i"))


def golden_records(scored: DataFrame, as_of: Column, prefer: str = "best") -> DataFrame:
    """One survivor per e-mail (rank 1) with the group's golden id.

    Expressed as one grouped aggregate (``min_by`` over ordering structs)
    instead of two windows: partial aggregation runs before the shuffle, so
    an e-mail shared by a third of all rows costs no more than any other
    group, and the shuffle moves one partial row per (task, e-mail).

    ``prefer='best'`` keeps the highest score (the code's rule);
    ``'earliest'`` keeps the earliest record (the dictionary's rule).
    """
    payload = F.struct(*[F.col(c) for c in scored.columns])
    order = _best_key() if prefer == "best" else _earliest_key()
    g = scored.groupBy("email").agg(
        F.min_by(payload, order).alias("_row"),
        F.min_by(F.col("contact_key"), _earliest_key()).alias("mdm_golden_id"))
    out = g.select("_row.*", "mdm_golden_id")
    return out.select(
        *[F.col(c) for c in SILVER_COLUMNS if c not in ("dedup_rank", "silver_processed_at")],
        F.lit(1).cast("bigint").alias("dedup_rank"),
        as_of.alias("silver_processed_at")).select(*SILVER_COLUMNS)


def golden_identities(bronze: DataFrame) -> DataFrame:
    """Key, e-mail, names and company of the golden records of ``bronze`` (those of
    ``golden_records(quality_scored(standardize(bronze)))``).

    The survivor order needs the clean e-mail and which columns are filled, no
    more: names are capitalised and keys hashed for the survivors alone, and a
    record is sorted and shuffled with the few columns that are asked for."""
    def filled_as(c):   # as filled as the standardised column
        return F.trim(unmarked(F.col(c)))
    score = dq_score({"email": clean_email(F.col("email")), "first_name": filled_as("first_name"),
                      "last_name": filled_as("last_name"), "phone": F.col("phone"),
                      "company_name": F.trim("company_name"), "job_title": F.trim("job_title")})
    raw = bronze.where(mvr_email(F.col("email"))).withColumns({"dq_score": score, "_clean": clean_email(F.col("email"))})
    best = raw.groupBy("_clean").agg(F.min_by(F.struct("email", "first_name", "last_name", "company_name"),
                                              _best_key()).alias("_row")).select("_row.*")
    std = _standard()
    return best.select(*[std[c].alias(c) for c in ("contact_key", "email", "first_name", "last_name", "company_name")])


def ranked_records(scored: DataFrame, as_of: Column) -> DataFrame:
    """Every record with its exact ``dedup_rank`` and golden id (for the
    steward queue). Ranks come from the skew-safe row numbering; the golden
    id from a grouped ``min_by`` joined back on e-mail."""
    ranked = row_number_within(scored, ["email"], _best_order(), "dedup_rank")
    gid = scored.groupBy("email").agg(F.min_by(F.col("contact_key"), _earliest_key()).alias("mdm_golden_id"))
    return (ranked.join(gid, "email", "left")
            .withColumn("silver_processed_at", as_of).select(*SILVER_COLUMNS))


def steward_queue(scored: DataFrame, as_of: Column) -> DataFrame:
    """Duplicates (rank > 1) for steward review."""
    return ranked_records(scored, as_of).where(F.col("dedup_rank") > 1)


def silver_contacts(bronze: DataFrame, as_of: Column, prefer: str = "best") -> DataFrame:
    """Standardise, score, resolve: the silver build of one batch."""
    return golden_records(quality_scored(standardize(bronze)), as_of, prefer)


# ------------------------------------------------------------------ match tiers and merges

from goldvein.functions.scoring import TIER_HIGH, TIER_MEDIUM, match_tier  # noqa: E402
from goldvein.session import cut_lineage, cut_to_table  # noqa: E402

# The action of each match tier.
TIER_ACTIONS = {"EXACT": "Auto-merge", "HIGH": "Auto-merge with audit log",
                "MEDIUM": "Steward review queue", "LOW": "Reject — keep separate"}


def with_match_tier(pairs: DataFrame, high: float = TIER_HIGH, medium: float = TIER_MEDIUM) -> DataFrame:
    """Tier and action per scored pair (EXACT when the e-mails agree)."""
    tier = match_tier(F.col("email_a") == F.col("email_b"), F.col("similarity_score"), high, medium)
    action = F.create_map(*[x for k, v in TIER_ACTIONS.items() for x in (F.lit(k), F.lit(v))])
    return pairs.withColumn("match_tier", tier).withColumn("tier_action", F.element_at(action, tier))


def connected_groups(edges: DataFrame, a: str = "contact_key_a", b: str = "contact_key_b") -> DataFrame:
    """(node, group_id): each node of the edge list labelled with the
    smallest node of its connected component (self-loops are ignored).

    Alternating large-star and small-star rounds on the edge list (Kiveris
    et al., "Connected Components in MapReduce and Beyond", 2014): each
    round links nodes to the smallest node of their neighbourhood, which
    keeps the components and ends in one star per component, centred on its
    smallest node, after O(log^2 n) rounds (not O(diameter) as plain label
    propagation on a long chain). Every step is a partial ``min`` per node
    and an equi-join back on the node; a node adjacent to a third of all
    edges is a skewed join key that AQE's skew join splits. Each round is
    written as a Parquet table in the shared folder (a plain scan starts
    the next round: bounded plan and lineage, survives executor loss); the
    loop stops when every leaf has one centre and no centre is a leaf (one
    scalar count per round reaches the driver)."""
    u, v = F.col("u"), F.col("v")
    e = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where(F.col("x") != F.col("y"))
    # Normalised undirected edges: u > v.
    e = cut_to_table(e.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct(),
                     "cc_edges")
    while True:
        # Large star: m(x) = min of x and its neighbours; every neighbour
        # y > x is linked to m(x) instead of x.
        both = e.unionByName(e.select(v.alias("u"), u.alias("v")))
        low = both.groupBy("u").agg(F.least(u, F.min("v")).alias("m"))
        large = both.where(v > u).join(low, "u").select(v.alias("u"), F.col("m").alias("v"))
        # (the large-star edges feed only the small star of the same round:
        # one table per round, distinct as a partial aggregate)
        e = large.distinct()
        # Small star: for x, the smaller neighbours and x itself are all
        # linked to the smallest of them.
        small_m = e.groupBy("u").agg(F.min("v").alias("m"))
        small = (e.join(small_m, "u").select(v.alias("u"), F.col("m").alias("v"))
                 .where(u != v).unionByName(small_m.select("u", F.col("m").alias("v"))))
        e = cut_to_table(small.distinct(), "cc_edges")
        # Stars: every leaf (a u) has one centre, and no centre (a v) is a leaf.
        shared = e.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("u")
        mixed = e.select("u").join(e.select(F.col("v").alias("u")).distinct(), "u", "left_semi")
        if shared.unionByName(mixed).limit(1).count() == 0:
            break
    return (e.select(u.alias("node"), v.alias("group_id"))
            .unionByName(e.select(v.alias("node"), v.alias("group_id")).distinct()))


def star_groups(edges: DataFrame, a: str = "contact_key_a", b: str = "contact_key_b") -> DataFrame:
    """``connected_groups`` for edges that are mostly stars around their smallest node.

    A node whose only edge leads to a smaller node is nobody's smallest node
    and joins no two others: it takes no part in the rounds, and gets the group
    of that neighbour at the end. The rounds run over the edges of inner nodes,
    those with a smaller neighbour and another edge; other edge lists are right
    as well, they only have fewer nodes to set aside."""
    u, v = F.col("u"), F.col("v")
    e = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where(F.col("x") != F.col("y"))
    e = cut_to_table(e.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct(), "star_edges")
    ends = e.select("u", F.lit(1).alias("up")).unionByName(e.select(v.alias("u"), F.lit(0).alias("up")))
    # Counted in numbers alone: a hash aggregate, where the smallest string of each node would be sorted for.
    inner = cut_to_table(ends.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.max("up").alias("up"))
                         .where("n > 1 AND up = 1").select("u"), "star_inner")
    if inner.limit(1).count() == 0:
        return e.select(u.alias("node"), v.alias("group_id")).unionByName(
            e.select(v.alias("node"), v.alias("group_id")).distinct())
    groups = connected_groups(e.join(inner, "u", "left_semi"), "u", "v")
    points = e.join(inner, "u", "left_anti")
    below = points.join(groups.select(F.col("node").alias("v"), "group_id"), "v", "left")
    alone = points.select("v").distinct().join(groups.select(F.col("node").alias("v")), "v", "left_anti")
    return (groups.unionByName(below.select(u.alias("node"), F.coalesce("group_id", v).alias("group_id")))
            .unionByName(alone.select(v.alias("node"), v.alias("group_id"))))


def auto_merge_groups(tiered_pairs: DataFrame) -> DataFrame:
    """HIGH pairs merged into one golden id per connected group. The pair
    search can run directly at the HIGH bound (``inclusive=True``)."""
    high = tiered_pairs.where(F.col("match_tier") == "HIGH")
    return connected_groups(high).select(F.col("node").alias("contact_key"), "group_id")


def merged_contacts(contacts: DataFrame, groups: DataFrame) -> DataFrame:
    """Contacts with ``merged_id``: the group's id, or their own key outside any group."""
    return (contacts.join(groups, "contact_key", "left")
            .withColumn("merged_id", F.coalesce("group_id", "contact_key")).drop("group_id"))


def merge_audit(groups: DataFrame, user: str, role: str, event_time: Column) -> DataFrame:
    """One audit row of an automatic merge: contacts merged away, groups left."""
    return groups.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("group_id").alias("groups")).select(
        F.lit("silver.contacts").alias("table_name"), F.lit("AUTO_MERGE").alias("action"),
        (F.col("n") - F.col("groups")).alias("row_count"), "groups",
        F.lit(user).alias("user_name"), F.lit(role).alias("role_name"), event_time.alias("event_time"))


def rededuplicated(target: DataFrame, scored_batch: DataFrame, as_of: Column) -> DataFrame:
    """The e-mail groups that the batch touches, resolved over their target rows
    plus the batch rows. A golden id, once assigned to an e-mail, is kept."""
    old = target.join(scored_batch.select("email").distinct(), "email", "left_semi")
    fresh = golden_records(scored_batch.unionByName(old.select(*scored_batch.columns)), as_of)
    ids = old.groupBy("email").agg(F.min("mdm_golden_id").alias("_old_gid"))
    return (fresh.join(ids, "email", "left")
            .withColumn("mdm_golden_id", F.coalesce(F.col("_old_gid"), F.col("mdm_golden_id")))
            .drop("_old_gid").select(*fresh.columns))


def replace_emails(target: DataFrame, fresh: DataFrame, scored_batch: DataFrame) -> DataFrame:
    """The target with the rows of the batch's e-mails replaced by ``fresh``."""
    keep = target.join(scored_batch.select("email").distinct(), "email", "left_anti")
    return keep.unionByName(fresh, allowMissingColumns=True).select(*target.columns)


def rededuplicate(target: DataFrame, scored_batch: DataFrame, as_of: Column) -> DataFrame:
    """Batch resolution that also sees the target (fixes the batch-only
    dedup of the default merge): every e-mail group touched by the batch is
    re-resolved over its target rows plus the batch rows, and replaces its
    old rows; untouched groups stay, golden ids are stable."""
    return replace_emails(target, rededuplicated(target, scored_batch, as_of), scored_batch)


def review_queue(ranked_duplicates: DataFrame, tiered_pairs: DataFrame) -> DataFrame:
    """L4: the steward queue: records ranked below their survivor (same
    e-mail) and MEDIUM similarity pairs, in one shape (reason, contact_key,
    related_key, email, score)."""
    dup = ranked_duplicates.where(F.col("dedup_rank") > 1).select(
        F.lit("DUPLICATE_RANK").alias("reason"), "contact_key",
        F.col("mdm_golden_id").alias("related_key"), "email",
        F.col("dedup_rank").cast("double").alias("score"))
    med = tiered_pairs.where(F.col("match_tier") == "MEDIUM").select(
        F.lit("MEDIUM_MATCH").alias("reason"), F.col("contact_key_a").alias("contact_key"),
        F.col("contact_key_b").alias("related_key"), F.col("email_a").alias("email"),
        F.col("similarity_score").alias("score"))
    return dup.unionByName(med)
