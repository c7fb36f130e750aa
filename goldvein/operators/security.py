"""Column masks, row-level brand filter and their binding to tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldvein.functions.masks import ALL_ROWS_ROLES, AccessContext, mask_email, mask_name, mask_phone

Mask = Callable[[Column, str], Column]

# Table -> column -> mask. The fact carries the contacts' e-mail, and has a policy of its own.
POLICIES: dict[str, dict[str, Mask]] = {
    "silver.contacts": {"email": mask_email, "phone": mask_phone},
    "gold.fact_events": {"email": mask_email},
}


def apply_masks(df: DataFrame, ctx: AccessContext, policy: dict[str, Mask]) -> DataFrame:
    """Replace each bound column by its mask for the caller's role (the role
    is a driver-side constant, so Catalyst folds the policy away)."""
    present = {c: m for c, m in policy.items() if c in df.columns}
    return df.withColumns({c: m(F.col(c), ctx.role) for c, m in present.items()})


def brand_filter(df: DataFrame, ctx: AccessContext, grants: DataFrame,
                 brand_col: str = "brand_id") -> DataFrame:
    """Rows whose brand is granted to the caller (a left-semi join); privileged roles see all."""
    if ctx.role in ALL_ROWS_ROLES:
        return df
    mine = (grants.where(F.col("user_email") == F.lit(ctx.user))
            .select(F.col("brand_id").alias("_granted")).distinct())
    return df.join(mine, df[brand_col] == mine["_granted"], "left_semi")


def pii_policy(df: DataFrame, default: Mask = mask_name) -> dict[str, Mask]:
    """Masks chosen by the PII flags in the schema metadata: the bound
    policies for e-mail and phone, ``default`` (first letter only) for others."""
    by_name = {"email": mask_email, "phone": mask_phone}
    return {f.name: by_name.get(f.name, default) for f in df.schema.fields if f.metadata.get("pii")}


def secure(df: DataFrame, ctx: AccessContext, table: str, grants: DataFrame | None = None,
           brand_col: str | None = None) -> DataFrame:
    """Read path of a governed table: row filter (if bound) then masks."""
    out = df
    if grants is not None and brand_col is not None:
        out = brand_filter(out, ctx, grants, brand_col)
    return apply_masks(out, ctx, POLICIES.get(table, {}))
