"""The data dictionary run over several tables: column rules, unique keys,
foreign keys and freshness, declared per column and compiled to two passes per
table.

A declaration is ``kind`` or ``kind:arguments``: those of
``quality.declared_rule``, and ``references:table.column``, ``fresh:hours``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldvein.operators import quality as Q
from goldvein.operators.quality import CONTACT_DICTIONARY, Dictionary, Rule, declared_rule

# The rules that the data dictionary sets for the fact, the brands and bronze.
FACT_DICTIONARY: Dictionary = {
    "fact_key": (False, ("not_null", "unique")),
    "event_id": (False, ("not_null",)),
    "event_type": (False, ("accepted:CONFERENCE|WEBINAR|WORKSHOP|ROUNDTABLE",)),
    "registration_source": (False, ("accepted:EMAIL|ORGANIC|PAID|REFERRAL",)),
    "revenue_amount": (False, ("non_negative",)),
    "contact_key": (False, ("references:silver.contacts.contact_key",)),
    "brand_id": (False, ("references:silver.brands.brand_id",)),
    "email": (True, ()),
    "rfm_segment": (False, ("accepted:CHAMPION|LOYAL|RECENT|POTENTIAL|AT_RISK",)),
}
BRAND_DICTIONARY: Dictionary = {
    "brand_id": (False, ("not_null", "unique")),
    "brand_name": (False, ("not_null", "unique")),
    "brand_region": (False, ("accepted:US|EU|APAC",)),
}
BRONZE_DICTIONARY: Dictionary = {
    "source_id": (False, ("not_null",)),
    "ingested_at": (False, ("fresh:24",)),
}
DICTIONARIES: dict[str, Dictionary] = {
    "silver.contacts": CONTACT_DICTIONARY, "gold.fact_events": FACT_DICTIONARY,
    "silver.brands": BRAND_DICTIONARY, "bronze.contacts": BRONZE_DICTIONARY,
}


@dataclass(frozen=True)
class Compiled:
    """What a table's dictionary asks for: rules of rows and of the whole
    table, columns that are unique keys, and (column, table, column) references."""
    table: str
    rules: list[Rule] = field(default_factory=list)
    uniques: list[str] = field(default_factory=list)
    references: list[tuple[str, str, str]] = field(default_factory=list)


def compiled(table: str, dictionary: Dictionary) -> Compiled:
    out = Compiled(table)
    for column, (_, specs) in dictionary.items():
        for spec in specs:
            kind, _, arg = spec.partition(":")
            if kind == "references":
                other, _, key = arg.rpartition(".")
                out.references.append((column, other, key))
            elif kind == "fresh":
                out.rules.append(Rule(f"FRESH-{column}", table, column, "fresh", params=(int(arg),)))
            elif (rule := declared_rule(table, column, spec)) is None:
                out.uniques.append(column)
            else:
                out.rules.append(rule)
    return out


def key_rules(df: DataFrame, c: Compiled, tables: dict[str, DataFrame]) -> DataFrame:
    """Rule rows of all unique and foreign keys of a table from one pass: the
    table's rows are counted per (key, value), partially before they are
    exchanged, so a value that a third of all rows hold is one row of each task.
    Rows of a repeated value (nulls count as one) break a unique key, rows of a
    value that is not null and not in the referenced table a foreign key."""
    sets = [(f"UNIQUE-{u}", u) for u in c.uniques] + [(f"REFERENCES-{col}", col) for col, _, _ in c.references]
    values = F.explode(F.array(*[F.struct(F.lit(i).alias("set"), F.col(col).cast("string").alias("value")) for i, (_, col) in enumerate(sets)]))
    counted = df.select(values.alias("x")).select("x.*").groupBy("set", "value").agg(F.count(F.lit(1)).alias("n"))
    counted = counted.withColumn("bad", F.when(F.col("set") < len(c.uniques), F.col("n") > 1).otherwise(F.lit(False)))
    if c.references:
        known = None
        for i, (_, other, key) in enumerate(c.references, len(c.uniques)):
            own = tables[other].select(F.lit(i).alias("set"), F.col(key).cast("string").alias("value")).where(F.col("value").isNotNull()).distinct()
            known = own if known is None else known.unionByName(own)
        counted = counted.join(known.withColumn("found", F.lit(True)), ["set", "value"], "left")
        orphan = (F.col("set") >= len(c.uniques)) & F.col("value").isNotNull() & F.col("found").isNull()
        counted = counted.withColumn("bad", F.col("bad") | orphan)
    # One row per key of the table, also where the table is empty.
    names = F.explode(F.array(*[F.struct(F.lit(i).alias("set"), F.lit(r).alias("rule_id"), F.lit(col).alias("column_name"))
                                for i, (r, col) in enumerate(sets)]))
    sums = counted.groupBy("set").agg(F.sum("n").alias("checked"), F.sum(F.when(F.col("bad"), F.col("n"))).alias("failed"))
    one = df.sparkSession.range(1).select(names.alias("x")).select("x.*")
    zero = F.lit(0).cast("bigint")
    rows = one.join(sums, "set", "left").select("rule_id", F.lit(c.table).alias("table_name"), "column_name",
                                                F.coalesce("checked", zero).alias("checked"), F.coalesce("failed", zero).alias("failed"))
    return Q.rule_results(rows, F.lit(100.0), "Alert")


def dictionary_run(tables: dict[str, DataFrame], as_of: Column, dictionaries: dict[str, Dictionary] = DICTIONARIES) -> DataFrame:
    """Rule rows (as ``evaluate_rules`` gives them) of every
    given table that has a dictionary: one aggregate for all rules of rows and
    freshness, one for all keys. Referenced tables must be among those given."""
    out = None
    for table, dictionary in dictionaries.items():
        if table not in tables:
            continue
        c, df = compiled(table, dictionary), tables[table]
        parts = [Q.evaluate_rules(df, c.rules, as_of)] if c.rules else []
        if c.uniques or c.references:
            parts.append(key_rules(df, c, tables))
        for p in parts:
            out = p if out is None else out.unionByName(p)
    return out
