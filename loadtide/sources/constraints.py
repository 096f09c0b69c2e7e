"""Key, NOT NULL and default rules, as jobs over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadtide.functions.exprs import net_load
from loadtide.schemas import TableRules


def validate(df: DataFrame, rules: TableRules) -> DataFrame:
    """One row per rule: ``rule, column_name, violations``.

    Key violations count the rows beyond the first of each key. Counting per
    key combines on the map side, so a heavily repeated key costs no skew.
    """
    required = [c for c in rules.required if c in df.columns]
    absent = [c for c in rules.required if c not in df.columns]
    nulls = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(c) for c in required],
        *[F.count(F.lit(1)).alias(c) for c in absent],
    )
    nulls = nulls.unpivot([], rules.required, "column_name", "violations").select(
        F.lit("not_null").alias("rule"), "column_name", "violations"
    )
    repeats = (
        df.groupBy(*rules.key)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations"))
        .select(
            F.lit("unique").alias("rule"),
            F.lit(",".join(rules.key)).alias("column_name"),
            "violations",
        )
    )
    return nulls.unionByName(repeats)


def apply_defaults(df: DataFrame, rules: TableRules) -> DataFrame:
    """Fill defaults, add absent defaulted columns and the generated net load."""
    filled = {
        c: F.coalesce(F.col(c), F.lit(v)) if c in df.columns else F.lit(v)
        for c, v in rules.defaults.items()
    }
    out = df.withColumns(filled)
    if {"system_demand_mw", "solar_generation_mw", "wind_generation_mw"} <= set(out.columns):
        out = out.withColumn("net_load_mw", net_load())
    return out
