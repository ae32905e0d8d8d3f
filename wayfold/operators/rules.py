"""Ordered rule tables as CASE expressions: the first rule that holds decides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def decide(rules: Sequence[tuple[Column, str, str]], otherwise: tuple[str, str] = ("NONE", "")) -> Column:
    """Struct(decision, reason) of rules (condition, decision, reason)."""
    pair = lambda d, r: F.struct(F.lit(d).alias("decision"), F.lit(r).alias("reason"))
    out = pair(*otherwise)
    for condition, decision, reason in reversed(list(rules)):
        out = F.when(condition, pair(decision, reason)).otherwise(out)
    return out


def issues(checks: Sequence[tuple[Column, str]]) -> Column:
    """Array of the names of all checks that hold."""
    return F.array_compact(F.array(*[F.when(c, F.lit(name)) for c, name in checks]))


def score(parts: Sequence[tuple[Column, float]]) -> Column:
    """Sum of the points of the conditions that hold."""
    return sum((F.when(c, F.lit(float(p))).otherwise(F.lit(0.0)) for c, p in parts), F.lit(0.0))


def product(factors: Sequence[tuple[Column, float]]) -> Column:
    """Product of the factors of all conditions that hold; 0 blocks."""
    out = F.lit(1.0)
    for c, f in factors:
        out = out * F.when(c, F.lit(float(f))).otherwise(F.lit(1.0))
    return out


def apply_plan(master: DataFrame, plan: DataFrame, key: str, name: str = "name", category: str = "category") -> DataFrame:
    """Rename, recategorise or remove rows by a plan (key, action, new_value); an unmatched row stays."""
    p = plan.select(key, F.col("action").alias("action_"), F.col("new_value").alias("new_"))
    j = master.join(p, key, "left").where("action_ is null or action_ <> 'REMOVE'")
    fill = lambda c, a: F.when((F.col("action_") == a) & (F.trim("new_") != ""), F.col("new_")).otherwise(F.col(c))
    return j.withColumn(name, fill(name, "RENAME")).withColumn(category, fill(category, "RECATEGORY")).drop("action_", "new_")
