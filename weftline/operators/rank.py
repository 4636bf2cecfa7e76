"""Deterministic representatives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_quality() -> Column:
    """Highest quality score, then smallest id; a null or NaN score comes last."""
    q = F.nanvl(F.col("quality_score"), F.lit(None).cast("double"))
    return F.struct(F.coalesce(-q, F.lit(float("inf"))).alias("a"), F.col("id").alias("z"))


def by_completeness() -> Column:
    """Fewest internal gaps, most complete backbone, best resolution, smallest id; missing values count as 10**9, 0 and 999."""
    clean = lambda c, x: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.lit(float(x)))
    return F.struct(F.coalesce("internal_missing_residues", F.lit(10**9)).alias("a"), (-clean("backbone_complete_fraction", 0)).alias("b"), clean("resolution", 999).alias("c"), F.col("id").alias("z"))


def representative(df: DataFrame, keys: list[str], order: Column, name: str = "representative") -> DataFrame:
    """(keys..., name): the id that comes first in `order` within each key. A minimum over structs, combined map-side."""
    return df.groupBy(*keys).agg(F.min(order)["z"].alias(name))


def dedupe_exact(df: DataFrame, key: str, order: Column, within: tuple[str, ...] = ()) -> DataFrame:
    """One id per exact key (and per `within`), the first in `order`; null keys drop out."""
    return representative(df.filter(F.col(key).isNotNull()).withColumn("__key", F.xxhash64(key)), [*within, "__key", key], order, "id").drop("__key")


def group_weights(members: DataFrame, group: str = "component", name: str = "sequence") -> DataFrame:
    """(id, group_id, group_size, sampling_weight): `<name>:<group>` and one over the group's size."""
    sizes = members.groupBy(group).agg(F.count(F.lit(1)).alias("group_size"))
    return members.join(sizes, group).select("id", F.concat(F.lit(f"{name}:"), F.col(group)).alias("group_id"), "group_size", (1.0 / F.col("group_size")).alias("sampling_weight"))
