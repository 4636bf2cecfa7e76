"""Checks of splits, keys, orders and deliveries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import count_rows


def split_overlap(rows: DataFrame, key: str = "id", split: str = "split") -> DataFrame:
    """(key, n_splits) of keys in more than one split."""
    return rows.groupBy(key).agg(F.count_distinct(split).alias("n_splits")).filter("n_splits > 1")


def duplicate_keys(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(count_rows().alias("n")).filter("n > 1")


def missing_keys(wanted: DataFrame, present: DataFrame, key: str = "id") -> DataFrame:
    """Keys of wanted that present lacks, once each; null keys drop out."""
    return wanted.select(key).filter(F.col(key).isNotNull()).distinct().join(present.select(key), key, "left_anti")


def require(problems: DataFrame, what: str, shown: int = 5) -> None:
    """Raises ValueError with the first few rows where there is any."""
    rows = problems.limit(shown).collect()
    if rows:
        raise ValueError(f"{what}: {[tuple(r) for r in rows]}")


def required_join(left: DataFrame, right: DataFrame, key: str = "id") -> DataFrame:
    """Inner join that fails where a left key has no right row. Of columns both sides have, the right one stays."""
    require(missing_keys(left, right, key), f"no match for {key}")
    return left.drop(*(set(left.columns) & set(right.columns) - {key})).join(right, key)


def reconcile(expected: DataFrame, delivered: DataFrame, key: str = "id", ok: str | None = None) -> DataFrame:
    """One row: expected and delivered keys, missing and extra ones, repeated deliveries and failed rows (ok: a boolean column)."""
    e = expected.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("e", F.lit(1))
    d = delivered.filter(F.col(key).isNotNull()).groupBy(key).agg(count_rows().alias("n"), (F.count_if(~F.col(ok)) if ok else F.lit(0)).alias("failed"))
    j = e.join(d, key, "full_outer")
    c = lambda cond: F.count_if(cond)
    return j.agg(c(F.col("e").isNotNull()).alias("expected"), c(F.col("n").isNotNull()).alias("delivered"), c(F.col("n").isNull()).alias("missing"), c(F.col("e").isNull()).alias("extra"), c(F.col("n") > 1).alias("repeated"), F.coalesce(F.sum("failed"), F.lit(0)).alias("failed"))


def contiguous(rows: DataFrame, index: str = "row_index") -> DataFrame:
    """One row: whether an index runs from 0 to n - 1 without gaps or repeats."""
    return rows.agg(count_rows().alias("n"), F.min(index).alias("first"), F.max(index).alias("last"), F.count_distinct(index).alias("different")).select("n", ((F.col("n") == 0) | ((F.col("first") == 0) & (F.col("last") == F.col("n") - 1) & (F.col("different") == F.col("n")))).alias("contiguous"))


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows, with repeats, in one table and not in the other."""
    return a.exceptAll(b).withColumn("only_in", F.lit("left")).unionByName(b.exceptAll(a).withColumn("only_in", F.lit("right")))
