"""Per-key results that stay even when a few keys hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch

#: What one partition knows of a key; stitched in partition order.
STATE = ("part", "n", "n_value", "total", "low", "high", "first_order", "last_order", "steps")


def per_key_summary(df: DataFrame, key: str, value: str, order: str, partitions: int | None = None) -> DataFrame:
    """(key, n_rows, n_values, total, low, high, first_order, last_order, n_orders) per key, without a skewed task.

    Rows of one key and order combine before the first shuffle, so that repeats of a pair load no task. The pairs are
    range-partitioned on (key, order): Spark samples the quantiles of that composite key, so a heavy key is cut across
    as many partitions as its share of pairs needs. Each partition folds its stretch of a key into one partial state
    before anything leaves it: one state per key and partition it touches, so at most `partitions` for the heaviest
    key. They are stitched in partition order; a pair lies on one side of every cut, so orders count once.

    A null key is a key of its own. Null and NaN values count in n_rows alone; null orders in no order figure. An
    empty input gives no rows. `value` is read as double, `order` as string and compared as such.
    """
    n = partitions or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2)
    v = F.col(value).cast("double")
    slim = df.select(F.col(key).alias("key"), F.when(~F.isnan(v), v).alias("value"), F.col(order).cast("string").alias("ord"))
    pairs = slim.groupBy("key", "ord").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("n_value"), F.sum("value").alias("total"), F.min("value").alias("low"), F.max("value").alias("high"))
    cut = pairs.repartitionByRange(n, "key", "ord").withColumn("part", F.spark_partition_id())
    states = cut.groupBy("part", "key").agg(
        F.sum("n").alias("n"), F.sum("n_value").alias("n_value"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.min("ord").alias("first_order"), F.max("ord").alias("last_order"), F.count("ord").alias("steps"))
    stitched = states.groupBy("key").agg(F.sort_array(F.collect_list(F.struct(*STATE))).alias("s"))
    whole = lambda c: f"aggregate(s, 0L, (t, x) -> t + x.{c})"
    ordered = "filter(s, x -> x.first_order is not null)"
    return stitched.select(
        "key",
        F.expr(whole("n")).alias("n_rows"),
        F.expr(whole("n_value")).alias("n_values"),
        F.expr("aggregate(filter(s, x -> x.total is not null), cast(null as double), (t, x) -> coalesce(t, 0d) + x.total)").alias("total"),
        F.expr("array_min(transform(s, x -> x.low))").alias("low"),
        F.expr("array_max(transform(s, x -> x.high))").alias("high"),
        F.expr(f"try_element_at({ordered}, 1).first_order").alias("first_order"),
        F.expr(f"try_element_at({ordered}, -1).last_order").alias("last_order"),
        F.expr(whole("steps")).alias("n_orders"),
    )


def heavy_keys(summary: DataFrame, share: float) -> DataFrame:
    """(key, n_rows) of the keys, null aside, with at least `share` of all rows a summary counts."""
    table, seen = Scratch(summary.sparkSession, "heavy").write(summary.select("key", "n_rows"), whole=F.coalesce(F.sum("n_rows"), F.lit(0)))
    return table.filter((F.col("n_rows") >= share * seen["whole"]) & F.col("key").isNotNull())
