"""Mixing sources to target weights with hash-threshold histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch, count_rows
from .tokens import source_key

#: A document's place in its source's order: 60 bits, refined 12 at a time.
BITS, STEP = 60, 12


def _histogram_cut(scratch: Scratch, sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, cut): the largest threshold under which a source's tokens stay within `rest`.

    Tokens are summed by source and the top 12 bits of the hash; the bucket where the running sum passes the budget
    is the boundary, and only its rows are summed again by the next 12 bits, five times at most. A histogram has
    4,096 rows a source with a target, however many documents there are.
    """
    open_ = budgets.select("source", "rest", F.lit(0).cast("long").alias("cut"))
    for low in range(BITS - STEP, -1, -STEP):
        high = low + STEP
        # the first pass takes every row of the source, the later ones only those of its boundary bucket
        inside = sized.join(F.broadcast(open_), "source") if high == BITS else sized.join(F.broadcast(open_), "source").filter(F.shiftright("h", high) == F.shiftright("cut", high))
        hist = inside.groupBy("source", "rest", "cut", F.shiftright("h", low).alias("bucket")).agg(F.sum("n_tokens").alias("n"))
        run = F.sum("n").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
        over = hist.withColumn("run", run).groupBy("source", "rest", "cut").agg(
            F.min(F.when(F.col("run") > F.col("rest"), F.col("bucket"))).alias("boundary"), F.max(F.when(F.col("run") <= F.col("rest"), F.col("run"))).alias("under"), F.max("bucket").alias("last"))
        # no bucket passes the budget: everything up to the end of the range is under it
        step = over.select("source", (F.col("rest") - F.coalesce("under", F.lit(0))).alias("left"), F.coalesce(F.shiftleft("boundary", low), F.shiftleft(F.col("last") + 1, low)).alias("new_cut"))
        open_ = scratch.write(open_.join(F.broadcast(step), "source", "left").select("source", F.coalesce("left", "rest").alias("rest"), F.coalesce("new_cut", "cut").alias("cut")))
    return open_.select("source", "cut")


def mix_sources(documents: DataFrame, targets: DataFrame, tokens: str = "n_tokens", key: str = "doc_id", seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(copies, shares) of a mix as large as all documents together.

    copies: (key, source, n_tokens, copies) of the documents in the mix. shares, one row a target: (source,
    target_share, max_repeats, source_tokens, budget_tokens, mix_tokens, actual_share of the mix, target_met).

    A source's budget is its target share of all tokens, sources without a target counted in. Every document is
    taken the whole number of times the budget covers its source, capped by max_repeats; for the remainder those
    documents come once more whose seeded hash lies under the source's threshold, so a larger budget only adds.
    Nothing is sorted. target_met is read from the mix: false where its tokens stay under the budget although every
    document of the source stands in it max_repeats times.
    Spellings of a source differ in case, blanks and separators and count as one; a target named twice takes its
    first spelling, largest share and cap. Null sizes count as 0, null keys in no mix; a repeated key is a document
    each time. No documents give shares of null and copies of nothing.
    """
    scratch = Scratch(documents.sparkSession, "mix")
    h = F.shiftright(F.xxhash64(F.col(key), F.lit(seed)).bitwiseAND((1 << 63) - 1), 3)
    sized, seen = scratch.write(documents.select(F.col(key).alias(key), source_key("source").alias("source_key"), F.coalesce(F.col(tokens), F.lit(0)).cast("long").alias("n_tokens"), h.alias("h")), all_tokens=F.coalesce(F.sum("n_tokens"), F.lit(0)))
    whole = seen["all_tokens"]
    wanted = targets.withColumn("source_key", source_key("source")).filter("source_key is not null").groupBy("source_key").agg(F.min("source").alias("name"), F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    have = sized.filter(F.col(key).isNotNull()).groupBy("source_key").agg(F.sum("n_tokens").alias("source_tokens"))
    plan = wanted.join(have, "source_key", "left").select("source_key", "name", "target_share", F.greatest(F.coalesce("max_repeats", F.lit(0)), F.lit(0)).alias("max_repeats"), F.coalesce("source_tokens", F.lit(0)).alias("source_tokens"))
    budget = F.floor(F.coalesce("target_share", F.lit(0.0)) * F.lit(whole))
    plan = plan.withColumn("budget_tokens", budget).withColumn("times", F.when(F.col("source_tokens") > 0, F.least(F.floor(F.col("budget_tokens") / F.col("source_tokens")), F.col("max_repeats"))).otherwise(F.lit(0)))
    plan = scratch.write(plan.withColumn("rest", F.when(F.col("times") < F.col("max_repeats"), F.col("budget_tokens") - F.col("times") * F.col("source_tokens")).otherwise(F.lit(0))))
    named = sized.filter(F.col(key).isNotNull()).withColumnRenamed("source_key", "source")
    cuts = _histogram_cut(scratch, named, plan.filter("rest > 0 and source_tokens > 0").select(F.col("source_key").alias("source"), "rest"))
    rule = plan.join(F.broadcast(cuts.withColumnRenamed("source", "source_key")), "source_key", "left").select("source_key", "name", "times", "max_repeats", F.coalesce("cut", F.lit(0)).alias("cut"))
    taken = named.withColumnRenamed("source", "source_key").join(F.broadcast(rule), "source_key")
    dealt = taken.select(key, F.col("name").alias("source"), "n_tokens", (F.col("times") + (F.col("h") < F.col("cut")).cast("int")).cast("int").alias("copies"), "max_repeats")
    copies = dealt.filter("copies > 0").drop("max_repeats")
    # a source under its budget with no document left that may come once more cannot reach it
    reached = dealt.groupBy(F.col("source").alias("name")).agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("mix_tokens"), F.count_if(F.col("copies") < F.col("max_repeats")).alias("room"))
    full = Window.partitionBy()
    shares = plan.join(reached, "name", "left").select(
        F.col("name").alias("source"), "target_share", "max_repeats", "source_tokens", "budget_tokens", F.coalesce("mix_tokens", F.lit(0)).alias("mix_tokens"),
        (F.coalesce("mix_tokens", F.lit(0)) >= F.col("budget_tokens")).alias("full"), (F.coalesce("room", F.lit(0)) > 0).alias("room"))
    shares = shares.withColumn("target_met", F.col("full") | F.col("room")).drop("full", "room")
    shares = shares.withColumn("actual_share", F.try_divide("mix_tokens", F.sum("mix_tokens").over(full)))
    return copies, shares
