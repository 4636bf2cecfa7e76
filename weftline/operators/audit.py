"""Auditing splits by pairwise hits, and repairing conflicts until none is left."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch, count_rows
from .quality import evaluation_length, similarity_hit
from .rank import by_quality, representative


def audit_summary(hits: DataFrame) -> DataFrame:
    """(n_hits, n_violations) over all rows of hits."""
    return hits.agg(count_rows().alias("n_hits"), F.count_if(similarity_hit()).alias("n_violations"))


def cross_split_hits(hits: DataFrame, selected: DataFrame) -> DataFrame:
    """Violating hits between two splits: (kind, query, target), kind being valid_train, test_train or valid_test.

    Hits carry query_id and target_id in either order; the side named last in the kind is the target. An id drops
    out where no split took it.
    """
    s = selected.select("id", "split")
    a, b = s.select(F.col("id").alias("query_id"), F.col("split").alias("qs")), s.select(F.col("id").alias("target_id"), F.col("split").alias("ts"))
    j = hits.filter(similarity_hit()).select("query_id", "target_id").distinct().join(a, "query_id").join(b, "target_id").filter("qs != ts")
    rank = lambda c: F.when(c == "valid", 0).when(c == "test", 1).otherwise(2)
    first = rank(F.col("qs")) < rank(F.col("ts"))
    low, high = F.when(first, F.col("qs")).otherwise(F.col("ts")), F.when(first, F.col("ts")).otherwise(F.col("qs"))
    return j.select(F.concat_ws("_", low, high).alias("kind"), F.when(first, F.col("query_id")).otherwise(F.col("target_id")).alias("query"), F.when(first, F.col("target_id")).otherwise(F.col("query_id")).alias("target")).distinct()


@dataclass
class RepairState:
    """What one repair round hands to the next; tables, not driver collections."""

    selected: DataFrame
    blocked: DataFrame
    order: DataFrame
    rounds: list[dict] = field(default_factory=list)
    status: str = "repair_pending_reaudit"


def initial_order(membership: DataFrame, seed: int = 42) -> DataFrame:
    """(merged_group, position) of the groups in train at the start, in seeded hash order. It stays fixed for all rounds."""
    train = membership.filter("split = 'train'").select("merged_group").distinct()
    return train.withColumn("position", F.md5(F.concat(F.lit(f"{seed}:"), F.col("merged_group"))))


def repair_round(hits: DataFrame, members: DataFrame, state: RepairState, test_count: int | None = None, partly: bool = False) -> RepairState:
    """One round over audited hits (see cross_split_hits).

    A train group hit by valid or test is blocked and its members leave train; a test group hit by valid is blocked and
    leaves test; valid never changes. Test is refilled to test_count (as many as before, unless given) with one
    representative each of the first groups of the initial order that are neither blocked nor evaluated; their members
    leave train. members: id, merged_group, length, quality_score. Without hits the state is passed on as passed. Too
    few groups to refill with raise ValueError, unless partly: then all there are refill it.
    """
    scratch = Scratch(members.sparkSession, "repair")
    group = members.select("id", "merged_group")
    audited, seen = scratch.write(cross_split_hits(hits, state.selected), n=count_rows(), train=F.count_if(F.col("kind").endswith("_train")))
    if not seen["n"]:
        return RepairState(state.selected, state.blocked, state.order, [*state.rounds, {"train_hit_rows": 0, "valid_test_hit_rows": 0}], "sequence_audit_passed")
    struck = scratch.write(audited.select("kind", F.col("target").alias("id")).distinct().join(group, "id").select(F.when(F.col("kind").endswith("_train"), "train").otherwise("test").alias("split"), "merged_group").distinct())
    blocked, n_blocked = scratch.write(state.blocked.select("merged_group").unionByName(struck.select("merged_group")).distinct(), n=count_rows())
    placed, before = scratch.write(state.selected.join(group, "id", "left"), test=F.count_if(F.col("split") == "test"))
    kept, after = scratch.write(placed.join(struck, ["split", "merged_group"], "left_anti"), test=F.count_if(F.col("split") == "test"))
    want = before["test"] if test_count is None else test_count
    short = max(0, want - after["test"])
    evaluated = kept.filter("split != 'train'").select("merged_group").distinct()
    free = state.order.join(blocked, "merged_group", "left_anti").join(evaluated, "merged_group", "left_anti")
    reps = representative(members.filter(evaluation_length()), ["merged_group"], by_quality(), "id")
    numbered = number_rows(free.join(reps, "merged_group").select("position", "merged_group", "id"), ["position", "merged_group"])
    fill, got = scratch.write(numbered.filter(F.col("row_index") < short).select("id", F.lit("test").alias("split"), "merged_group"), n=count_rows())
    if got["n"] < short and not partly:
        raise ValueError(f"could replenish only {after['test'] + got['n']} of {want} test groups")
    moved = fill.select("merged_group", F.lit("train").alias("split"))
    rest = kept.join(moved, ["split", "merged_group"], "left_anti")
    selected, n = scratch.write(rest.select("id", "split").unionByName(fill.select("id", "split")), train=F.count_if(F.col("split") == "train"), valid=F.count_if(F.col("split") == "valid"), test=F.count_if(F.col("split") == "test"))
    metrics = {"train_hit_rows": seen["train"], "valid_test_hit_rows": seen["n"] - seen["train"], "blocked_groups": n_blocked["n"], "test_groups_replaced": got["n"], **{f"{k}_records_after": v for k, v in n.items()}}
    return RepairState(selected, blocked, state.order, [*state.rounds, metrics])


def repair_to_fixpoint(audit: Callable[[DataFrame], DataFrame], members: DataFrame, state: RepairState, max_rounds: int = 20, test_count: int | None = None, partly: bool = False) -> RepairState:
    """Audit and repair until an audit finds nothing. audit: selected -> hits. No clean audit in max_rounds raises RuntimeError."""
    for _ in range(max_rounds):
        state = repair_round(audit(state.selected), members, state, test_count, partly)
        if state.status == "sequence_audit_passed":
            return state
    raise RuntimeError(f"no clean audit in {max_rounds} rounds")


def repaired_membership(members: DataFrame, state: RepairState, initial_eval: DataFrame) -> DataFrame:
    """(id, merged_group, split, selected_representative) after repair.

    valid, test or heldout_excluded in an evaluated group, sequence_audit_removed in a blocked one, else train where
    the group still has a train record, heldout_excluded where it was evaluated at first, else train_excluded.
    """
    s = state.selected.select("id", "split").join(members.select("id", "merged_group"), "id")
    per = s.groupBy("merged_group").agg(F.max(F.col("split") != "train").alias("evaluated"), F.max(F.col("split") == "train").alias("trained"))
    flag = lambda t, name: t.select("merged_group").distinct().withColumn(name, F.lit(True))
    j = members.select("id", "merged_group").join(per, "merged_group", "left").join(flag(state.blocked, "is_blocked"), "merged_group", "left").join(flag(initial_eval, "was_eval"), "merged_group", "left").join(s.filter("split != 'train'").select("id", "split"), "id", "left")
    label = (
        F.when(F.col("evaluated"), F.coalesce("split", F.lit("heldout_excluded"))).when(F.col("is_blocked"), "sequence_audit_removed")
        .when(F.col("trained"), "train").when(F.col("was_eval"), "heldout_excluded").otherwise("train_excluded")
    )
    return j.select("id", "merged_group", label.alias("split"), (F.col("evaluated") & F.col("split").isNotNull()).cast("int").alias("sel")).select("id", "merged_group", "split", F.coalesce("sel", F.lit(0)).alias("selected_representative"))


def repaired_excluded(members: DataFrame, state: RepairState, initial_eval: DataFrame) -> DataFrame:
    """(id, reason) of the records no split holds after repair: their group was blocked, is or was evaluated, or they repeat a sequence."""
    flag = lambda t, name: t.select("merged_group").distinct().withColumn(name, F.lit(True))
    evaluated = state.selected.filter("split != 'train'").join(members.select("id", "merged_group"), "id").unionByName(initial_eval.select("merged_group"), allowMissingColumns=True)
    left = members.select("id", "merged_group").join(state.selected.select("id"), "id", "left_anti").join(flag(state.blocked, "b"), "merged_group", "left").join(flag(evaluated, "e"), "merged_group", "left")
    return left.select("id", F.when(F.col("b"), "sequence_audit_conflict_group_removed").when(F.col("e"), "heldout_group_nonrepresentative").otherwise("exact_aa_duplicate_or_group_member").alias("reason"))


def number_rows(df: DataFrame, order: list[str], name: str = "row_index") -> DataFrame:
    """Rows numbered from 0 in a total order, without sorting in one task.

    Range partitions are sorted, counted, and numbered from the sum of the counts before them: one count a partition
    is all that comes together. The order must be total, else equal rows number freely among themselves.
    """
    scratch = Scratch(df.sparkSession, "rows")
    cut = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id())
    t = scratch.write(cut)
    first = t.groupBy("__part").agg(count_rows().alias("n"), F.min("__at").alias("__first"))
    base = first.withColumn("__base", F.coalesce(F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    return t.join(F.broadcast(base), "__part").withColumn(name, F.col("__at") - F.col("__first") + F.col("__base")).drop("__part", "__at", "__first", "__base")


def number_in_place(df: DataFrame, name: str = "row_index") -> DataFrame:
    """Rows numbered from 0 in the order they are read in. A scan's partition is numbered in itself, from the count of those
    before it; reading twice must give the same rows."""
    at = df.withColumn("__at", F.monotonically_increasing_id()).withColumn("__part", F.shiftright("__at", 33))
    before = at.groupBy("__part").agg(count_rows().alias("n")).select("__part", F.coalesce(F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__base"))
    own = F.row_number().over(Window.partitionBy("__part").orderBy("__at")) - 1
    return at.join(F.broadcast(before), "__part").withColumn(name, own + F.col("__base")).drop("__part", "__at", "__base")
