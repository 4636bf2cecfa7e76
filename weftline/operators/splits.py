"""Grouped, weighted and chronological splits."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sequences import period
from ..session import Scratch, count_rows
from .audit import number_rows
from .rank import dedupe_exact, group_weights, representative


class TooFewGroups(ValueError):
    """Fewer eligible groups than evaluation groups wanted."""


def shuffled_order(groups: DataFrame, seed: int = 42, mode: str = "hash", key: str = "component", most: int = 1_000_000) -> DataFrame:
    """Groups with `position`; ties go by key. hash: md5("<seed>:<group>"), which every task computes for itself.
    mt19937: the sorted keys shuffled by Python's generator on the driver, for parity with earlier builds; more than
    `most` groups raise ValueError there."""
    if mode == "mt19937":
        keys = sorted(r[0] for r in groups.select(key).limit(most + 1).collect())
        if len(keys) > most:
            raise ValueError(f"over {most} groups: use the hash order")
        random.Random(seed).shuffle(keys)
        order = groups.sparkSession.createDataFrame([(k, i) for i, k in enumerate(keys)], f"{key} string, position long")
        return groups.join(order, key)
    return groups.withColumn("position", F.md5(F.concat(F.lit(f"{seed}:"), F.col(key))))


def _wanted(groups: float, found: int) -> int:
    return groups if isinstance(groups, int) else max(1, int(groups * found))


def evaluation_groups(eligible: DataFrame, test_groups: float, valid_groups: float, seed: int = 42, mode: str = "hash") -> DataFrame:
    """(component, representative, split) of the first test_groups, then valid_groups, in shuffled order.

    Each is a whole number of groups, or a share (a float) of the eligible ones, at least one. Groups are numbered by range
    partitions, so that held-out groups may grow with the table. Fewer groups than wanted raise TooFewGroups.
    """
    scratch = Scratch(eligible.sparkSession, "evaluation")
    groups, seen = scratch.write(eligible.select("component", "representative"), n=count_rows())
    test, valid = (_wanted(x, seen["n"]) for x in (test_groups, valid_groups))
    if seen["n"] < test + valid:
        raise TooFewGroups(f"only {seen['n']} eligible groups; need {test + valid}")
    n = number_rows(shuffled_order(groups, seed, mode), ["position", "component"]).filter(F.col("row_index") < test + valid)
    return scratch.write(n.select("component", "representative", F.when(F.col("row_index") < test, "test").otherwise("valid").alias("split"), "row_index"))


def grouped_split(records: DataFrame, test_groups: float, valid_groups: float, eligible: Column, order: Column, train_filter: Column | None = None, seed: int = 42, mode: str = "hash") -> tuple[DataFrame, DataFrame]:
    """(selected (id, split), evaluation groups) from records with id, component, aa and what the conditions read.

    One representative of each held-out group is evaluated; train is one record per exact sequence of the other groups.
    """
    choices = representative(records.filter(eligible), ["component"], order)
    held = evaluation_groups(choices, test_groups, valid_groups, seed, mode)
    rest = records if train_filter is None else records.filter(train_filter)
    rest = rest.join(held.select("component"), "component", "left_anti")
    train = dedupe_exact(rest, "aa", order).select("id", F.lit("train").alias("split"))
    return held.select(F.col("representative").alias("id"), "split").unionByName(train), held


def membership(records: DataFrame, selected: DataFrame, held: DataFrame) -> DataFrame:
    """(id, component, split, selected): where each record went.

    Members of a held-out group that were not chosen are heldout_excluded; selected marks evaluation records.
    """
    h = held.select("component", F.col("split").alias("held"))
    s = selected.select("id", F.col("split").alias("chosen"))
    j = records.select("id", "component").join(h, "component", "left").join(s, "id", "left")
    is_eval = F.col("chosen").isin("valid", "test")
    split = F.when(is_eval, F.col("chosen")).when(F.col("held").isNotNull(), "heldout_excluded").otherwise("train")
    return j.select("id", "component", split.alias("split"), F.coalesce(is_eval.cast("int"), F.lit(0)).alias("selected"))


def weighted_membership(records: DataFrame, selected: DataFrame, held: DataFrame, name: str) -> DataFrame:
    """(id, group_id, group_size, sampling_weight, split, selected): whole groups carry their split; selected marks every exported record."""
    weights = group_weights(records.select("id", "component"), name=name)
    j = records.select("id", "component").join(held.select("component", F.col("split").alias("held")), "component", "left").join(selected.select("id", F.lit(1).alias("chosen")), "id", "left").join(weights, "id")
    return j.select("id", "group_id", "group_size", "sampling_weight", F.coalesce("held", F.lit("train")).alias("split"), F.coalesce("chosen", F.lit(0)).alias("selected"))


def excluded(records: DataFrame, selected: DataFrame, held: DataFrame) -> DataFrame:
    """(id, reason) of the records no split took."""
    left = records.select("id", "component").join(selected.select("id"), "id", "left_anti")
    h = held.select("component", F.lit(True).alias("held"))
    return left.join(h, "component", "left").select("id", F.when(F.col("held"), "heldout_group_nonrepresentative").otherwise("exact_aa_duplicate").alias("reason"))


def chronological_split(records: DataFrame, order: Column, train_end: str = "2024-12-31", valid_end: str = "2025-12-31", test_end: str = "2026-09-30") -> DataFrame:
    """(id, split): one record per exact sequence within each period of release_date; a sequence may stand in several periods."""
    dated = records.withColumn("split", period("release_date", train_end, valid_end, test_end)).filter("split is not null")
    return dedupe_exact(dated, "aa", order, ("split",)).select("id", "split")


def novelty(split: DataFrame, components: DataFrame, name: str) -> DataFrame:
    """Evaluation rows (id, split) with `name` = 1 where no train record lies in the record's component."""
    c = components.select("id", "component")
    placed = split.join(c, "id", "left").withColumn("component", F.coalesce("component", "id"))
    seen = placed.filter("split = 'train'").select("component").distinct().withColumn("seen", F.lit(True))
    return placed.filter("split != 'train'").join(seen, "component", "left").select("id", "split", F.col("seen").isNull().cast("int").alias(name))
