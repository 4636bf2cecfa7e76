"""Splits that keep related records together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import canonical_id, entry_of, split_label
from ..operators.components import number_vertices, star_components
from ..session import Scratch, count_rows


def expanded(frontier: DataFrame, adj: DataFrame) -> DataFrame:
    """(v, label), once each: where the labels of a frontier (v, label) come to along its adjacency rows (v, w)."""
    return frontier.join(adj, "v").select(F.col("w").alias("v"), "label").distinct()


def frontier_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(id, component) for every vertex of an undirected graph, by breadth-first search from many seeds at once.

    The adjacency lists are kept as rows, hash-partitioned by vertex and neighbour, so a hub's list lies in many parts. Seeds are the vertices whose hash is the
    smallest among their neighbours', so every component has one and none is far. In each round the frontier's
    labels go along its lists; a vertex reached first by several labels takes the smallest, and each two labels
    that meet at a vertex become an edge of a small graph over seeds. That graph, solved by stars, merges the
    labels. The component is the number of its smallest seed (ids are numbered in their order). A vertex with only a
    self edge is its own component; nulls drop out; no edges give no rows.
    """
    scratch = Scratch(edges.sparkSession, "frontier")
    vertices, numbered = number_vertices(scratch, edges, src, dst)
    one = numbered.select(F.col("u").alias("v"), F.col("v").alias("w"))
    adj = scratch.write(one.unionByName(one.select(F.col("w").alias("v"), F.col("v").alias("w"))).distinct())
    order = lambda c: F.struct(F.xxhash64(c), F.col(c))
    seeds = adj.withColumn("mine", order("v")).withColumn("its", order("w")).groupBy("v").agg(F.min("mine").alias("mine"), F.min("its").alias("its")).filter("mine <= its").select("v", F.col("v").alias("label"))
    labels, seen = scratch.write(seeds, n=count_rows())
    parts, meets, frontier, n = [labels], [], labels, seen["n"]
    while n:
        known = parts[0]
        for t in parts[1:]:
            known = known.unionByName(t)
        sent = expanded(frontier, adj)
        at = sent.groupBy("v").agg(F.min("label").alias("low")).join(known.select("v", F.col("label").alias("old")), "v", "left")
        held = scratch.write(at)
        meet = sent.join(held, "v").select(F.coalesce("old", "low").alias("u"), F.col("label").alias("v")).filter("u != v").distinct()
        frontier, seen = scratch.write(held.filter("old is null").select("v", F.col("low").alias("label")), n=count_rows())
        meets.append(scratch.write(meet))
        scratch.drop(held)
        parts.append(frontier)
        n = seen["n"]
    labels, met = reduce(DataFrame.unionByName, parts), reduce(DataFrame.unionByName, meets) if meets else adj.select(F.col("v").alias("u"), F.col("w").alias("v")).limit(0)
    merged = star_components(scratch, met).select(F.col("n").alias("label"), "root")
    rooted = labels.join(merged, "label", "left").select(F.col("v").alias("n"), F.coalesce("root", "label").alias("root"))
    return scratch.write(vertices.join(rooted, "n").select("id", F.col("root").alias("component")))


def membership_keys(membership: DataFrame) -> DataFrame:
    """(id, pdb_id, merged_group, label) of a delivered membership in canonical spelling; rows without id drop out, empty groups are null."""
    group = F.nullif(F.trim("merged_group"), F.lit(""))
    return membership.filter("id is not null").select(canonical_id("id").alias("id"), entry_of("id").alias("pdb_id"), canonical_id(group).alias("merged_group"), split_label("split").alias("label"))


def _vertex(field: str):
    return F.concat(F.lit("e:" if field == "pdb_id" else "g:"), F.col(field))


def related_components(ids: DataFrame, keys: DataFrame) -> DataFrame:
    """(id_or_key vertex, component) over entries and groups: an entry's chains share its vertex, and a row of keys links its entry to its group.

    An entry without a group links to itself.
    """
    alone = ids.select(entry_of("id").alias("pdb_id")).distinct().select(_vertex("pdb_id").alias("src"), _vertex("pdb_id").alias("dst"))
    linked = keys.filter("merged_group is not null").select(_vertex("pdb_id").alias("src"), _vertex("merged_group").alias("dst")).distinct()
    return frontier_components(alone.unionByName(linked))


def split_conflicts(membership: DataFrame) -> DataFrame:
    """(key_field, key_value) of keys whose delivered rows stand in more than one of train, valid and test.

    The delivered labels are held against the components: a component whose rows were all put in one split has no
    conflict. In the others the delivered labels are the seeds of one more expansion, from rows to their keys; the
    keys at which two labels meet are the conflicts. Rows without id or with a label that names no split count
    nowhere, missing groups are no key, repeated rows change nothing, and an empty table has no conflicts.
    """
    keys = membership_keys(membership)
    comp = related_components(keys, keys)
    slim = Scratch(membership.sparkSession, "delivered").write(keys.filter("label is not null").select("pdb_id", "merged_group", "label").distinct())
    placed = slim.withColumn("vertex", _vertex("pdb_id")).join(comp.select(F.col("id").alias("vertex"), "component"), "vertex")
    mixed = placed.groupBy("component").agg(F.min("label").alias("a"), F.max("label").alias("b")).filter("a != b").select("component")
    held = placed.join(mixed, "component", "left_semi").select(F.struct("pdb_id", "merged_group").alias("v"), "label")
    ends = F.array(*(F.struct(F.lit(c).alias("key_field"), F.col(f"v.{c}").alias("key_value")) for c in ("pdb_id", "merged_group")))
    adj = held.select("v").distinct().select("v", F.explode(ends).alias("w")).filter("w.key_value is not null")
    met = expanded(held, adj).groupBy("v").agg(F.min("label").alias("a"), F.max("label").alias("b")).filter("a != b")
    return met.select("v.key_field", "v.key_value")


def grouped_split(records: DataFrame, membership: DataFrame, shares: tuple[float, float, float] = (0.8, 0.1, 0.1), seed: int = 42, buckets_hex: int = 3) -> DataFrame:
    """(id, component_id, split) for every id of records: no entry and no group of the membership in two splits.

    component_id is the component's smallest id of records. Components stand in the order of the md5 of
    `seed:component_id`; running row shares cut that order at the given shares, a component going where its middle
    lies. A component with more rows than half the smallest share fits no evaluation split and goes to train before
    that. The running sum goes over hash buckets (16**buckets_hex, a fixed count) and then within each, so nothing
    is ordered as a whole. Repeated rows count once per id; missing ids drop out; without records there are no rows.
    """
    scratch = Scratch(records.sparkSession, "split")
    ids = records.filter("id is not null").select(canonical_id("id").alias("id")).distinct()
    comp = related_components(ids, membership_keys(membership))
    placed = ids.withColumn("vertex", F.concat(F.lit("e:"), entry_of("id"))).join(comp.select(F.col("id").alias("vertex"), "component"), "vertex").select("id", "component")
    placed, seen = scratch.write(placed, n=count_rows())
    all_n = seen["n"]
    large = F.col("n") > min(shares[1:]) / 2 * all_n
    sizes = placed.groupBy("component").agg(F.min("id").alias("component_id"), count_rows().alias("n"))
    sizes = sizes.withColumn("h", F.md5(F.concat(F.lit(f"{seed}:"), F.col("component_id")))).withColumn("bucket", F.substring("h", 1, buckets_hex))
    sizes, seen = scratch.write(sizes.withColumn("large", large), large_n=F.coalesce(F.sum(F.when(F.col("large"), F.col("n"))), F.lit(0)))
    large_n = seen["large_n"]
    small = sizes.filter("not large")
    per = small.groupBy("bucket").agg(F.sum("n").alias("bucket_n"))
    before = per.withColumn("before", F.sum("bucket_n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))).select("bucket", F.coalesce("before", F.lit(0)).alias("before"))
    inner = Window.partitionBy("bucket").orderBy("h", "component_id").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.col("before") + F.coalesce(F.sum("n").over(inner), F.lit(0)) + F.col("n") / 2
    # what large components take beyond train's share is taken from the other splits in proportion
    rest = all_n - large_n
    cut = max(shares[0] * all_n - large_n, 0.0)
    valid_end = cut + (rest - cut) * shares[1] / (shares[1] + shares[2])
    at = small.join(F.broadcast(before), "bucket").withColumn("middle", middle)
    named = at.withColumn("split", F.when(F.col("middle") < cut, "train").when(F.col("middle") < valid_end, "valid").otherwise("test"))
    decided = named.select("component", "component_id", "split").unionByName(sizes.filter("large").select("component", "component_id", F.lit("train").alias("split")))
    return placed.join(decided, "component").select("id", "component_id", "split")
