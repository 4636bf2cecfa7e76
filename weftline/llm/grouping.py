"""Pairwise matches to groups: strip leaves, compress chains by list ranking, solve the core, restore labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.components import number_vertices, star_components
from ..session import Scratch, count_rows


def _reversed(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _doubled(p: DataFrame) -> DataFrame:
    """Every open pointer joined to the one that leaves where it stands, away from where it came from."""
    nxt = p.select(F.col("v").alias("cur"), F.col("back").alias("frm"), F.col("cur").alias("cur2"), F.col("frm").alias("frm2"), F.col("rank").alias("rank2"), F.col("least").alias("least2"))
    step = p.filter("open").join(nxt, ["cur", "frm"], "left")
    on = F.col("cur2").isNotNull()
    moved = step.select(
        "v", "back", F.coalesce("cur2", "cur").alias("cur"), F.when(on, F.col("frm2")).otherwise(F.col("frm")).alias("frm"),
        (F.col("rank") + F.coalesce("rank2", F.lit(0))).alias("rank"), F.least("least", F.coalesce("least2", "least")).alias("least"), on.alias("open"), (F.col("changed") | (on & (F.col("least2") < F.col("least")))).alias("changed"),
    )
    return moved.unionByName(p.filter("not open"))


def _rank_chains(scratch: Scratch, low: DataFrame) -> tuple[DataFrame, DataFrame]:
    """List ranking over the degree-two vertices by pointer doubling.

    A pointer (v, back) walks from v away from its neighbour back: cur is where it stands, frm the vertex before it,
    rank the steps so far, least the smallest chain vertex passed. Pointers that reach a vertex of another degree
    are done. On a pure cycle none is ever done: they have passed every vertex once no least value changes any more.
    Returns (done, cycling).
    """
    turn = F.array(F.struct(F.col("n1").alias("back"), F.col("n2").alias("cur")), F.struct(F.col("n2").alias("back"), F.col("n1").alias("cur")))
    p = low.filter("d = 2").select("v", F.explode(turn).alias("x")).select("v", "x.back", "x.cur", F.col("v").alias("frm"), F.lit(1).cast("long").alias("rank"), F.col("v").alias("least"), F.lit(True).alias("open"))
    old, was = None, -1
    while True:
        flat = p.withColumn("changed", F.lit(False))
        new, seen = scratch.write(_doubled(flat), n_open=F.count_if("open"), changed=F.count_if("changed"))
        if old is not None:
            scratch.drop(old)
        old, p = new, new.drop("changed")
        if not seen["n_open"] or (seen["n_open"] == was and not seen["changed"]):
            return p.filter("not open"), p.filter("open")
        was = seen["n_open"]


def _reduce(scratch: Scratch, edges: DataFrame, n_edges: int, least_gain: float) -> tuple[DataFrame, DataFrame, int] | None:
    """One round of rake and compress: (remaining edges, removed (v, parent), remaining edge count), or None where too few
    vertices of degree one and two are left."""
    low, seen = scratch.write(_reversed(edges).groupBy(F.col("u").alias("v")).agg(count_rows().alias("d"), F.min("v").alias("n1"), F.max("v").alias("n2")).filter("d <= 2"), n=count_rows())
    if not seen["n"] or seen["n"] < least_gain * n_edges:
        return None
    leaf = low.filter("d = 1").select("v", F.col("n1").alias("next"))
    done, cycling = _rank_chains(scratch, low)
    end = leaf.select(F.col("v").alias("cur"), F.lit(True).alias("leaf"))
    ends = done.join(end, "cur", "left").select("v", "back", "cur", "rank", F.coalesce("leaf", F.lit(False)).alias("leaf"))
    # both ends of a chain vertex; it hangs on the inner end, of two equal kinds on the smaller one
    pairs = scratch.write(ends.groupBy("v").agg(F.min(F.struct("leaf", "cur")).alias("a"), F.max(F.struct("leaf", "cur")).alias("b")))
    hung = pairs.select("v", F.col("a.cur").alias("parent"))
    bridge = pairs.filter("not a.leaf and not b.leaf and a.cur != b.cur").select(F.least("a.cur", "b.cur").alias("u"), F.greatest("a.cur", "b.cur").alias("v")).distinct()
    # a leaf beyond a chain goes to the chain's other end; where both ends are leaves the smaller one stays
    beyond = pairs.filter("b.leaf").select(F.col("b.cur").alias("v"), F.col("a.cur").alias("parent")).distinct()
    other = leaf.select(F.col("v").alias("next"), F.lit(True).alias("pair"))
    plain = leaf.join(low.filter("d = 2").select(F.col("v").alias("next")), "next", "left_anti").join(other, "next", "left").filter("pair is null or v > next").select("v", F.col("next").alias("parent"))
    rings = cycling.filter("v != least").select("v", F.col("least").alias("parent")).distinct()
    removed = scratch.write(hung.unionByName(beyond).unionByName(plain).unionByName(rings))
    gone = low.select(F.col("v").alias("x"))
    kept = edges.join(gone, edges.u == gone.x, "left_anti").join(gone, edges.v == gone.x, "left_anti")
    left, m = scratch.write(kept.unionByName(bridge).distinct(), n=count_rows())
    scratch.drop(low, pairs)
    return left, removed, m["n"]


def consolidate_matches(pairs: DataFrame, src: str = "src", dst: str = "dst", least_gain: float = 0.5) -> DataFrame:
    """(id, group_id) for every record on a pair of two different records; group_id is the smallest id of the group.

    Ids become 64-bit numbers in their order once. Each round strips the degree-one vertices and replaces every chain of
    degree-two vertices, found by list ranking, by one edge between its ends; the removed vertices keep a pointer to what
    they hung on. Where under `least_gain` such vertices are left per remaining edge, the core is solved by alternating
    stars, and the removed vertices get their labels back round by round, last removed first. `least_gain` moves work
    between the two parts and changes no result. Direction, repetition and order of pairs do not matter; nulls and pairs
    of one record drop out. A hub's leaves and labels move by equi-joins and partial minima alone, never in one task.
    """
    scratch = Scratch(pairs.sparkSession, "matches")
    vertices, numbered = number_vertices(scratch, pairs.filter(F.col(src) != F.col(dst)), src, dst)
    edges, seen = scratch.write(numbered.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), n=count_rows())
    rounds, n = [], seen["n"]
    while n and (done := _reduce(scratch, edges, n, least_gain)):
        scratch.drop(edges)
        edges, removed, n = done
        rounds.append(removed)
    labels = star_components(scratch, edges).withColumnRenamed("n", "v")
    for removed in reversed(rounds):
        known = labels.select(F.col("v").alias("parent"), "root")
        labels = scratch.write(labels.unionByName(removed.join(known, "parent", "left").select("v", F.coalesce("root", "parent").alias("root"))))
    rooted = scratch.write(vertices.join(labels.withColumnRenamed("v", "n"), "n", "left").select("id", F.coalesce("root", "n").alias("root")))
    least = rooted.groupBy("root").agg(F.min("id").alias("group_id"))
    return rooted.join(least, "root").select("group_id", "id")


def strong_hit(fident: float = 0.30, qcov: float = 0.80, tcov: float = 0.80) -> Column:
    """A hit counts when identity and both coverages reach their thresholds; null and NaN fail."""
    ok = F.lit(True)
    for name, least in (("fident", fident), ("qcov", qcov), ("tcov", tcov)):
        ok = ok & F.coalesce((F.col(name) >= least) & ~F.isnan(name), F.lit(False))
    return ok
