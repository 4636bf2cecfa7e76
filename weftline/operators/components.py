"""Connected components by alternating stars (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Scratch, count_rows


def _sum_of_edges() -> Column:
    return F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))


def number_vertices(scratch: Scratch, edges: DataFrame, src: str = "src", dst: str = "dst") -> tuple[DataFrame, DataFrame]:
    """(vertices (id, n), edges (u, v)): every id on an edge as a 64-bit number that keeps the order of ids, and the edges in
    these numbers as given. Numbers come from sorted range partitions; they have gaps. Edges with a null end drop out."""
    a, b = F.col(src), F.col(dst)
    e = scratch.write(edges.filter(a.isNotNull() & b.isNotNull()).select(a.alias("a"), b.alias("b")).distinct())
    ids = e.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    v = scratch.write(ids.repartitionByRange("id").sortWithinPartitions("id").withColumn("n", F.monotonically_increasing_id()))
    numbered = e.join(v.select(F.col("id").alias("a"), F.col("n").alias("u")), "a").join(v.select(F.col("id").alias("b"), F.col("n").alias("v")), "b").select("u", "v")
    return v, numbered


def star_components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(n, root) of every vertex of an edge table (u, v) of two different numbers but the roots themselves; a root is the smallest number of its component.

    Per vertex only a minimum is kept (partial aggregation), and it goes back to the edges by an equi-join that
    adaptive execution may split, so a hub with a third of all edges loads no single task. Every round is written.
    """
    e, was = scratch.write(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct(), n=count_rows(), h=_sum_of_edges())
    while was["n"]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # an edge moves here but never doubles, so repeated ones may stay until the next step
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("x")).select("x.*").filter("u != v").distinct()
        new, now = scratch.write(small, n=count_rows(), h=_sum_of_edges())
        scratch.drop(e)
        e = new
        if now == was:
            break
        was = now
    return e.select(F.col("u").alias("n"), F.col("v").alias("root"))


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(id, component) for every vertex on an edge; the component is its smallest id in string order.

    Ids become 64-bit numbers in their order once, so that rounds shuffle numbers only (see star_components). Nulls and
    self edges drop out; no edges give no rows.
    """
    scratch = Scratch(edges.sparkSession, "components")
    vertices, numbered = number_vertices(scratch, edges.filter(F.col(src) != F.col(dst)), src, dst)
    roots = star_components(scratch, numbered)
    placed = vertices.join(roots, "n", "left").select("id", F.coalesce("root", "n").alias("root"))
    return placed.join(vertices.select(F.col("n").alias("root"), F.col("id").alias("component")), "root").select("id", "component")
