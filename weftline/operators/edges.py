"""Edges between records that share a key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EDGE = ("src", "dst")


def bucket_edges(df: DataFrame, key: str, id_: str = "id") -> DataFrame:
    """A star per key: every id to the smallest id of the key, never all pairs. The minimum is a partial aggregate that
    is joined back, so a key with a third of the rows stays spread. Null keys and ids give no edge."""
    rows = df.select(F.col(key).alias("k"), F.col(id_).alias("src")).filter("k is not null and src is not null").distinct()
    least = rows.groupBy("k").agg(F.min("src").alias("dst"))
    return rows.join(least, "k").filter("src != dst").select(*EDGE)


def value_edges(df: DataFrame, values: str, id_: str = "id") -> DataFrame:
    """bucket_edges over every element of an array column."""
    return bucket_edges(df.select(id_, F.explode(values).alias("__value")), "__value", id_)


def cluster_edges(clusters: DataFrame, vertices: DataFrame, rep: str = "rep", member: str = "member") -> DataFrame:
    """Edges of (representative, member) rows whose two ends are both vertices (id)."""
    v = vertices.select("id").distinct()
    e = clusters.select(F.col(rep).alias("src"), F.col(member).alias("dst")).filter("src is not null and dst is not null")
    return e.join(v.withColumnRenamed("id", "src"), "src", "left_semi").join(v.withColumnRenamed("id", "dst"), "dst", "left_semi").select(*EDGE).distinct()


def translate_keys(edges: DataFrame, keys: DataFrame, key: str = "key", id_: str = "id") -> DataFrame:
    """Edges with each end replaced by its id where the key table has one, else kept."""
    k = keys.select(F.col(key).alias("k"), F.col(id_).alias("mapped")).filter("k is not null").groupBy("k").agg(F.min("mapped").alias("mapped"))
    out = edges
    for end in EDGE:
        out = out.join(k.withColumnRenamed("k", end), end, "left").withColumn(end, F.coalesce("mapped", end)).drop("mapped")
    return out.select(*EDGE)


def union_edges(*families: DataFrame) -> DataFrame:
    """All edge families together; with the label edges of another partition this overlays two groupings."""
    out = families[0].select(*EDGE)
    for f in families[1:]:
        out = out.unionByName(f.select(*EDGE))
    return out


def label_vertices(vertices: DataFrame, components: DataFrame) -> DataFrame:
    """(id, component) of every vertex; one without an edge is its own component."""
    return vertices.select("id").filter("id is not null").distinct().join(components, "id", "left").select("id", F.coalesce("component", "id").alias("component"))
