"""One surviving record for each group of duplicates: skylines, a lexicographic policy, and filling by layers."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import canonical_id, letters
from ..session import Scratch, count_rows

#: The policy: smaller is better in each dimension after its sign.
CRITERIA = (("internal_missing_residues", 1), ("backbone_complete_fraction", -1), ("resolution", 1), ("quality_score", -1))
#: The latest delivery of an id, in microseconds: later is better.
RECENCY = ("last_delivered", -1)


def _undominated(*keys: str):
    """Rows that no other row of their group dominates; the partition is sorted by keys and d0, d1, ... .

    In that order a row can only be dominated by one before it, so a window of kept rows is enough.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, window = None, []
        for pdf in batches:
            dims = [pdf[c].tolist() for c in pdf.columns if c[:1] == "d" and c[1:].isdigit()]
            keep = []
            for g, *x in zip(zip(*(pdf[k].tolist() for k in keys)), *dims):
                if g != group:
                    group, window = g, []
                by = next((i for i, w in enumerate(window) if all(a <= b for a, b in zip(w, x))), None)
                keep.append(by is None)
                if by is None:
                    window.append(x)
                elif by:  # what dominates much moves ahead, so that most rows are compared with few
                    window[0], window[by] = window[by], window[0]
            yield pdf[keep]

    return run


def skyline(vectors: DataFrame, n_dims: int, block: int = 5000) -> DataFrame:
    """The rows (grp, d0..., other columns) undominated in their group; vectors of a group must differ, smaller is better.

    A first window drops what is dominated where the rows lie. What is left of a group is dealt by hash to parts of about
    `block` rows, as many as it needs, and each part keeps its own skyline. Every two parts of a group then meet in a
    task of their own, which tells what one has that dominates the other's. So no task holds more than two blocks, and no
    group's rows come together, however many of them stay undominated.
    """
    dims = [f"d{i}" for i in range(n_dims)]
    scratch = Scratch(vectors.sparkSession, "skyline")
    local = scratch.write(vectors.sortWithinPartitions("grp", *dims).mapInPandas(_undominated("grp"), vectors.schema))
    parts = local.groupBy("grp").agg(F.ceil(count_rows() / block).cast("int").alias("__parts"))
    dealt = local.join(parts, "grp").withColumn("__part", F.pmod(F.xxhash64(*dims), F.col("__parts")).cast("int"))
    dealt = dealt.repartition("grp", "__part").sortWithinPartitions("grp", "__part", *dims)
    own = scratch.write(dealt.mapInPandas(_undominated("grp", "__part"), dealt.schema))
    many = own.filter("__parts > 1").select("grp", *dims, "__part", "__parts")
    other = F.explode(F.array_except(F.sequence(F.lit(0), F.col("__parts") - 1), F.array("__part")))
    left = many.withColumn("__by", other).drop("__parts")
    right = many.withColumn("__of", other).withColumnRenamed("__part", "__by").withColumnRenamed("__of", "__part").drop("__parts")
    key = ["grp", "__part", "__by"]

    def beaten(rows: pd.DataFrame, by: pd.DataFrame) -> pd.DataFrame:
        x, y = rows[dims].to_numpy("float64"), by[dims].to_numpy("float64")
        return rows.loc[[bool((y <= r).all(axis=1).any()) for r in x] if len(y) else [False] * len(x), ["grp", *dims]]

    lost = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(beaten, many.select("grp", *dims).schema)
    return own.drop("__part", "__parts").join(lost, ["grp", *dims], "left_anti")


def latest_value(value: Column, usable: Column, loaded_at: Column) -> Column:
    """The value of the latest usable row: unknown times count as oldest, of equal times the largest value."""
    return F.max(F.when(usable, F.struct(loaded_at.alias("t"), value.alias("x"))))["x"]


def known_values(records: DataFrame, annotations: DataFrame) -> DataFrame:
    """(id, digest of aa, the four criteria, last_delivered): per id and field the latest usable value of all its rows, and the
    time of its latest row of records in microseconds.

    Not usable: null, NaN, resolution or quality not above 0, negative residue counts, fractions outside 0-1, and
    sequences without a letter. Ids fold their entry's case; rows without id drop out.
    """
    at, aa = F.col("loaded_at"), letters("aa")
    positive = lambda c: ~F.isnan(c) & (F.col(c) > 0)
    r = records.filter("id is not null").select(canonical_id("id").alias("id"), F.unhex(F.sha2(aa, 256)).alias("digest"), "resolution", "quality_score", "loaded_at")
    r = r.groupBy("id").agg(
        latest_value(F.col("digest"), F.col("digest").isNotNull(), at).alias("digest"),
        latest_value(F.col("resolution"), positive("resolution"), at).alias("resolution"),
        latest_value(F.col("quality_score"), positive("quality_score"), at).alias("quality_score"),
        F.max(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), at.cast("timestamp_ntz"))).alias("last_delivered"),
    )
    fraction = F.col("backbone_complete_fraction")
    a = annotations.filter("id is not null").select(canonical_id("id").alias("id"), "internal_missing_residues", "backbone_complete_fraction", "loaded_at")
    a = a.groupBy("id").agg(
        latest_value(F.col("internal_missing_residues"), F.col("internal_missing_residues") >= 0, at).alias("internal_missing_residues"),
        latest_value(fraction, ~F.isnan(fraction) & fraction.between(0, 1), at).alias("backbone_complete_fraction"),
    )
    return r.filter("digest is not null").join(a, "id", "left")


def best_representatives(members: DataFrame, group: str, id_: str, criteria: tuple[tuple[str, int], ...] = CRITERIA, fill: tuple[str, ...] = (), block: int = 5000) -> DataFrame:
    """(group_id, survivor_id, group_size, criteria..., fill...) for each group of two or more members; ids are unique.

    The members undominated over the criteria (null is worse than any value) are the first layer. The policy orders
    a layer by the criteria in turn, then by id: its first is the survivor. Where the survivor lacks a field, the
    first member of the layer that knows it gives the value; after the first layer the next is computed from the
    rest of those groups that still lack a field some member knows, and so on until nothing can be filled. A
    criterion any member knows is always found in the first layer, so only `fill` fields need later ones.
    group_id is the smallest id. Members of equal criteria are one vector, whose fields come from its smallest id
    that knows them. Null groups and ids drop out; no groups give no rows.
    """
    scratch = Scratch(members.sparkSession, "survivors")
    names, n = [c for c, _ in criteria], len(criteria)
    fields = [*names, *fill]
    dims = [f"d{i}" for i in range(n)]
    bound = F.lit(sys.float_info.max)
    as_dim = lambda c, sign: F.when(F.col(c).isNull() | F.isnan(F.col(c).cast("double")), F.lit(float("inf"))).otherwise(F.greatest(F.least(F.col(c).cast("double") * sign, bound), -bound)) + 0.0
    m = members.filter(F.col(group).isNotNull() & F.col(id_).isNotNull()).select(F.col(group).alias("grp"), F.col(id_).alias("id"), *(F.col(c) for c in fields), *(as_dim(c, s).alias(f"d{i}") for i, (c, s) in enumerate(criteria)))
    m = scratch.write(m)
    stats = m.groupBy("grp").agg(F.min("id").alias("group_id"), count_rows().alias("group_size"), *(F.max(F.col(c).isNotNull()).alias(f"any_{c}") for c in fill)).filter("group_size > 1")
    stats = scratch.write(stats)
    vectors = m.groupBy("grp", *dims).agg(F.min("id").alias("id"), *(F.min(c).alias(c) for c in names), *(F.min(F.when(F.col(c).isNotNull(), F.struct("id", c)))[c].alias(c) for c in fill))
    rest = vectors.join(stats.select("grp"), "grp", "left_semi")
    policy = lambda *more: F.struct(*(F.col(d) for d in dims), F.col("id"), *more)
    done = None
    while True:
        layer = scratch.write(skyline(rest, n, block))
        firsts = [F.min(policy())["id"].alias("survivor_id"), *(F.min(F.when(F.col(c).isNotNull(), policy(F.col(c).alias("value"))))["value"].alias(c) for c in fields)]
        best = layer.groupBy("grp").agg(*firsts)
        if done is None:
            done = scratch.write(best)
        else:
            later = best.select("grp", *(F.col(c).alias(f"new_{c}") for c in fields))
            done = scratch.write(done.join(later, "grp", "left").select("grp", "survivor_id", *(F.coalesce(c, f"new_{c}").alias(c) for c in fields)))
        if not fill:
            break
        lacking = reduce(lambda a, b: a | b, (F.col(c).isNull() & F.col(f"any_{c}") for c in fill))
        open_, seen = scratch.write(done.join(stats, "grp").filter(lacking).select("grp"), n=count_rows())
        if not seen["n"]:
            break
        rest = scratch.write(rest.join(open_, "grp", "left_semi").join(layer.select("grp", *dims), ["grp", *dims], "left_anti"))
    return stats.select("grp", "group_id", "group_size").join(done, "grp").select("group_id", "survivor_id", "group_size", *fields)
