"""Filling fixed-capacity containers: conflict-constrained best fit over residual-ordered bins."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch, count_rows

CAPACITY = 8192


class Bins:
    """Open bins by residual capacity. Each carries a bitmap of its sources and one of its duplicate clusters.

    `occupied` has bit r set where a bin with residual r is open, so the successor of a size is the lowest set bit
    from it on. A bin is compatible when none of its sources is barred by the item's and the item's cluster is not in it.
    """

    def __init__(self, capacity: int, barred: dict[int, int]):
        self.capacity, self.barred = capacity, barred
        self.at: dict[int, list[int]] = defaultdict(list)
        self.occupied = 0
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.held: list[set] = []
        self.last: tuple = ()

    def _compatible(self, b: int, source: int, cluster) -> bool:
        if self.sources[b] & self.barred.get(source, 0):
            return False
        return cluster is None or not (self.clusters[b] >> (hash(cluster) & 63) & 1) or cluster not in self.held[b]

    def place(self, size: int, source: int, cluster) -> int:
        # equal items in a row start where the last one stopped: what was incompatible with it still is
        r, i = self.last[1:] if self.last and self.last[0] == (size, source, cluster) else (size, 0)
        found = None
        while r <= self.capacity:
            rest = self.occupied >> r
            if not rest:
                break
            step = (rest & -rest).bit_length() - 1
            if step:
                r, i = r + step, 0
            bins = self.at[r]
            while i < len(bins):
                if self._compatible(bins[i], source, cluster):
                    found = bins.pop(i)
                    break
                i += 1
            if found is not None:
                if not bins:
                    self.occupied &= ~(1 << r)
                break
            r, i = r + 1, 0
        if found is None:
            found, left = len(self.sources), self.capacity
            self.sources.append(0)
            self.clusters.append(0)
            self.held.append(set())
            r, i = self.capacity + 1, 0
        else:
            left = r
        self.sources[found] |= 1 << source
        if cluster is not None:
            self.clusters[found] |= 1 << (hash(cluster) & 63)
            self.held[found].add(cluster)
        left -= size
        self.at[left].append(found)
        self.occupied |= 1 << left
        # a clustered item bars its own bin to the next equal one; another may fit the same bin once more
        self.last = ((size, source, cluster), r, i) if cluster is not None or left < size else ()
        return found


def _pack(capacity: int, barred: dict[int, int]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, bins = None, None
        for pdf in batches:
            out = []
            for s, size, source, cluster in zip(pdf["shard"].tolist(), pdf["n_tokens"].tolist(), pdf["source_bit"].tolist(), pdf["cluster"].tolist()):
                if s != shard:
                    shard, bins = s, Bins(capacity, barred)
                out.append(bins.place(size, source, cluster))
            yield pdf.assign(bin=pd.Series(out, dtype="int64", index=pdf.index))

    return run


def pack(items: DataFrame, key: str = "doc_id", capacity: int = CAPACITY, cluster: str | None = "paper_id", exclusive: tuple[tuple[str, str], ...] = (), shard_items: int = 20_000, well_filled: float = 0.97) -> DataFrame:
    """(key, piece, n_pieces, n_tokens, container): every item in containers of `capacity`, as tight as best fit makes them.

    Items carry n_tokens and source. One that exceeds the capacity is cut into full pieces and a rest, and no other
    is cut. Two items of one cluster never share a container, nor do two of a pair of sources in `exclusive` (compared as
    given). Cut pieces of one item are not in conflict.

    Items go by hash into shards of about `shard_items`, each packed on its own, a task taking one or more shards in turn: largest first into the compatible
    bin with the smallest residual that takes it. Containers that are less than `well_filled` full are opened once
    more and their items packed again in fewer shards, so what the cuts between shards waste stays small. Memory of a
    task is bounded by its shard; a cluster with a third of all items is spread over all shards.

    Null and empty texts have 0 tokens and take room nowhere, but stand in a container. Null clusters are in no
    conflict, null sources are source "". Repeated keys are items of their own. No items give no rows.
    """
    scratch = Scratch(items.sparkSession, "packing")
    spark = items.sparkSession
    most_parts = 4 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    names = sorted({n for pair in exclusive for n in pair})
    bits = {n: i + 1 for i, n in enumerate(names)}
    barred: dict[int, int] = defaultdict(int)
    for a, b in exclusive:
        barred[bits[a]] |= 1 << bits[b]
        barred[bits[b]] |= 1 << bits[a]
    source_bit = F.lit(0)
    for n, i in bits.items():
        source_bit = F.when(F.col("source") == n, i).otherwise(source_bit)
    n = F.coalesce(F.col("n_tokens"), F.lit(0)).cast("long")
    pieces = F.greatest(F.ceil(n / capacity), F.lit(1)).cast("int")
    base = items.select(F.col(key).alias(key), n.alias("all_tokens"), source_bit.alias("source_bit"), (F.col(cluster).cast("string") if cluster else F.lit(None).cast("string")).alias("cluster"), pieces.alias("n_pieces"))
    cut = base.select("*", F.posexplode(F.sequence(F.lit(1), "n_pieces")).alias("i", "piece")).select(
        key, "piece", "n_pieces", F.least(F.col("all_tokens") - (F.col("piece") - 1) * F.lit(capacity), F.lit(capacity).cast("long")).alias("n_tokens"), "source_bit", F.when(F.col("n_pieces") == 1, F.col("cluster")).alias("cluster"))
    work, seen = scratch.write(cut.withColumn("row", F.monotonically_increasing_id()), n=count_rows())

    def packed(rows: DataFrame, shards: int, round_: int) -> DataFrame:
        parts = min(shards, max(most_parts, 1))
        spread = rows.withColumn("shard", F.pmod(F.xxhash64(key, "piece", "row", F.lit(round_)), F.lit(shards)).cast("int")).repartitionById(parts, F.pmod("shard", F.lit(parts)))
        ordered = spread.sortWithinPartitions("shard", F.desc("n_tokens"), "cluster", "source_bit", key, "piece")
        return ordered.mapInPandas(_pack(capacity, dict(barred)), f"{ordered.schema.simpleString()[7:-1]}, bin long".replace(":", " ")).withColumn("container", F.concat_ws("-", F.lit(round_), "shard", "bin"))

    first = scratch.write(packed(work, max(1, -(-seen["n"] // shard_items)), 1))
    loose = first.groupBy("container").agg(F.sum("n_tokens").alias("filled")).filter(F.col("filled") < well_filled * capacity).select("container")
    again, seen = scratch.write(first.join(loose, "container", "left_semi").drop("shard", "bin", "container"), n=count_rows())
    second = packed(again, max(1, -(-seen["n"] // shard_items)), 2)
    done = first.join(loose, "container", "left_anti").unionByName(second)
    return done.select(key, "piece", "n_pieces", "n_tokens", "container")


def cut_items(packed: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key) of the items whose pieces stand in more than one container. Rows that repeat a key are not its pieces."""
    per = packed.groupBy(key).agg(F.count_distinct("piece").alias("pieces"), F.count_distinct("container").alias("containers"))
    return per.filter("pieces > 1 and containers > 1").select(key)
