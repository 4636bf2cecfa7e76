"""Similarity joins over sequences and vectors, and clustering by their pairs."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ..session import Scratch, count_rows, java_function


def _grams(df: DataFrame, k: int) -> DataFrame:
    """(key, id, seq, len, n, terms): the n different letter grams of each sequence of at least k letters; key numbers the rows."""
    rows = df.filter((F.length("seq") >= k) & F.col("id").isNotNull()).select("id", "seq").distinct()
    at = F.sequence(F.lit(1), F.length("seq") - k + 1)
    terms = F.array_distinct(F.transform(at, lambda i: F.xxhash64(F.substr(F.col("seq"), i, F.lit(k)))))
    return rows.withColumn("terms", terms).select(F.monotonically_increasing_id().alias("key"), "id", "seq", F.length("seq").alias("len"), F.size("terms").alias("n"), "terms")


def _aligned(queries: DataFrame, targets: DataFrame, fident: float, cov: float, block: tuple[int, int] | None, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The different texts (seq, band, key) of either side, and (qk, tk, fident) of the pairs of their keys that `aligned_texts` finds."""
    width = -math.log(cov * 0.999)  # a little wide: rounding loses no pair at the very limit
    side = lambda d: d.filter(F.length("seq") > 0).select("seq").distinct().select("seq", F.floor(F.log(F.length("seq").cast("double")) / width).cast("int").alias("band"), F.monotonically_increasing_id().alias("key"))
    texts, others = scratch.write(side(queries)), scratch.write(side(targets))
    q, t = texts.withColumn("band", F.explode(F.array(*(F.col("band") + i for i in (-1, 0, 1))))), others
    per = lambda d, name: d.groupBy("band").agg(count_rows().alias(name))
    counts, seen = scratch.write(per(q, "nq").join(per(t, "nt"), "band"), pairs=F.coalesce(F.sum(F.col("nq") * F.col("nt")), F.lit(0)))
    size = min(max(math.isqrt(seen["pairs"] // 200), 256), 8192)
    of_q, of_t = block or (size, size)
    parts = lambda n, size: F.ceil(F.col(n) / size).cast("int").alias(n)
    grid, seen = scratch.write(counts.select("band", parts("nq", of_q), parts("nt", of_t)), cells=F.coalesce(F.sum(F.col("nq") * F.col("nt")), F.lit(0)))
    grid, tasks = F.broadcast(grid), max(1, min(seen["cells"], 2000))
    key = ["band", "qp", "tp"]

    def dealt(d: DataFrame, own: str, other: str, a: str, b: str, into: int, name: str) -> DataFrame:
        # each text's own part, and a copy for each part of the other side; a fixed number of partitions: adaptive execution would put
        # these small blocks, each long work, into one task
        part = F.pmod(F.xxhash64("seq"), F.col(own)).cast("int").alias(a)
        rows = d.join(grid, "band").select("key", "seq", "band", part, F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(b))
        return rows.repartition(tasks, *key).groupBy(*key, F.pmod(F.hash("key"), F.lit(into)).alias("piece")).agg(F.collect_list(F.struct("key", "seq")).alias(name)).drop("piece")

    # a block of queries comes in pieces of about 128, which bounds the pairs that one call can return
    left, right = dealt(q, "nq", "nt", "qp", "tp", -(-of_q // 128), "qs"), dealt(t, "nt", "nq", "tp", "qp", 1, "ts")
    java_function(queries.sparkSession, "operators/Matches.java", "weftline.Matches", "weftline_matches", "array<struct<qk: bigint, tk: bigint, fident: double>>", ("operators/Lanes.java", "weftline.Lanes"))
    found = F.call_function("weftline_matches", "qs", "ts", F.lit(float(fident)), F.lit(float(cov)))
    return texts, others, left.join(right.hint("merge"), key).select(F.explode(found).alias("m")).select("m.*")


def aligned_texts(queries: DataFrame, targets: DataFrame, fident: float, cov: float, block: tuple[int, int] | None = None) -> DataFrame:
    """(qs, ts, fident) of all pairs of texts (seq) that reach both thresholds, equal texts too; each pair is aligned.

    Nothing but the length leaves a pair out: texts whose lengths fit the coverage lie in the same band or the next,
    bands being powers of 1 / cov. A band's queries and targets are dealt by hash to blocks of about `block` texts, and one task
    aligns a block of queries with a block of targets, on the JVM (`Matches.java`). Without `block` blocks grow with the product of
    the two sides, up to 8,192 texts, so that the copies each block takes stay few.
    """
    scratch = Scratch(queries.sparkSession, "align")
    q, t, hits = _aligned(queries, targets, fident, cov, block, scratch)
    text = lambda d, key, name: d.select(F.col("key").alias(key), F.col("seq").alias(name))
    return hits.join(text(q, "qk", "qs"), "qk").join(text(t, "tk", "ts"), "tk").select("qs", "ts", "fident")


def similar_sequences(queries: DataFrame, targets: DataFrame, k: int = 6, shared: float = 0.0, fident: float = 0.30, cov: float = 0.80) -> DataFrame:
    """(query_id, target_id, fident, qcov, tcov) of pairs of (id, seq) rows that are alike; a pair of one id drops out.

    A pair is alike if an edit alignment reaches the thresholds: fident = 1 - edits / longer length, and each
    coverage = shorter length / own length. Every pair whose lengths fit is aligned (`aligned_texts`), so that none is lost
    at any identity or length; the cost is the product of the two sides. Copies (one id, one text) count once.

    With shared > 0 a pair must besides share at least ceil(shared * n) of the k-letter grams, n being the larger one's number of
    different grams: much cheaper, and blind to most pairs under an identity of about shared ** (1 / k). Candidates then come
    from an inverted index that holds only the n - ceil(shared * n) + 1
    rarest grams of each sequence: two sequences that share enough meet in one of these, so none is lost, and
    grams most sequences have are left out of the lists. Grams are compared by a 64-bit hash; the alignment decides. Sequences under k letters then have no pair.
    """
    if not shared:
        scratch = Scratch(queries.sparkSession, "similar")
        q, t, hits = _aligned(queries.filter("id is not null"), targets.filter("id is not null"), fident, cov, None, scratch)
        hits = scratch.write(hits)
        rows = lambda d, texts, x: d.filter(F.col("id").isNotNull()).select("id", "seq").distinct().join(texts, "seq").select(F.col("key").alias(f"{x}k"), F.col("id").alias(f"{x}i"), F.length("seq").alias(f"{x}l"))
        shorter = F.least("ql", "tl")
        j = hits.join(rows(queries, q, "q"), "qk").join(rows(targets, t, "t"), "tk").filter("qi != ti")
        j = j.select(F.col("qi").alias("query_id"), F.col("ti").alias("target_id"), "fident", (shorter / F.col("ql")).alias("qcov"), (shorter / F.col("tl")).alias("tcov"))
        return j.groupBy("query_id", "target_id").agg(F.max("fident").alias("fident"), F.max("qcov").alias("qcov"), F.max("tcov").alias("tcov"))
    scratch = Scratch(queries.sparkSession, "similar")
    q, t = scratch.write(_grams(queries, k)), scratch.write(_grams(targets, k))
    terms = lambda d: d.select("key", "len", "n", F.explode("terms").alias("term"))
    df = terms(q).select("term").unionByName(terms(t).select("term")).groupBy("term").agg(count_rows().alias("df"))
    least = F.ceil(F.lit(shared) * F.col("n"))

    def rare(d: DataFrame) -> DataFrame:
        w = Window.partitionBy("key").orderBy("df", "term")
        return terms(d).join(df, "term").withColumn("r", F.row_number().over(w)).filter(F.col("r") <= F.col("n") - least + 1)

    a = rare(q).select("term", F.col("key").alias("qk"), F.col("len").alias("ql"))
    b = rare(t).select("term", F.col("key").alias("tk"), F.col("len").alias("tl"))
    lens = (F.col("ql") >= F.lit(cov) * F.col("tl")) & (F.col("tl") >= F.lit(cov) * F.col("ql"))
    cand = a.join(b, "term").filter(lens).select("qk", "tk").distinct()
    side = lambda d, x: d.select(F.col("key").alias(f"{x}k"), F.col("id").alias(f"{x}i"), F.col("seq").alias(f"{x}s"), F.col("terms").alias(f"{x}t"))
    j = cand.join(side(q, "q"), "qk").join(side(t, "t"), "tk").filter("qi != ti")
    j = j.filter(F.size(F.array_intersect("qt", "tt")) >= F.ceil(F.lit(shared) * F.greatest(F.size("qt"), F.size("tt"))))
    longer, shorter = F.greatest(F.length("qs"), F.length("ts")), F.least(F.length("qs"), F.length("ts"))
    scored = j.select(F.col("qi").alias("query_id"), F.col("ti").alias("target_id"), (1.0 - F.levenshtein("qs", "ts") / longer).alias("fident"), (shorter / F.length("qs")).alias("qcov"), (shorter / F.length("ts")).alias("tcov"))
    return scored.filter((F.col("fident") >= fident) & (F.col("qcov") >= cov) & (F.col("tcov") >= cov)).groupBy("query_id", "target_id").agg(F.max("fident").alias("fident"), F.max("qcov").alias("qcov"), F.max("tcov").alias("tcov"))


def top_hits(hits: DataFrame, k: int = 10, by: tuple[str, ...] = ("query_id",)) -> DataFrame:
    """The k best targets of each query by identity, then id. Spark limits groups before the shuffle, so no query's hits gather in one task."""
    w = Window.partitionBy(*by).orderBy(F.desc("fident"), "target_id")
    return hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def nearest_vectors(queries: DataFrame, rows: DataFrame, k: int = 10, block: tuple[int, int] = (1024, 8192), id_: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, target_id, cosine, rank): the k rows of largest cosine for each query, exact, itself left out.

    Queries and rows are dealt by hash to blocks of about `block` vectors; one task scores a block of queries against a
    block of rows by a matrix product and keeps k per query. Nothing passes through the driver; the cost is the
    product of the two sides, so it is for a stated set of queries. Ties go to the smaller id. Null and zero vectors
    have no neighbours.
    """
    import numpy as np
    import pandas as pd

    scratch = Scratch(queries.sparkSession, "vectors")
    known = lambda d: d.filter(F.col(id_).isNotNull() & F.col(vector).isNotNull()).select(F.col(id_).cast("long").alias("i"), F.col(vector).cast("array<double>").alias("x"))
    (q, nq), (t, nt) = (scratch.write(known(d), n=count_rows()) for d in (queries, rows))
    nq, nt = (max(1, -(-seen["n"] // size)) for seen, size in ((nq, block[0]), (nt, block[1])))
    part = lambda n: F.pmod(F.xxhash64("i"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left, right = q.select("i", "x", part(nq).alias("qp"), every(nt).alias("tp")), t.select("i", "x", part(nt).alias("tp"), every(nq).alias("qp"))
    schema = StructType([StructField("query_id", LongType()), StructField("target_id", LongType()), StructField("cosine", DoubleType())])

    def unit(pdf: pd.DataFrame) -> tuple:
        x = np.stack(pdf["x"].to_numpy())
        size = np.linalg.norm(x, axis=1)
        return pdf["i"].to_numpy()[size > 0], x[size > 0] / size[size > 0, None]

    def score(of: pd.DataFrame, to: pd.DataFrame) -> pd.DataFrame:
        if of.empty or to.empty:
            return pd.DataFrame({"query_id": [], "target_id": [], "cosine": []})
        (ids, m), (others, x) = unit(of), unit(to)
        s = x @ m.T
        s[others[:, None] == ids[None, :]] = -np.inf
        take = min(k, len(others))
        # the id settles equal values, which may differ in their last digits
        order = np.lexsort((np.broadcast_to(others[:, None], s.shape), -np.round(s, 9)), axis=0)[:take]
        return pd.DataFrame({"query_id": np.tile(ids, take), "target_id": others[order].ravel(), "cosine": np.take_along_axis(s, order, axis=0).ravel()}).query("cosine > -2")

    tasks = max(1, min(nq * nt, 2000))
    left, right = left.repartition(tasks, "qp", "tp"), right.repartition(tasks, "qp", "tp")
    out = left.groupBy("qp", "tp").cogroup(right.groupBy("qp", "tp")).applyInPandas(score, schema)
    w = Window.partitionBy("query_id").orderBy(F.desc(F.round("cosine", 9)), "target_id")
    return out.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def set_cover_clusters(pairs: DataFrame, vertices: DataFrame) -> DataFrame:
    """(rep, member): greedy set cover over similarity pairs (src, dst), as taking the vertex with most open neighbours
    first, and on ties that of the smaller md5, would give; a vertex no one covers is its own cluster.

    A vertex that comes first among all within two steps is what the sequential rule would take before any of these, so
    each round takes all such vertices at once. Ties are broken by a hash, so a long path of equal degrees, whatever its
    ids, is taken in many places a round. The members of all rounds are read by one scan.
    """
    spark = pairs.sparkSession
    scratch = Scratch(spark, "cover")
    e = pairs.select(F.col("src").alias("a"), F.col("dst").alias("b")).filter("a != b")
    e = scratch.write(e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    rounds = []
    while True:
        deg = e.groupBy(F.col("a").alias("v")).agg(count_rows().alias("d"))
        # the smallest key of the closed neighbourhood, taken twice, looks two steps far
        own = deg.select("v", F.struct((-F.col("d")).alias("d"), F.md5("v").alias("tie"), F.col("v").alias("id")).alias("k"))
        near = e.join(own.select(F.col("v").alias("b"), "k"), "b").groupBy(F.col("a").alias("v")).agg(F.min("k").alias("m")).join(own, "v").select("v", "k", F.least("k", "m").alias("m"))
        far = e.join(near.select(F.col("v").alias("b"), F.col("m").alias("m1")), "b").groupBy(F.col("a").alias("v")).agg(F.min("m1").alias("m2")).join(near, "v")
        reps = scratch.write(far.filter((F.col("k") == F.col("m")) & (F.col("k") == F.least("m", "m2"))).select(F.col("v").alias("rep")))
        taken, n = scratch.write(e.join(reps.withColumnRenamed("rep", "a"), "a").select(F.col("a").alias("rep"), F.col("b").alias("member")).unionByName(reps.select("rep", F.col("rep").alias("member"))), n=count_rows())
        scratch.drop(reps)
        if not n["n"]:
            break
        rounds.append(taken._scratch_path)
        gone = taken.select("member").distinct()
        old = e
        left, m = scratch.write(e.join(gone.withColumnRenamed("member", "a"), "a", "left_anti").join(gone.withColumnRenamed("member", "b"), "b", "left_anti"), n=count_rows())
        scratch.drop(old)
        e = left
        if not m["n"]:
            break
    v = vertices.select(F.col("id").alias("member")).filter("member is not null").distinct()
    if not rounds:
        return v.select(F.col("member").alias("rep"), "member")
    done = spark.read.schema("rep string, member string").parquet(*rounds)
    return v.join(done, "member", "left").select(F.coalesce("rep", "member").alias("rep"), "member")
