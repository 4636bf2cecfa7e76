import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from weftline.llm import grouping, splitting


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def least_labels(pairs):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


def name(i):
    return f"n{i:03d}"


def shapes():
    rnd = random.Random(11)
    path = [(name(i), name(i + 1)) for i in rnd.sample(range(0, 60), 60)]
    ring = [(name(100 + i), name(100 + (i + 1) % 17)) for i in range(17)]
    star = [("hub", name(200 + i)) for i in range(80)]
    k4 = [(name(300 + i), name(300 + j)) for i in range(4) for j in range(i)]
    tail = [(name(300), name(310)), (name(310), name(311)), (name(311), name(312)), (name(301), name(320)), (name(320), name(302))]
    pair = [("x", "y")]
    tree = [(name(400 + i), name(400 + (i - 1) // 2)) for i in range(1, 40)]
    noose = [(name(500), name(501)), (name(501), name(502)), (name(502), name(500)), (name(500), name(503)), (name(500), name(504))]
    sparse = [(name(600 + rnd.randrange(90)), name(600 + rnd.randrange(90))) for _ in range(80)]
    return path + ring + star + k4 + tail + pair + tree + noose + sparse


@pytest.mark.parametrize("gain", [0.1, 0.0, 2.0])
def test_consolidated_groups_are_the_components(spark, gain):
    pairs = shapes()
    data = pairs + [p[::-1] for p in pairs[::3]] + pairs[:5] + [("s", "s"), (None, "a"), ("a", None)]
    df = spark.createDataFrame(data, "src string, dst string").withColumn("u", F.lit("clash")).withColumn("v", F.lit("clash"))
    got = {r["id"]: r["group_id"] for r in grouping.consolidate_matches(df, least_gain=gain).collect()}
    assert got == least_labels([p for p in pairs if p[0] != p[1]])


def test_no_pairs(spark):
    empty = spark.createDataFrame([], "src string, dst string")
    assert rows(grouping.consolidate_matches(empty)) == [] and rows(splitting.frontier_components(empty)) == []


def test_strong_hit(spark):
    h = spark.createDataFrame([(0.3, 0.8, 0.8, True), (0.29, 1.0, 1.0, False), (float("nan"), 1.0, 1.0, False), (None, 1.0, 1.0, False), (1.0, 1.0, None, False), (1.0, float("nan"), 1.0, False)], "fident double, qcov double, tcov double, want boolean")
    assert h.filter(grouping.strong_hit() != F.col("want")).count() == 0


def test_frontier_components(spark):
    pairs = shapes() + [("alone", "alone")]
    df = spark.createDataFrame(pairs + [(None, "a")], "src string, dst string").withColumn("label", F.lit(1))
    groups, want = defaultdict(set), defaultdict(set)
    for i, c in rows(splitting.frontier_components(df)):
        groups[c].add(i)
    for i, c in least_labels(pairs).items():
        want[c].add(i)
    want["alone"] = {"alone"}
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


MEMBER = "id string, merged_group string, split string, selected_representative int"


def membership(spark, n=300, hot=100):
    rnd = random.Random(12)
    data = []
    for i in range(n):
        e = "HOT1" if i < hot else f"E{rnd.randrange(60):03d}"
        g = "hotg_A" if 80 < i < 80 + hot else rnd.choice([f"g{rnd.randrange(90):03d}_A", None, ""])
        data.append((f"{e.lower() if i % 3 else e}_{i}", g, rnd.choice([" Train", "test", "VALID", "heldout_excluded", None]), 0))
    return data + data[:20] + [(None, "g001_A", "test", 1)]


def test_conflicts_against_brute_force(spark):
    data = membership(spark)
    seen = defaultdict(set)
    short = {"train": "train", "valid": "valid", "test": "test"}
    for i, g, s, _ in data:
        label = short.get((s or "").strip().lower())
        if i and label:
            seen["pdb_id", i[:4].upper()].add(label)
            if g:
                seen["merged_group", g[:4].upper() + g[4:]].add(label)
    got = rows(splitting.split_conflicts(spark.createDataFrame(data, MEMBER)))
    assert got == sorted((k for k, v in seen.items() if len(v) > 1), key=repr) and got
    assert rows(splitting.split_conflicts(spark.createDataFrame([], MEMBER))) == []


def test_split_keeps_related_records_together(spark):
    data = membership(spark, 600, 60)
    m = spark.createDataFrame(data, MEMBER)
    ids = [(d[0],) for d in data] + [("ZZZZ_new",), (None,)]
    r = spark.createDataFrame(ids, "id string").withColumn("component", F.lit("clash"))
    got = {i: s for i, _, s in rows(splitting.grouped_split(r, m))}
    norm = lambda x: x[:4].upper() + x[4:]
    assert set(got) == {norm(i) for (i,) in ids if i}
    keys = defaultdict(set)
    for i, g, _, _ in data:
        if i:
            keys["e", norm(i)[:4]].add(got[norm(i)])
            if g:
                keys["g", norm(g)].add(got[norm(i)])
    assert all(len(v) == 1 for v in keys.values())
    again = {i: s for i, _, s in rows(splitting.grouped_split(r.orderBy(F.desc("id")), m.orderBy("split")))}
    assert again == got
    assert rows(splitting.grouped_split(r.limit(0), m)) == []


def test_split_shares(spark):
    r = spark.createDataFrame([(f"{i:04d}_A",) for i in range(2000)], "id string")
    n = Counter(s for _, _, s in rows(splitting.grouped_split(r, spark.createDataFrame([], MEMBER))))
    assert abs(n["train"] - 1600) <= 2 and abs(n["valid"] - 200) <= 2 and abs(n["test"] - 200) <= 2
