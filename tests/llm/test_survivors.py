import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from weftline.llm import survivors

INF = float("inf")


def vector(m):
    return tuple(INF if m[c] is None else s * m[c] for c, s in survivors.CRITERIA)


def brute(members, fill):
    groups = defaultdict(list)
    for m in members:
        groups[m["g"]].append(m)
    out = {}
    for g, ms in groups.items():
        if g is None or len(ms) < 2:
            continue
        rest, layers = list(ms), []
        while rest:
            top = [m for m in rest if not any(all(a <= b for a, b in zip(vector(o), vector(m))) and vector(o) != vector(m) for o in rest)]
            layers.append(sorted(top, key=lambda m: (*vector(m), m["id"])))
            rest = [m for m in rest if m not in top]
        row = {"survivor_id": layers[0][0]["id"], "group_size": len(ms)}
        for c in [c for c, _ in survivors.CRITERIA] + list(fill):
            row[c] = next((m[c] for layer in layers for m in layer if m[c] is not None), None)
        out[min(m["id"] for m in ms)] = row
    return out


def test_survivors_and_layers_against_brute_force(spark):
    rnd = random.Random(21)
    members = []
    for i in range(260):
        g = "hot" if i < 100 else rnd.choice([None, *(f"g{k}" for k in range(40))])
        members.append({"id": f"r{i:03d}", "g": g, "internal_missing_residues": rnd.choice([None, 0, 1, 2, 3]), "backbone_complete_fraction": rnd.choice([None, 0.5, 0.9, 1.0]), "resolution": rnd.choice([None, 1.0, 2.0, 3.0]),
                        "quality_score": rnd.choice([None, 0.2, 0.5]), "method": rnd.choice([None, None, None, "a", "b"]), "rare": "x" if rnd.random() < 0.05 else None})
    schema = "id string, g string, internal_missing_residues int, backbone_complete_fraction double, resolution double, quality_score double, method string, rare string, d0 int"
    df = spark.createDataFrame([tuple({**m, "d0": 5}.values()) for m in members], schema)
    want = brute(members, ("method", "rare"))
    got = {r["group_id"]: r.asDict() for r in survivors.best_representatives(df, "g", "id", fill=("method", "rare"), block=7).collect()}
    assert got.keys() == want.keys() and len(want) > 20
    for k, w in want.items():
        for c, v in w.items():
            assert got[k][c] == v, (k, c)
    assert survivors.best_representatives(df.limit(0), "g", "id", fill=("method",)).count() == 0


def test_recency_as_a_dimension(spark):
    """The better but older record survives; the newest one knows the field only where recency keeps it in the first layer."""
    rows = [("a", "g", 0, 1.0, 1.0, 0.9, 100, None), ("b", "g", 5, 0.5, 3.0, 0.1, 300, "new"), ("c", "g", 1, 0.9, 2.0, 0.5, 50, "old"), ("d", "h", 0, 1.0, 1.0, 0.9, None, None), ("e", "h", 0, 1.0, 1.0, 0.9, 7, None)]
    df = spark.createDataFrame(rows, "id string, g string, internal_missing_residues int, backbone_complete_fraction double, resolution double, quality_score double, last_delivered long, method string")
    run = lambda criteria: {r["group_id"]: (r["survivor_id"], r["method"]) for r in survivors.best_representatives(df, "g", "id", criteria, fill=("method",)).collect()}
    assert run((*survivors.CRITERIA, survivors.RECENCY)) == {"a": ("a", "new"), "d": ("e", None)}
    assert run(survivors.CRITERIA) == {"a": ("a", "old"), "d": ("d", None)}


@pytest.mark.parametrize("block, spread", [(5000, 12), (6, 12), (9, 0)])
def test_skyline_of_a_hot_group_over_many_partitions(spark, block, spread):
    rnd = random.Random(22)
    vs = {(rnd.randrange(12), rnd.randrange(12), rnd.randrange(12)) for _ in range(900)} if spread else {(i, 120 - i, i % 3) for i in range(120)}
    df = spark.createDataFrame([("hot", *map(float, v)) for v in vs], "grp string, d0 double, d1 double, d2 double").repartition(7)
    want = {v for v in vs if not any(o != v and all(a <= b for a, b in zip(o, v)) for o in vs)}
    assert {tuple(map(int, r[1:])) for r in survivors.skyline(df.withColumn("grp", F.encode("grp", "utf-8")), 3, block).collect()} == want and len(want) > (0 if spread else 100)


def test_latest_usable_values(spark):
    t = datetime(2025, 1, 1)
    r = [("1abc_A", "ac d", 2.0, 0.5, t), ("1ABC_A", "ACD", float("nan"), -1.0, t + timedelta(1)), ("1ABC_A", None, 1.0, None, None), ("1ABC_B", "ACD", 0.0, float("nan"), t), ("1ABC_a", "--", 1.0, 1.0, t), (None, "ACD", 1.0, 1.0, t)]
    a = [("1ABC_A", 3, 0.5, t), ("1abc_A", -1, 1.5, t + timedelta(1)), ("1ABC_A", 2, float("nan"), t + timedelta(1)), ("1ABC_Z", 1, 1.0, t)]
    rs = spark.createDataFrame(r, "id string, aa string, resolution double, quality_score double, loaded_at timestamp").withColumn("digest", F.lit(1))
    an = spark.createDataFrame(a, "id string, internal_missing_residues int, backbone_complete_fraction double, loaded_at timestamp")
    got = {x["id"]: x for x in survivors.known_values(rs, an).collect()}
    assert set(got) == {"1ABC_A", "1ABC_B"}
    assert got["1ABC_A"]["last_delivered"] - got["1ABC_B"]["last_delivered"] == 86_400_000_000
    x = got["1ABC_A"]
    assert (x["resolution"], x["quality_score"], x["internal_missing_residues"], x["backbone_complete_fraction"]) == (2.0, 0.5, 2, 0.5)
    assert got["1ABC_A"]["digest"] == got["1ABC_B"]["digest"] and got["1ABC_B"]["resolution"] is None
    assert survivors.known_values(rs.limit(0), an.limit(0)).count() == 0
