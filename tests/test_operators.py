import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.operators import annotate, audit, edges, quality, rank, similarity, skew, splits, validate
from weftline.operators.components import connected_components


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def union_find(pairs):
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


def test_components_random_and_edge_cases(spark):
    rnd = random.Random(1)
    name = lambda i: f"n{i:03d}"
    pairs = [(name(rnd.randrange(120)), name(rnd.randrange(120))) for _ in range(70)] + [(name(i), name(i + 1)) for i in range(200, 230)] + [("hub", name(300 + i)) for i in range(40)]
    extra = [(None, "a"), ("a", None), ("self", "self"), pairs[0], pairs[0][::-1]]
    df = spark.createDataFrame(pairs + extra, "src string, dst string").withColumn("u", F.lit(1)).withColumn("component", F.lit("x"))
    want = union_find([p for p in pairs if p[0] != p[1]])
    assert dict(rows(connected_components(df))) == want
    assert rows(connected_components(df.limit(0))) == []


def summary(data):
    out = {}
    for k, v, o in data:
        s = out.setdefault(k, [0, [], []])
        s[0] += 1
        if v is not None and v == v:
            s[1].append(v)
        if o is not None:
            s[2].append(o)
    return {k: (n, len(v), min(v, default=None), max(v, default=None), min(o, default=None), max(o, default=None), len(set(o))) for k, (n, v, o) in out.items()}


@pytest.mark.parametrize("partitions", [6, 64, 200])
@pytest.mark.parametrize("shape", ["mixed", "one_key", "equal_rows", "null_key", "empty"])
def test_per_key_summary(spark, shape, partitions):
    rnd = random.Random(2)
    data = {
        "mixed": [(rnd.choice(["a", "a", "a", "b", "c", None]), rnd.choice([None, float("nan"), 1.5, 2.0, -3.0]), rnd.choice([None, "x", "y", "z"])) for _ in range(400)],
        "one_key": [("hot", float(i), f"{i // 3:04d}") for i in range(500)],
        "equal_rows": [("hot", 1.0, "same")] * 300 + [("b", 2.0, "t")],
        "null_key": [(None, float(i), f"{i:04d}") for i in range(600)] + [(f"k{i % 9}", None, None) for i in range(400)],
        "empty": [],
    }[shape]
    df = spark.createDataFrame(data, "k string, v double, o string").withColumn("part", F.lit(7)).withColumn("key", F.lit("clash"))
    out = skew.per_key_summary(df, "k", "v", "o", partitions=partitions)
    got = {r["key"]: (r["n_rows"], r["n_values"], r["low"], r["high"], r["first_order"], r["last_order"], r["n_orders"]) for r in out.collect()}
    assert got == summary(data)
    if shape == "mixed":
        n = summary(data)
        heavy = {r["key"] for r in skew.heavy_keys(skew.per_key_summary(df, "k", "v", "o"), 0.2).collect()}
        assert heavy == {k for k, s in n.items() if k is not None and s[0] >= 0.2 * len(data)}


def test_a_heavy_null_key_is_cut_across_partitions(spark):
    df = spark.createDataFrame([(None if i % 2 else f"k{i}", float(i), f"{i:05d}") for i in range(4000)], "k string, v double, o string")
    cut = df.repartitionByRange(64, "k", "o").withColumn("part", F.spark_partition_id())
    assert cut.filter("k is null").select("part").distinct().count() > 20
    null = skew.per_key_summary(df, "k", "v", "o", 64).filter("key is null").first()
    assert (null["n_rows"], null["n_orders"], null["first_order"], null["last_order"], null["total"]) == (2000, 2000, "00001", "03999", float(sum(range(1, 4000, 2))))


def test_exclusion_reason_order(spark):
    good = "ACDEFGHIKL" * 4
    cases = [
        (None, good, "m", "xray", 1.0, "missing_aa"), ("", None, "m", "xray", 1.0, "missing_aa"), (good, "", "m", "xray", 1.0, "missing_3di"), (good, good, None, "xray", 1.0, "missing_structure_metadata"),
        (good, good[1:], "m", "xray", 1.0, "length_mismatch"), (good[:29], good[:29], "m", "xray", 1.0, "too_short"), (good[:30], good[:30], "m", "xray", 3.0, None), ("X" * 8 + good[8:], good, "m", "xray", 1.0, None),
        ("X" * 9 + good[9:], good, "m", "xray", 1.0, "too_many_unknown_aa"), (good, "Z" * 40, "m", "xray", 1.0, "invalid_3di"), (good, good, "m", "other", 1.0, "method_excluded"), (good, good, "m", None, 1.0, "method_excluded"),
        (good, good, "m", "xray", None, "missing_resolution"), (good, good, "m", "xray", 0.0, "missing_resolution"), (good, good, "m", "xray", float("nan"), "missing_resolution"), (good, good, "m", "xray", 3.01, "low_xray_resolution"),
        (good, good, "m", "em", 4.0, None), (good, good, "m", "em", 4.01, "low_em_resolution"),
    ]
    df = spark.createDataFrame(cases, "aa string, three_di string, method string, method_category string, resolution double, want string")
    assert df.filter(~F.col("want").eqNullSafe(quality.exclusion_reason())).count() == 0


def test_pair_and_usable(spark):
    a, b = spark.createDataFrame([("x", 1), ("y", 2), (None, 3)], "id string, v int"), spark.createDataFrame([("y", 5), ("z", 6), (None, 7)], "id string, v int")
    assert rows(quality.pair(a, b)) == sorted([("x", 1, None, "left_only"), ("y", 2, 5, "both"), ("z", None, 6, "right_only")], key=repr)
    u = spark.createDataFrame([(0.95, 0.9, 10, 50, True), (0.951, 1.0, 0, 50, False), (0.5, 0.89, 0, 50, False), (0.5, 1.0, 20, 200, True), (0.5, 1.0, 21, 200, False), (None, 1.0, 0, 50, False), (0.5, None, 0, 50, False), (0.5, 1.0, None, 50, False), (0.5, float("nan"), 0, 50, False)],
                              "three_di_max_token_fraction double, backbone_complete_fraction double, internal_missing_residues int, length int, want boolean")
    assert u.filter(quality.usable() != F.col("want")).count() == 0
    h = spark.createDataFrame([(0.3, 0.8, 0.8, True), (0.2999, 0.8, 0.8, False), (float("nan"), 0.9, 0.9, False), (0.9, None, 0.9, False)], "fident double, qcov double, tcov double, want boolean")
    assert h.filter(quality.similarity_hit() != F.col("want")).count() == 0


def test_edges(spark):
    df = spark.createDataFrame([("a", "k", ["p"]), ("b", "k", ["p", "q"]), ("c", None, ["q"]), (None, "k", ["q"]), ("d", "z", None)], "id string, key string, vals array<string>")
    assert rows(edges.bucket_edges(df, "key")) == [("b", "a")]
    assert rows(edges.value_edges(df, "vals")) == [("b", "a"), ("c", "b")]
    c = spark.createDataFrame([("a", "b"), ("a", "zz"), ("a", "b"), (None, "b")], "rep string, member string")
    assert rows(edges.cluster_edges(c, df)) == [("a", "b")]
    k = spark.createDataFrame([("b", "B")], "key string, id string")
    assert rows(edges.translate_keys(spark.createDataFrame([("a", "b"), ("b", "c")], "src string, dst string"), k)) == [("B", "c"), ("a", "B")]
    assert dict(rows(edges.label_vertices(df, spark.createDataFrame([("b", "a"), ("a", "a")], "id string, component string")))) == {"a": "a", "b": "a", "c": "c", "d": "d"}


def test_ranking(spark):
    df = spark.createDataFrame([("b", "s", 1.0, 0, 1.0, 2.0), ("a", "s", 1.0, None, None, None), ("c", "s", None, 0, 1.0, 1.9), ("d", None, 9.0, 0, 1.0, 1.0), ("e", "t", float("nan"), 1, 0.5, float("nan"))], "id string, aa string, quality_score double, internal_missing_residues int, backbone_complete_fraction double, resolution double")
    assert rows(rank.dedupe_exact(df, "aa", rank.by_quality()).select("aa", "id")) == [("s", "a"), ("t", "e")]
    assert rows(rank.dedupe_exact(df, "aa", rank.by_completeness()).select("aa", "id")) == [("s", "c"), ("t", "e")]
    w = rank.group_weights(spark.createDataFrame([("a", "g"), ("b", "g"), ("c", "h")], "id string, component string"))
    assert rows(w) == [("a", "sequence:g", 2, 0.5), ("b", "sequence:g", 2, 0.5), ("c", "sequence:h", 1, 1.0)]


def records(spark, n=60, groups=12):
    rnd = random.Random(3)
    data = [(f"r{i:03d}", f"g{rnd.randrange(groups):02d}", f"S{rnd.randrange(n // 2)}", 40, rnd.choice([1.0, 2.0, None]), f"20{rnd.choice([23, 24, 25, 26, 27])}-06-01") for i in range(n)]
    return spark.createDataFrame(data, "id string, component string, aa string, length int, quality_score double, release_date string")


@pytest.mark.parametrize("mode", ["hash", "mt19937"])
def test_grouped_split_properties(spark, mode):
    r = records(spark)
    selected, held = splits.grouped_split(r, 3, 2, quality.evaluation_length(), rank.by_quality(), mode=mode)
    s, comp = dict(rows(selected)), dict(rows(r.select("id", "component")))
    test, valid, train = ([i for i, x in s.items() if x == n] for n in ("test", "valid", "train"))
    assert (len(test), len(valid)) == (3, 2)
    groups = [{comp[i] for i in x} for x in (test, valid, train)]
    assert not groups[0] & groups[1] and not (groups[0] | groups[1]) & groups[2]
    if mode == "mt19937":
        order = sorted(set(comp.values()))
        random.Random(42).shuffle(order)
        assert groups[0] == set(order[:3]) and groups[1] == set(order[3:5])
    m = dict((a, c) for a, _, c, _ in rows(splits.membership(r, selected, held)))
    assert {m[i] for i in test} == {"test"} and {m[i] for i in comp if comp[i] in groups[0] and i not in s} <= {"heldout_excluded"}
    x = dict(rows(splits.excluded(r, selected, held)))
    assert set(x) == set(comp) - set(s)
    again, _ = splits.grouped_split(r.orderBy(F.desc("id")), 3, 2, quality.evaluation_length(), rank.by_quality(), mode=mode)
    assert dict(rows(again)) == s
    with pytest.raises(splits.TooFewGroups):
        splits.grouped_split(r, 30, 30, quality.evaluation_length(), rank.by_quality(), mode=mode)


def test_chronological_and_novelty(spark):
    r = records(spark)
    s = splits.chronological_split(r, rank.by_quality())
    assert s.join(r, "id").groupBy("split", "aa").count().filter("count > 1").count() == 0
    n = dict((i, v) for i, _, v in rows(splits.novelty(s, r.select("id", "component"), "novel")))
    got, comp = dict(rows(s)), dict(rows(r.select("id", "component")))
    train = {comp[i] for i, x in got.items() if x == "train"}
    assert n == {i: int(comp[i] not in train) for i, x in got.items() if x != "train"}


HITS = "query_id string, target_id string, fident double, qcov double, tcov double"


def test_repair_to_fixpoint(spark):
    members = spark.createDataFrame([(f"{g}{i}", g, 50, float(i)) for g in "abcdefgh" for i in range(2)], "id string, merged_group string, length int, quality_score double")
    selected = spark.createDataFrame([("a0", "valid"), ("b0", "test"), ("c0", "test")] + [(f"{g}{i}", "train") for g in "defgh" for i in range(2)], "id string, split string")
    hits = spark.createDataFrame([("a0", "d0", 0.5, 0.9, 0.9), ("b0", "a0", 0.5, 0.9, 0.9), ("c0", "e1", 0.29, 0.9, 0.9), ("f1", "f0", 0.9, 0.9, 0.9), ("nobody", "a0", 0.9, 0.9, 0.9), ("g1", "e0", 0.9, 0.9, 0.9)], HITS)
    order = audit.initial_order(members.filter("merged_group > 'c'").select("merged_group", F.lit("train").alias("split")))
    state = audit.RepairState(selected, members.select("merged_group").limit(0), order)
    assert rows(audit.cross_split_hits(hits, selected)) == [("valid_test", "a0", "b0"), ("valid_train", "a0", "d0")]
    end = audit.repair_to_fixpoint(lambda _: hits, members, state)
    got = dict(rows(end.selected))
    assert end.status == "sequence_audit_passed" and got["a0"] == "valid" and "b0" not in got and "d0" not in got and "d1" not in got
    assert sum(x == "test" for x in got.values()) == 2 and audit.cross_split_hits(hits, end.selected).count() == 0
    m = {i: (s, f) for i, _, s, f in rows(audit.repaired_membership(members, end, spark.createDataFrame([("a",), ("b",), ("c",)], "merged_group string")))}
    assert m["a0"] == ("valid", 1) and m["a1"] == ("heldout_excluded", 0) and m["b0"] == ("sequence_audit_removed", 0) and m["d1"] == ("sequence_audit_removed", 0)
    with pytest.raises(ValueError):
        audit.repair_round(hits, members, state, test_count=20)


def test_number_rows(spark):
    df = spark.createDataFrame([(f"k{(i * 37) % 101:03d}",) for i in range(101)], "id string")
    assert [r["row_index"] for r in audit.number_rows(df, ["id"]).orderBy("id").collect()] == list(range(101))
    assert audit.number_rows(df.limit(0), ["id"]).count() == 0
    assert validate.contiguous(audit.number_rows(df, ["id"])).first()["contiguous"]


def test_residues_and_chains(spark):
    a = [("A", "1", "1", "?", x, ".", "1.0", "10") for x in ("N", "CA", "C", "O")] + [("A", "3", "3", "?", "CA", "B", "0.5", "30"), ("A", "3", "3", "?", "CA", "A", "0.4", "10"), ("A", ".", "9", "B", "CA", ".", "oops", "x"), ("B", "2", "2", "?", "N", ".", "1", "1")]
    atoms = spark.createDataFrame(a, "chain string, label_seq string, auth_seq string, ins string, atom string, alt string, occupancy string, b_factor string")
    c = annotate.chains(annotate.residues(atoms, ["chain"]), ["chain"]).withColumn("deposited_length", F.lit(5)).withColumn("terminal", annotate.terminal_missing())
    got = {r["chain"]: r for r in c.collect()}
    x = got["A"]
    assert (x["observed_ca_residues"], x["complete_backbone_residues"], x["internal_missing_residues"], x["terminal"], x["alternate_location_residues"]) == (3, 1, 1, 2, 1)
    assert x["mean_ca_occupancy"] == 0.75 and x["min_ca_occupancy"] == 0.5 and x["mean_ca_b_factor"] == 15.0
    assert got["B"]["observed_ca_residues"] == 0 and got["B"]["backbone_complete_fraction"] is None


def test_mapping_and_references(spark):
    m = spark.createDataFrame([("1abc", "A", "P2", ""), ("1abc", "A", "P1", "x"), ("1abc", "A", "?", "y"), ("9zzz", "A", "P9", None)], "pdb string, chain string, SP_PRIMARY string, UNIPROT string")
    w = spark.createDataFrame([("1abc", "A")], "pdb string, chain string")
    assert rows(annotate.mapped_ids(m, ["pdb", "chain"], {"ids": ["SP_PRIMARY", "UNIPROT"]}, w)) == [("1abc", "A", "P1;P2;y")]
    seq = spark.createDataFrame([("e", "1", "?", "A,B"), ("e", "2", "Q1", "A; C"), ("e", "3", "?", "D")], "pdb_id string, ref_id string, accession string, strands string")
    refs = spark.createDataFrame([("e", "1", "UNP", "P1"), ("e", "3", "GB", "G1")], "pdb_id string, ref_id string, db_name string, accession string")
    assert rows(annotate.native_accessions(seq, refs)) == [("e", "A", "P1;Q1"), ("e", "B", "P1"), ("e", "C", "Q1")]


def edit(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        c = [i]
        for j, y in enumerate(b, 1):
            c.append(min(p[j] + 1, c[-1] + 1, p[j - 1] + (x != y)))
        p = c
    return p[-1]


def test_similar_sequences_against_brute_force(spark):
    rnd = random.Random(5)
    base = ["".join(rnd.choice("ACDEFG") for _ in range(rnd.randrange(10, 60))) for _ in range(12)]
    seqs = []
    for i in range(50):
        s = list(rnd.choice(base))
        for _ in range(rnd.randrange(5)):
            s[rnd.randrange(len(s))] = rnd.choice("ACDEFG")
        seqs.append((f"s{i:02d}", "".join(s)))
    seqs += [("null", None), ("short", "AC"), ("s00", seqs[0][1])]
    df = spark.createDataFrame(seqs, "id string, seq string")
    got = {(r["query_id"], r["target_id"]): r["fident"] for r in similarity.similar_sequences(df.filter("id < 's20'"), df, k=4, shared=0.2).collect()}
    grams = lambda s: {s[i : i + 4] for i in range(len(s) - 3)}
    want, ok = {}, [x for x in set(seqs) if x[1] and len(x[1]) >= 4]
    for a, s in ok:
        for b, t in ok:
            if a < "s20" and a != b:
                big, f = max(len(grams(s)), len(grams(t))), 1 - edit(s, t) / max(len(s), len(t))
                if len(grams(s) & grams(t)) >= -(-big * 2 // 10) and f >= 0.3 and min(len(s), len(t)) >= 0.8 * max(len(s), len(t)):
                    want[a, b] = f
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in got) and len(got) > 20
    h = spark.createDataFrame([("q", f"t{i}", 0.5) for i in range(20)], "query_id string, target_id string, fident double")
    assert [r["target_id"] for r in similarity.top_hits(h, 3).orderBy("rank").collect()] == ["t0", "t1", "t10"]


def test_nearest_vectors_in_blocks(spark):
    rnd = np.random.default_rng(6)
    v = rnd.normal(size=(60, 5))
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)] + [(90, [0.0] * 5), (91, None)], "vec_id long, embedding array<float>")
    got = {(r["query_id"], r["rank"]): r["target_id"] for r in similarity.nearest_vectors(df.filter("vec_id % 5 = 0 or vec_id > 89"), df, 3, block=(4, 7)).collect()}
    v = v.astype("float32").astype("float64")
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    for q in range(0, 60, 5):
        s = u @ u[q]
        s[q] = -9
        assert [got[q, r] for r in (1, 2, 3)] == list(np.argsort(-s)[:3])
    assert not any(q >= 60 for q, _ in got)
    assert similarity.nearest_vectors(df.limit(0), df).count() == 0


def test_set_cover_is_the_sequential_greedy(spark):
    rnd = random.Random(7)
    pairs = {tuple(sorted(rnd.sample(range(30), 2))) for _ in range(45)}
    name = lambda i: f"v{i:02d}"
    df = spark.createDataFrame([(name(a), name(b)) for a, b in pairs], "src string, dst string")
    v = spark.createDataFrame([(name(i),) for i in range(32)], "id string")
    near = {name(i): {name(b if a == i else a) for a, b in pairs if i in (a, b)} for i in range(32)}
    open_, want = set(near), {}
    while open_:
        best = min(open_, key=lambda x: (-len(near[x] & open_), hashlib.md5(x.encode()).hexdigest(), x))
        for m in (near[best] & open_) | {best}:
            want[m] = best
        open_ -= set(x for x, r in want.items())
    assert {m: r for r, m in rows(similarity.set_cover_clusters(df, v))} == want


def test_set_cover_of_a_long_path_takes_few_rounds(spark, monkeypatch):
    written, write = [], similarity.Scratch.write
    monkeypatch.setattr(similarity.Scratch, "write", lambda self, *a, **k: written.append(1) or write(self, *a, **k))
    path = spark.range(600).select(F.format_string("v%04d", "id").alias("src"), F.format_string("v%04d", F.col("id") + 1).alias("dst"))
    v = spark.range(601).select(F.format_string("v%04d", "id").alias("id"))
    got = rows(similarity.set_cover_clusters(path, v))
    assert len(got) == 601 and all(abs(int(r[1:]) - int(m[1:])) <= 1 for r, m in got) and {r for r, m in got} == {m for r, m in got if r == m}
    assert len(written) <= 1 + 3 * 12


def test_validation(spark):
    a, b = spark.createDataFrame([("x", 1), ("y", 2), ("y", 2)], "id string, v int"), spark.createDataFrame([("x", 9)], "id string, v int")
    assert rows(validate.missing_keys(a, b)) == [("y",)] and rows(validate.duplicate_keys(a, "id")) == [("y", 2)]
    with pytest.raises(ValueError, match="y"):
        validate.required_join(a, b)
    assert rows(validate.required_join(a.filter("id = 'x'"), b)) == [("x", 9)]
    s = spark.createDataFrame([("x", "train"), ("x", "test"), ("y", "test")], "id string, split string")
    assert rows(validate.split_overlap(s)) == [("x", 2)]
    d = spark.createDataFrame([("x", True), ("x", False), ("q", True)], "id string, ok boolean")
    assert tuple(validate.reconcile(a, d, ok="ok").first()) == (2, 2, 1, 1, 1, 1)
    assert validate.same_rows(a, a).count() == 0 and validate.same_rows(a, b).count() == 4


def test_similar_sequences_keeps_pairs_that_share_few_grams(spark):
    rnd = random.Random(11)
    letters = "ACDEFGHIKLMNPQRSTVWY"
    texts = ["".join(rnd.choice(letters) for _ in range(n)) for n in (3, 40, 63, 64, 65, 128, 129, 200)]
    rows = [(f"t{i}", s) for i, s in enumerate(texts)]
    for i, s in enumerate(texts):
        for share in (0.0, 0.3, 0.45, 0.6, 0.72, 0.9):  # scattered letters replaced, and some cut off
            x = "".join(rnd.choice(letters) if rnd.random() < share else c for c in s)
            rows.append((f"q{i}_{share}", x[: len(x) - len(x) // 12]))
    rows += [("qnull", None), ("qempty", ""), ("t1", texts[1])]
    df = spark.createDataFrame(rows, "id string, seq string")
    q, t = df.filter("id like 'q%'"), df.filter("id like 't%'")
    ok = sorted({x for x in rows if x[1]})
    want = {}
    for a, s in ok:
        for b, u in ok:
            big = max(len(s), len(u))
            if a[0] == "q" and b[0] == "t" and min(len(s), len(u)) / big >= 0.8 and 1 - edit(s, u) / big >= 0.3:
                want[a, b] = 1 - edit(s, u) / big
    got = {(r["query_id"], r["target_id"]): r["fident"] for r in similarity.similar_sequences(q, t).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in got)
    assert {("q0_0.0", "t0"), ("q5_0.45", "t5")} <= got.keys() and min(got.values()) < 0.5
    assert similarity.similar_sequences(q.limit(0), t).count() == 0
    small = similarity.aligned_texts(q, t, 0.3, 0.8, block=(2, 3)).distinct().count()
    assert small == len({(dict(ok)[a], dict(ok)[b]) for a, b in want})
