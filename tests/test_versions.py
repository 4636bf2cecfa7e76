"""From files to staged versions, and repair by the library's own audits."""

import gzip
import hashlib
import json
import random
import re

import pytest
from pyspark.sql import functions as F
from test_pipeline import LETTERS, cif

from weftline.__main__ import main
from weftline.operators import audit
from weftline.plans import pipeline
from weftline.sources import inventory


def test_versions_from_files(spark, tmp_path):
    rnd = random.Random(62)
    at = lambda x: str(tmp_path / x)
    aa, entries, chains = "", [], "AB"
    for i in range(20):
        entry = f"{i + 10}xy"
        entries.append(entry)
        whole = re.sub(r"ATOM CA (.*)\n", lambda m: "".join(f"ATOM {x} {m[1]}\n" for x in ("N", "CA", "C", "O")), cif(entry.upper(), chains, 40, 1.5))
        text = whole + f"""_pdbx_database_status.recvd_initial_deposition_date 2020-01-01
loop_
_pdbx_audit_revision_history.ordinal
_pdbx_audit_revision_history.revision_date
1 {2024 + i % 3}-03-01
"""
        (tmp_path / "web").mkdir(exist_ok=True)
        (tmp_path / "web" / f"{entry}.cif.gz").write_bytes(gzip.compress(text.encode()))
        for c in chains:
            aa += f">{entry}_{c}\n{''.join(rnd.choice(LETTERS) for _ in range(40))}\n"
    (tmp_path / "ids.txt").write_text("\n".join(entries) + "\n")
    (tmp_path / "aa.fasta").write_text(aa)
    main(["source-download", "--ids", at("ids.txt"), "--base", f"file://{tmp_path}/web", "--root", at("cif"), "--out", at("log")])
    main(["source-verify", "--ids", at("ids.txt"), "--log", at("log"), "--out", at("verify.json")])
    assert json.loads((tmp_path / "verify.json").read_text())["logged_ids"] == 20
    main(["candidates", "--aa", at("aa.fasta"), "--three-di", at("aa.fasta"), "--structures", at("cif"), "--out", at("c")])
    maps = tmp_path / "maps"
    maps.mkdir()
    (maps / "pdb_chain_uniprot.csv").write_text("# made\nPDB,CHAIN,SP_PRIMARY\n10xy,A,P1\n11xy,A,P1\n11xy,A,P0\n99zz,A,P1\n")
    (maps / "pdb_chain_cath_uniprot.csv").write_text("PDB,CHAIN,CATH_ID\n12xy,A,12xyA00\n13xy,B,13xyB00\n")
    (maps / "SHA256SUMS").write_text("".join(f"{hashlib.sha256(f.read_bytes()).hexdigest()}  {f.name}\n" for f in sorted(maps.glob("*.csv"))))
    main(["annotations", "--records", at("c/records"), "--structures", at("cif"), "--out", at("ann"), "--mapping", at("maps")])
    a = {r["id"]: r for r in spark.read.parquet(at("ann")).collect()}
    assert a["11XY_A"]["sifts_uniprot_ids"] == "P0;P1" and a["12XY_A"]["sifts_cath_ids"] == "12xyA00" and a["12XY_A"]["sifts_pfam_ids"] == "" and a["12XY_A"]["release_date"] == "2026-03-01"
    ids = sorted(a)
    (tmp_path / "db").write_bytes(b"".join(i.encode() + b"\n\0" for i in ids))
    starts = [sum(len(i) + 2 for i in ids[:k]) for k in range(len(ids))]
    (tmp_path / "db.index").write_text("".join(f"{k}\t{starts[k]}\t{len(i) + 2}\n" for k, i in enumerate(ids)))
    main(["header-keys", "--data", at("db"), "--index", at("db.index"), "--out", at("keys")])
    (tmp_path / "clusters.tsv").write_text("14XY_A\t15XY_B\n")
    (tmp_path / "folds.tsv").write_text(f"{ids.index('16XY_A')}\t{ids.index('17XY_A')}\n")
    (tmp_path / "domains.txt").write_text("12xyA00 1 10 8 1\n13xyB00 1 10 8 2\n")
    main(["split", "--records", at("c/records"), "--out", at("s"), "--clusters", at("clusters.tsv"), "--test-groups", "2", "--valid-groups", "2"])
    flags = ["--first", at("s/selected"), "--clusters", at("clusters.tsv"), "--structure-clusters", at("folds.tsv"), "--keys", at("keys"), "--domains", at("domains.txt")]
    held = [x for name, n in (("test", 2), ("valid", 2), ("structure-test", 3), ("structure-valid", 3)) for x in (f"--{name}-groups", str(n))]
    main(["build-versions", "--records", at("c/records"), "--annotations", at("ann"), "--out", at("v"), *flags, *held])
    sizes = {v: {r["id"]: r["group_size"] for r in spark.read.parquet(at(f"v/{v}/membership")).collect()} for v in ("sequence", "structure")}
    assert sizes["sequence"]["10XY_A"] == sizes["sequence"]["14XY_A"] == 4 and sizes["sequence"]["12XY_A"] == sizes["sequence"]["16XY_A"] == 2
    assert sizes["structure"]["12XY_A"] == sizes["structure"]["13XY_A"] == sizes["structure"]["16XY_B"] == 4
    assert spark.read.parquet(at("v/v1_1/annotations")).count() == spark.read.parquet(at("s/selected")).count()
    novel = spark.read.parquet(at("v/time/novelty"))
    assert novel.count() == 26 and novel.filter("release_date < '2025'").count() == 0
    main(["export-versions", "--records", at("c/records"), "--annotations", at("ann"), "--keys", at("keys"), "--versions", at("v"), "--out", at("x")])
    test = spark.read.parquet(at("x/structure/test"))
    assert test.columns[:4] == ["row_index", "id", "sequence_3di", "sequence_aa"] and {"release_date", "coverage", "sifts_uniprot_ids"} <= set(test.columns) and "chain_id" not in test.columns
    m = {r["id"]: r for r in spark.read.parquet(at("x/structure/train_structure_ids")).collect()}
    assert all(r["structure_key"] == str(ids.index(i)) and r["pdb_id"] == i[:4] for i, r in m.items())
    (tmp_path / "expected.json").write_text('{"structure": {"test": 3, "valid": 3}}')
    main(["validate-versions", "--versions", at("v"), "--exported", at("x"), "--out", at("report.json"), "--sums", at("maps"), "--expected", at("expected.json")])
    told = json.loads((tmp_path / "report.json").read_text())
    assert told["versions"]["sequence"]["test"] == 2 and len(told["mapping_checksums"]) == 2
    (tmp_path / "expected.json").write_text('{"structure": {"test": 4}}')
    with pytest.raises(ValueError, match="structure, test"):
        main(["validate-versions", "--versions", at("v"), "--exported", at("x"), "--out", at("report.json"), "--expected", at("expected.json")])
    (maps / "pdb_chain_uniprot.csv").write_text("changed")
    with pytest.raises(ValueError, match="checksum"):
        main(["validate-versions", "--versions", at("v"), "--exported", at("x"), "--out", at("report.json"), "--sums", at("maps")])
    with pytest.raises(ValueError, match="no match"):
        pipeline.export_version(spark.createDataFrame([("none", "test")], "id string, split string"), spark.read.parquet(at("c/records")), spark.read.parquet(at("ann")), spark.read.parquet(at("keys")))
    main(["fasta-shards", "--fasta", at("aa.fasta"), "--out", at("shards"), "--per-shard", "15"])
    assert sorted(x.name for x in (tmp_path / "shards").glob("shard=*")) == ["shard=0", "shard=1", "shard=2"]


def test_verify_tells_what_is_wrong(spark):
    ids, log = spark.createDataFrame([("1abc",), ("2abc",)], "pdb_id string"), spark.createDataFrame([("1ABC", "ok"), ("1abc", "ok"), ("9zzz", "error:OSError")], "pdb_id string, status string")
    r = inventory.verify(ids, log)
    assert (r["status"], r["missing_examples"], r["extra_examples"], r["failure_examples"]) == ("failed", ["2ABC"], ["9ZZZ"], ["1ABC", "9ZZZ"])


def brute_repair(members, selected, order, hits, rounds=20):
    group = {i: g for i, g, _, _ in members}
    reps = {}
    for i, g, n, q in members:
        if 30 <= n <= 510:
            reps[g] = min(reps.get(g, (9, "~")), (-q, i))
    sel, blocked, rank = dict(selected), set(), {"valid": 0, "test": 1, "train": 2}
    want = sum(s == "test" for s in sel.values())
    for _ in range(rounds):
        crossed = set()
        for a, b in hits:
            if a in sel and b in sel and sel[a] != sel[b]:
                low, high = sorted((a, b), key=lambda x: rank[sel[x]])
                crossed.add((sel[low], sel[high], high))
        if not crossed:
            return sel, blocked
        hit_train, hit_test = ({group[t] for _, s, t in crossed if s == name} for name in ("train", "test"))
        blocked |= hit_train | hit_test
        sel = {i: s for i, s in sel.items() if not (s == "train" and group[i] in hit_train or s == "test" and group[i] in hit_test)}
        for g in order:
            if sum(s == "test" for s in sel.values()) >= want:
                break
            if g in blocked or g not in reps or any(group[i] == g and s != "train" for i, s in sel.items()):
                continue
            sel = {i: s for i, s in sel.items() if group[i] != g} | {reps[g][1]: "test"}
    raise AssertionError("no end")


def test_repair_rounds_with_refill_against_brute_force(spark):
    rnd = random.Random(63)
    members = [(f"{g:03d}_{i}", f"{g:03d}", rnd.choice([20, 50, 60, 600]) if i else 50, float(rnd.randrange(3))) for g in range(90) for i in range(rnd.randrange(1, 4))]
    split = {f"{g:03d}": "valid" if g < 6 else "test" if g < 14 else "train" for g in range(90)}
    selected = [(i, split[g]) for i, g, _, _ in members if split[g] == "train" or i.endswith("_0")]
    ids = [m[0] for m in members]
    hits = [tuple(rnd.sample(ids, 2)) for _ in range(60)] + [(selected[0][0], i) for i in ids[40:44]]
    held = [i for i, x in selected if x != "train"]
    hits += [(rnd.choice(held[:6]), rnd.choice(ids)) for _ in range(40)] + [(rnd.choice(held[:6]), rnd.choice(held[6:])) for _ in range(6)]
    ordered = sorted((g for g, x in split.items() if x == "train"), key=lambda g: (hashlib.md5(f"42:{g}".encode()).hexdigest(), g))
    hits += [(i, rnd.choice(ids)) for i, g, _, _ in members if g in ordered[:16]]  # what refills test has hits of its own
    m = spark.createDataFrame(members, "id string, merged_group string, length int, quality_score double")
    s = spark.createDataFrame(selected, "id string, split string")
    order = audit.initial_order(spark.createDataFrame(list(split.items()), "merged_group string, split string"))
    h = spark.createDataFrame([(a, b, 0.5, 0.9, 0.9) for a, b in hits], "query_id string, target_id string, fident double, qcov double, tcov double")
    want, blocked = brute_repair(members, selected, ordered, hits)
    end = audit.repair_to_fixpoint(lambda _: h, m, audit.RepairState(s, m.select("merged_group").limit(0), order))
    assert dict(map(tuple, end.selected.collect())) == want and {r[0] for r in end.blocked.collect()} == blocked and len(end.rounds) > 2
    reasons = dict(map(tuple, audit.repaired_excluded(m, end, m.filter("merged_group < '014'").select("merged_group")).collect()))
    assert set(reasons) == set(ids) - set(want) and all((r == "sequence_audit_conflict_group_removed") == (i[:3] in blocked) for i, r in reasons.items())


def test_repair_command_audits_itself(spark, tmp_path):
    rnd = random.Random(64)
    word = lambda: "".join(rnd.choice(LETTERS) for _ in range(50))
    seqs = {i: word() for i in "vtabcdef"}
    seqs["a"] = seqs["v"][:48] + "AA"
    split = {"v": "valid", "t": "test"}
    spark.createDataFrame([(i, s, 50, 1.0) for i, s in seqs.items()], "id string, aa string, length int, quality_score double").write.parquet(f"{tmp_path}/records")
    spark.createDataFrame([(i, i, split.get(i, "train")) for i in seqs], "id string, component string, split string").write.parquet(f"{tmp_path}/split/membership")
    spark.createDataFrame([(i, split.get(i, "train")) for i in seqs], "id string, split string").write.parquet(f"{tmp_path}/split/selected")
    main(["repair", "--records", f"{tmp_path}/records", "--split", f"{tmp_path}/split", "--out", f"{tmp_path}/out", "--test-count", "1"])
    assert json.loads((tmp_path / "out/state.json").read_text())["status"] == "sequence_audit_passed"
    assert {r["id"] for r in spark.read.parquet(f"{tmp_path}/out/selected").collect()} == set("vtbcdef")
    clusters = {r["member"]: r["rep"] for r in pipeline.cluster_records(spark.read.parquet(f"{tmp_path}/records").withColumn("three_di", F.lower("aa"))).collect()}
    assert clusters["v"] == clusters["a"] == "a" and clusters["b"] == "b"
