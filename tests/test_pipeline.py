import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from weftline.__main__ import main
from weftline.plans import pipeline
from weftline.sources import release

LETTERS = "ACDEFGHIKLMNPQRSTVWY"


def cif(entry, chains, length, resolution):
    atoms = "".join(f"ATOM CA . 1 {i} {c} {i} ? 1.0 10 1\n" for c in chains for i in range(1, length + 1))
    return f"""data_{entry}
_exptl.method 'X-RAY DIFFRACTION'
_refine.ls_d_res_high {resolution}
_entity_poly.entity_id 1
_entity_poly.type 'polypeptide(L)'
_entity_poly.pdbx_seq_one_letter_code_can {'A' * (length + 10)}
loop_
_atom_site.group_PDB
_atom_site.label_atom_id
_atom_site.label_alt_id
_atom_site.label_entity_id
_atom_site.label_seq_id
_atom_site.auth_asym_id
_atom_site.auth_seq_id
_atom_site.pdbx_PDB_ins_code
_atom_site.occupancy
_atom_site.B_iso_or_equiv
_atom_site.pdbx_PDB_model_num
{atoms}"""


def test_build_from_files(spark, tmp_path):
    rnd = random.Random(61)
    aa, di = "", ""
    for i in range(12):
        entry = f"{i + 10}ab"
        (tmp_path / "cif").mkdir(exist_ok=True)
        (tmp_path / "cif" / f"{entry}.cif.gz").write_bytes(gzip.compress(cif(entry.upper(), "AB", 40, 1.5 if i else 3.5).encode()))
        for c in "AB":
            s = "".join(rnd.choice(LETTERS) for _ in range(40))
            aa += f">{entry}_{c}\n{s}\n"
            di += f">{entry}_{c}\n{s.lower()}\n" if (i, c) != (1, "B") else ""
    (tmp_path / "aa.fasta").write_text(aa)
    (tmp_path / "di.fasta").write_text(di)
    (tmp_path / "clusters.tsv").write_text("12AB_A\t13AB_B\n12AB_A\tunknown\n")
    at = lambda x: str(tmp_path / x)
    main(["candidates", "--aa", at("aa.fasta"), "--three-di", at("di.fasta"), "--structures", at("cif"), "--out", at("c")])
    r = spark.read.parquet(at("c/records"))
    assert r.count() == 21 and {tuple(x) for x in spark.read.parquet(at("c/all")).filter("reason is not null").select("id", "reason").collect()} == {("10AB_A", "low_xray_resolution"), ("10AB_B", "low_xray_resolution"), ("11AB_B", "missing_3di")}
    one = r.filter("id = '12AB_A'").first()
    assert (one["entity_id"], one["deposited_length"], one["coverage"], one["length"]) == ("1", 50, 0.8, 40)
    main(["annotations", "--records", at("c/records"), "--structures", at("cif"), "--out", at("ann")])
    a = spark.read.parquet(at("ann"))
    assert a.count() == 21 and a.filter("observed_ca_residues = 40 and internal_missing_residues = 0 and terminal_missing_residues = 10").count() == 21
    main(["split", "--records", at("c/records"), "--out", at("s"), "--clusters", at("clusters.tsv"), "--test-groups", "2", "--valid-groups", "2"])
    m = {x["id"]: x for x in spark.read.parquet(at("s/membership")).collect()}
    assert m["12AB_A"]["component"] == m["13AB_B"]["component"] == "12AB_A"
    s = {x["id"]: x["split"] for x in spark.read.parquet(at("s/selected")).collect()}
    v, t = next(i for i, x in s.items() if x == "valid"), next(i for i, x in s.items() if x == "train")
    (tmp_path / "hits.tsv").write_text(f"{v}\t{t}\t0.9\t40\t1.0\t1.0\t1e-9\t99\n")
    main(["repair", "--records", at("c/records"), "--split", at("s"), "--hits", at("hits.tsv"), "--out", at("r"), "--test-count", "2"])
    after = {x["id"] for x in spark.read.parquet(at("r/selected")).collect()}
    assert t not in after and v in after and json.loads((tmp_path / "r/state.json").read_text())["status"] == "repair_pending_reaudit"
    main(["export", "--records", at("c/records"), "--selected", at("r/selected"), "--out", at("out")])
    main(["validate", "--records", at("c/records"), "--out", at("out")])
    assert spark.read.parquet(at("out/test")).count() == 2 and (tmp_path / "out/SHA256SUMS").read_text().count("parquet") >= 3
    main(["report", "--selected", at("r/selected"), "--out", at("report.json")])
    assert json.loads((tmp_path / "report.json").read_text())["audit"] == "missing"


def test_structure_groups_and_overlay(spark):
    r = spark.createDataFrame([(c,) for c in "abcdef"], "id string")
    clusters = spark.createDataFrame([("1", "2"), ("c", "zz")], "rep string, member string")
    keys = spark.createDataFrame([("1", "b"), ("2", "a")], "key string, id string")
    domains = spark.createDataFrame([("c", "X1;x9"), ("d", "x2"), ("e", "x3")], "id string, domains string")
    topologies = spark.createDataFrame([("x1", "1.1.1"), ("x2", "1.1.1"), ("x3", "2.2.2")], "domain string, topology string")
    one = pipeline.structure_groups(r, clusters, keys, domains, topologies)
    assert dict(map(tuple, one.collect())) == {"a": "a", "b": "a", "c": "c", "d": "c", "e": "e", "f": "f"}
    two = spark.createDataFrame([("b", "b"), ("c", "b")], "id string, component string")
    assert dict(map(tuple, pipeline.overlay(r, one, two).collect())) == {"a": "a", "b": "a", "c": "a", "d": "a", "e": "e", "f": "f"}


def test_gates_and_copies(spark, tmp_path):
    with pytest.raises(ValueError, match="audit"):
        release.stage(spark, {}, str(tmp_path / "x"), gates={"counts": True, "audit": False})
    (tmp_path / "a").write_text("1")
    df = spark.createDataFrame([(str(tmp_path / "a"), "a1")], "path string, name string")
    assert release.copy_files(df.union(df), str(tmp_path / "to")) == 1 and (tmp_path / "to/a1").read_text() == "1"
    with pytest.raises(ValueError, match="missing files"):
        release.copy_files(df.withColumn("path", F.lit("/nowhere")), str(tmp_path / "to"))
    (tmp_path / "j.json").write_text('{"a":\n 1}')
    assert release.read_json(spark, str(tmp_path / "j.json")) == {"a": 1}
    with pytest.raises(FileNotFoundError):
        release.read_json(spark, str(tmp_path / "none.json"))
