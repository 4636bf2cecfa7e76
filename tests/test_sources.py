import gzip
import hashlib
import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from weftline.operators import annotate
from weftline.sources import inventory, mmcif, readers, writers
from weftline.streaming import deliveries


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def put(folder, name, text):
    p = folder / name
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(p)


def test_fasta(spark, tmp_path):
    p = put(tmp_path, "a.fasta", ">1abc_A some words\nACD\nEF G\n>2xyz_MODEL_2_b\nKL\n>3xyz_C\n")
    assert rows(readers.read_fasta(spark, p)) == [("1ABC_A", "ACDEFG"), ("2XYZ_MODEL_2_b", "KL"), ("3XYZ_C", "")]
    with pytest.raises(ValueError, match="repeated"):
        readers.read_fasta(spark, put(tmp_path, "b.fasta", ">1abc_A\nA\n>1ABC_A\nC\n"))
    with pytest.raises(ValueError, match="malformed"):
        readers.read_fasta(spark, put(tmp_path, "c.fasta", ">abc_A\nA\n"))
    df = spark.createDataFrame([(f"1AB{i}_A", "ACD" * i) for i in range(1, 8)] + [(None, "A"), ("1ABX_A", None)], "id string, seq string")
    writers.write_fasta(df.repartition(3), str(tmp_path / "out"), "id", "seq")
    assert rows(readers.read_fasta(spark, str(tmp_path / "out"))) == rows(df.filter("id is not null and seq is not null"))
    n = writers.write_fasta_shards(df.filter("seq is not null"), str(tmp_path / "shards"), "id", "seq", per_shard=3)
    assert [r["shard"] for r in n.orderBy("row_index").collect()] == [0, 0, 0, 1, 1, 1, 2]
    assert rows(readers.read_fasta(spark, str(tmp_path / "shards/shard=1"))) == [("1AB4_A", "ACD" * 4), ("1AB5_A", "ACD" * 5), ("1AB6_A", "ACD" * 6)]


def test_delimited(spark, tmp_path):
    df = spark.createDataFrame([(" a", 'say "x"', 1.5), (None, "tab\there", None), ("b", "two\nlines", 2.0)], "id string, text string, v double")
    writers.write_tsv(df, str(tmp_path / "t"))
    assert rows(readers.read_tsv(spark, str(tmp_path / "t"), "id string, text string, v double")) == rows(df)
    p = put(tmp_path, "m.csv", "﻿# 2025/01/01\npdb,chain,SP_PRIMARY\n1abc,A,P1\n")
    assert readers.read_csv(spark, p).columns == ["PDB", "CHAIN", "SP_PRIMARY"] and rows(readers.read_csv(spark, p)) == [("1abc", "A", "P1")]
    assert rows(readers.or_empty(spark, str(tmp_path / "none"), "a string", lambda q: readers.read_csv(spark, q))) == []
    assert rows(readers.read_ids(spark, put(tmp_path, "ids.txt", "z\n\na \nm\n"))) == [(0, "z"), (1, "a"), (2, "m")]


def test_hits_clusters_topologies(spark, tmp_path):
    h = "q\tt\t0.3\t10\t0.8\t0.8\t1e-5\t50\nq\tt\t0.3\t10\t0.8\t0.8\t1\nq\tt\tx\t10\t0.8\t0.8\t1\t1\nq\tu\t0.5\t10\t0.9\t0.9\t1e-5\t50\t0.7\t0.6\n"
    got = readers.read_hits(spark, put(tmp_path, "h.tsv", h))
    assert rows(got.select("target_id", "fident", "qtmscore")) == [("t", 0.3, None), ("u", 0.5, 0.7)]
    assert readers.read_hits(spark, str(tmp_path / "no.tsv")).count() == 0
    c = put(tmp_path, "c.tsv", "a\tb\textra\nshort\na\ta\n")
    assert rows(readers.read_clusters(spark, c)) == [("a", "a"), ("a", "b")]
    with pytest.raises(ValueError):
        readers.read_clusters(spark, c, strict=True)
    t = put(tmp_path, "t.txt", "# c\n\n1ABCA00  1 10 8 10 x\n1abcB00 1 2\n")
    assert rows(readers.read_topologies(spark, t)) == [("1abca00", "1.10.8")]


def test_header_keys_and_checksums(spark, tmp_path):
    data = b"1abc_A first\n\x002xyz_MODEL_1_b\n\x00"
    d = put(tmp_path, "db", data)
    assert rows(readers.read_header_keys(spark, d, put(tmp_path, "db.index", "0\t0\t14\n7 14 17\n"))) == [("0", "1ABC_A"), ("7", "2XYZ_MODEL_1_b")]
    with pytest.raises(ValueError, match="repeated"):
        readers.read_header_keys(spark, d, put(tmp_path, "db2.index", "0 0 14\n1 0 14\n"))
    got = readers.checksums(spark, str(tmp_path), "db").collect()
    assert [(r["bytes"], r["sha256"]) for r in got] == [(len(data), hashlib.sha256(data).hexdigest())]


CIF = """data_1ABC
# comment
_exptl.method 'X-RAY DIFFRACTION'
_refine.ls_d_res_high 2.10
_refine.ls_R_factor_R_work ?
_refine.ls_R_factor_R_free 0.25
_pdbx_database_status.recvd_initial_deposition_date 2020-01-01
loop_
_pdbx_audit_revision_history.ordinal
_pdbx_audit_revision_history.revision_date
1 2021-05-01
2 2020-12-31
loop_
_pdbx_struct_assembly.id
_pdbx_struct_assembly.oligomeric_details
1 dimeric
2 'a "quoted" one'
loop_
_entity_poly.entity_id
_entity_poly.type
_entity_poly.pdbx_seq_one_letter_code_can
1 'polypeptide(L)'
;AC(MSE)D
EF
;
2 polyribonucleotide ACGU
loop_
_struct_ref.id
_struct_ref.db_name
_struct_ref.pdbx_db_accession
1 UNP P1
loop_
_struct_ref_seq.ref_id
_struct_ref_seq.pdbx_db_accession
_struct_ref_seq.pdbx_strand_id
1 ? A,B
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
ATOM N . 1 1 A 1 ? 1.0 10 1
ATOM CA . 1 1 A 1 ? 1.0 10 1
ATOM C . 1 1 A 1 ? 1.0 10 1
ATOM O . 1 1 A 1 ? 1.0 10 1
ATOM CA A 1 4 A 4 ? 0.5 20 1
HETATM CA . 3 . A 9 ? 1.0 1 1
ATOM CA . 2 1 B 1 ? 1.0 1 1
"""


def test_structure_files(spark, tmp_path):
    put(tmp_path, "ab/1abc.cif.gz", gzip.compress(CIF.encode()))
    put(tmp_path, "xy/2xyz.cif.gz", b"not gzip")
    put(tmp_path, "em/3emx.cif.gz", gzip.compress(b"data_3EMX\n_exptl.method 'ELECTRON MICROSCOPY'\n_em_3d_reconstruction.resolution 3.4\n"))
    f = mmcif.files(spark, str(tmp_path))
    m = {r["pdb_id"]: r for r in mmcif.read_metadata(f).collect()}
    assert (m["1ABC"]["category"], m["1ABC"]["resolution"]) == ("xray", 2.1) and (m["3EMX"]["category"], m["3EMX"]["resolution"]) == ("em", 3.4)
    assert m["2XYZ"]["error_type"] == "ValueError" and m["1ABC"]["error_type"] is None
    e = mmcif.read_entities(f)
    assert rows(e) == [("1ABC", "1", 6)]
    atoms = mmcif.read_atoms(f)
    assert atoms.count() == 6 and rows(mmcif.chain_entities(atoms, e)) == [("1ABC", "A", "1")]
    c = annotate.chains(annotate.residues(atoms, ["pdb_id", "chain"]), ["pdb_id", "chain"]).filter("chain = 'A'").first()
    assert (c["observed_ca_residues"], c["complete_backbone_residues"], c["internal_missing_residues"]) == (2, 1, 2)
    assert rows(annotate.native_accessions(*mmcif.read_references(f))) == [("1ABC", "A", "P1"), ("1ABC", "B", "P1")]
    x = {r["pdb_id"]: r for r in mmcif.read_entry(f).collect()}["1ABC"]
    assert (x["release_date"], x["r_work"], x["r_free"], x["assembly_count"], x["assembly_descriptions"]) == ("2020-12-31", None, 0.25, 2, 'a "quoted" one;dimeric')


def test_inventory_and_download(spark, tmp_path):
    ids = [f"{i}abc" for i in range(10, 35)]
    page = lambda start, n: (len(ids), ids[start : start + n])
    assert rows(inventory.discover(spark, page, 10)) == [(i.upper(),) for i in ids]
    with pytest.raises(ValueError, match="repeats"):
        inventory.discover(spark, lambda s, n: (20, ["1ABC"] * min(n, 20 - s)), 10)
    with pytest.raises(ValueError, match="incomplete"):
        inventory.discover(spark, lambda s, n: (30, ids[s : s + n]), 10)
    df = spark.createDataFrame([(i,) for i in ids], "pdb_id string")
    assert rows(inventory.shard_rows(df, 4, 1, limit=10)) == [(ids[i],) for i in (1, 5, 9)]

    def get(i):
        if i == "11abc":
            raise OSError("gone")
        return gzip.compress(b"data_" + i.encode())

    small = df.limit(3)
    got = {r["pdb_id"]: r for r in inventory.download(small, str(tmp_path), get, tries=2, wait=0).collect()}
    assert {k: r["status"] for k, r in got.items()} == {"10abc": "downloaded", "11abc": "error:OSError", "12abc": "downloaded"}
    again = {r["pdb_id"]: r["status"] for r in inventory.download(small, str(tmp_path), get, tries=1, wait=0).collect()}
    assert again["10abc"] == "cached" and got["10abc"]["sha256"]


def test_parquet_and_report(spark, tmp_path):
    df = spark.createDataFrame([(i, f"id{i}", None if i % 2 else 1.5) for i in range(20)], "row_index long, id string, v double")
    writers.write_split(df.orderBy(F.desc("row_index")), str(tmp_path / "p"), as_text=True)
    back = spark.read.parquet(str(tmp_path / "p"))
    assert {t for _, t in back.dtypes} == {"string"} and back.filter("v = ''").count() == 10
    assert json.loads(writers.schema_text(df))["fields"][0]["name"] == "row_index"
    writers.write_report(spark, str(tmp_path / "r.json"), {"n": 1})
    assert json.loads((tmp_path / "r.json").read_text())["n"] == 1


def test_streams(spark, tmp_path):
    t = datetime(2025, 1, 1)
    good = "ACDEFGHIKL" * 4
    data = [(f"r{i}", good if i % 3 else None, good, "m", "xray", 1.0, t + timedelta(days=i)) for i in range(20)]
    schema = "id string, aa string, three_di string, method string, method_category string, resolution double, loaded_at timestamp"
    spark.createDataFrame(data[:12], schema).coalesce(1).write.parquet(str(tmp_path / "d"))
    spark.createDataFrame(data[8:], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "d"))
    s = deliveries.read_deliveries(spark, str(tmp_path / "d"), 1)
    got = deliveries.run_available(deliveries.reason_counts(s), "counts")
    assert got.agg(F.sum("n")).first()[0] == 24 and got.filter("reason = 'missing_aa'").agg(F.sum("n")).first()[0] == sum(x[1] is None for x in data[:12] + data[8:])
    first = deliveries.run_available(deliveries.first_deliveries(s, ["id"]), "first", "append")
    assert first.count() == 20 and first.select("id").distinct().count() == 20


def test_late_rows_drop_out_of_closed_periods(spark, tmp_path):
    t = datetime(2025, 1, 2)
    schema = "id string, aa string, three_di string, method string, method_category string, resolution double, loaded_at timestamp"
    for n, days in enumerate(([0, 1, 8], [60, 61], [62], [2, 3, 63], [200])):
        df = spark.createDataFrame([(f"r{n}{d}", None, None, "m", "xray", 1.0, t + timedelta(days=d)) for d in days], schema)
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "d"))
        spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "dx"))  # a sibling no stream may read
        import time

        time.sleep(1.1)  # a stream takes files by age
    s = deliveries.read_deliveries(spark, str(tmp_path / "d"), 1)
    got = deliveries.run_available(deliveries.reason_counts(s, lateness="10 days"), "late", "append")
    # rows of days 2 and 3 come after the watermark has passed their period; the last one's is open
    assert got.agg(F.sum("n")).first()[0] == 7 and got.columns == ["period_start", "reason", "n"]


def test_structure_files_are_handed_on_in_bounded_pieces():
    import pandas as pd

    files = [b"data_x\n_exptl.method 'X-RAY DIFFRACTION'\n", b"", b"broken", gzip.compress(b"data_y\n#\n"), b"\x1f\x8bcut"]
    pdf = pd.DataFrame({"path": [f"/a/{i}abc.cif.gz" for i in range(5)], "content": files})
    whole, pieces = list(mmcif._parse_files(iter([pdf]))), list(mmcif._parse_files(iter([pdf]), most=1))
    assert len(whole) == 1 and len(pieces) == 4 and list(mmcif._parse_files(iter([pdf.head(0)]))) == []
    pd.testing.assert_frame_equal(pd.concat(pieces, ignore_index=True), whole[0])
    assert list(whole[0]["error_type"].notna()) == [False, True, True, False, True] and whole[0]["methods"][0] == ["X-RAY DIFFRACTION"]
