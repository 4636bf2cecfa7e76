"""The registered groups join chains by every key of the reference, over a small fixture."""

from weftline.plans import queries


def test_groups_join_by_cluster_and_accession(spark, tmp_path):
    rows = [(f"{i}ABC_A", f"{i}ABC", "ACDEFGHIKL"[i - 1 :] * 5, "2024-01-01") for i in range(1, 6)]
    spark.createDataFrame(rows, "id string, pdb_id string, aa string, loaded_at string").write.parquet(f"{tmp_path}/records.parquet")
    named = {"1ABC_A": "P1", "2ABC_A": "P2;P1"}
    spark.createDataFrame([(r[0], "2024-01-01", named.get(r[0], ""), "", "") for r in rows], "id string, loaded_at string, sifts_uniprot_ids string, native_uniprot_ids string, sifts_pfam_ids string").write.parquet(f"{tmp_path}/record_annotations.parquet")
    spark.createDataFrame([("3ABC_A", "3ABC_A"), ("4ABC_A", "3ABC_A")], "id string, merged_group string").write.parquet(f"{tmp_path}/cluster_membership.parquet")
    d = str(tmp_path)
    sizes = {r["id"][0]: r["group_size"] for r in queries.group_sizes_weights(spark, d).collect()}
    assert sizes == {"1": 2, "2": 2, "3": 2, "4": 2, "5": 1}
    overlay = {r["id"][0]: r["component"] for r in queries.components_overlay(spark, d).collect()}
    assert overlay["1"] == overlay["2"] and overlay["3"] == overlay["4"] and len(set(overlay.values())) == 3
    first = {r["id"][0]: r["component"] for r in queries._labels(spark, d, queries._sequence_edges(spark, d, accessions=False)).collect()}
    assert first["3"] == first["4"] and len(set(first.values())) == 4
