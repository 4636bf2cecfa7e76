"""Two runs of the repair command: the second keeps the first's blocked groups and order."""

from weftline import __main__ as command


def test_blocked_groups_stay_blocked_in_the_next_round(spark, tmp_path):
    ids = ["v", "t", *"abcdef"]
    split = {"v": "valid", "t": "test"}
    spark.createDataFrame([(i, 50, 1.0) for i in ids], "id string, length int, quality_score double").write.parquet(f"{tmp_path}/records")
    spark.createDataFrame([(i, i, split.get(i, "train")) for i in ids], "id string, component string, split string").write.parquet(f"{tmp_path}/split/membership")
    spark.createDataFrame([(i, split.get(i, "train")) for i in ids], "id string, split string").write.parquet(f"{tmp_path}/split/selected")

    def run(*pairs):
        hits = tmp_path / "hits.tsv"
        hits.write_text("".join(f"{q}\t{t}\t0.9\t50\t0.9\t0.9\t0\t9\n" for q, t in pairs))
        command.main(["repair", "--records", f"{tmp_path}/records", "--split", f"{tmp_path}/split", "--hits", str(hits), "--out", f"{tmp_path}/out", "--test-count", "1"])
        return {r["id"]: r["split"] for r in spark.read.parquet(f"{tmp_path}/out/selected").collect()}, {r["id"]: r["split"] for r in spark.read.parquet(f"{tmp_path}/out/membership").collect()}

    one, _ = run(("v", "t"), *(("v", x) for x in "abc"))
    test = next(i for i, s in one.items() if s == "test")
    assert test in "def" and not {"t", "a", "b", "c"} & one.keys()
    two, members = run(("v", test))
    again = next(i for i, s in two.items() if s == "test")
    assert again in "def" and again != test and not {"t", "a", "b", "c", test} & two.keys()
    assert all(members[x] == "sequence_audit_removed" for x in ("t", "a", "b", "c", test)) and members[again] == "test"
