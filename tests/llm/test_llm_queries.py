import os

import pytest
from compare import FOLDER, both

from weftline.llm import queries, tokens


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    got, want = both(spark, queries.QUERIES[name], queries.SQL[name])
    assert got == want


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")
def test_containers_hold_every_token_once(spark):
    rows = queries.p6_containers(spark, FOLDER).toPandas()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").toPandas()
    assert set(rows["doc_id"]) == set(docs["doc_id"]) and rows.groupby("container")["n_tokens"].sum().max() <= 8192
    assert (rows.groupby("doc_id")["piece"].count() == rows.groupby("doc_id")["n_pieces"].first()).all()


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")
def test_containers_keep_sources_and_papers_apart(spark):
    rows = queries.p6_containers(spark, FOLDER).toPandas()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "paper_id", tokens.source_key("source").alias("source")).toPandas()
    rows = rows.merge(docs, on="doc_id")
    for a, b in queries._APART:
        per = rows.groupby("container")["source"].agg(set)
        assert not any({a, b} <= s for s in per)
    whole = rows[(rows["n_pieces"] == 1) & rows["paper_id"].notna()]
    assert whole.groupby(["container", "paper_id"]).size().max() == 1
    cut = {r["doc_id"] for r in queries.p6_found(spark, FOLDER).collect()}
    assert cut == set(rows[rows["n_pieces"] > 1]["doc_id"])
