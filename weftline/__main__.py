"""python -m weftline COMMAND ...: the build's stages over files. Submit with spark-submit for a cluster's settings."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import audit, validate
from .plans import pipeline
from .sources import inventory, mmcif, readers, release, writers


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="weftline")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, *flags: str, **more) -> argparse.ArgumentParser:
        c = sub.add_parser(name)
        for f in flags:
            c.add_argument(f"--{f}", required=True)
        for f, default in more.items():
            c.add_argument(f"--{f.replace('_', '-')}", default=default, type=type(default) if default is not None else str)
        return c

    command("source-discover", "url", "query", "out", page_size=10_000)
    command("source-download", "ids", "base", "root", "out", shards=1, index=0, limit=0)
    command("source-verify", "ids", "log", "out")
    command("candidates", "aa", "three-di", "structures", "out")
    command("annotations", "records", "structures", "out", mapping=None)
    command("header-keys", "data", "index", "out")
    command("fasta-shards", "fasta", "out", per_shard=50_000)
    command("clusters", "records", "out", column="aa", fident=0.30, cov=0.80)
    command("build-versions", "records", "annotations", "first", "clusters", "structure-clusters", "keys", "domains", "out", test_groups=1000, valid_groups=1000, structure_test_groups=500, structure_valid_groups=500, seed=42, mode="hash")
    command("export-versions", "records", "annotations", "keys", "versions", "out")
    command("validate-versions", "versions", "exported", "out", sums=None, expected=None)
    command("release", "exported", "state", "report", "out", valid_count=1000, test_count=1000)
    command("split", "records", "out", clusters=None, test_groups=1000, valid_groups=1000, seed=42, mode="hash")
    command("repair", "records", "split", "out", hits=None, test_count=1000, max_rounds=20)
    command("export", "records", "selected", "out")
    command("validate", "records", "out")
    command("report", "selected", "out", hits=None)
    a = p.parse_args(args)
    spark = SparkSession.builder.appName(f"weftline {a.command}").getOrCreate()
    table = spark.read.parquet

    def names(folder: str) -> list[str]:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        return sorted(f.getPath().getName() for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path) if f.isDirectory())

    if a.command == "source-discover":
        inventory.discover(spark, inventory.posted(a.url, release.read_json(spark, a.query)), a.page_size).orderBy("pdb_id").write.mode("overwrite").text(a.out)
    elif a.command == "source-download":
        ids = inventory.shard_rows(readers.read_ids(spark, a.ids).select(F.col("id").alias("pdb_id")), a.shards, a.index, a.limit or None)
        writers.write_tsv(inventory.download(ids, a.root, inventory.opened(a.base)), a.out)
        validate.require(readers.read_tsv(spark, a.out).filter("status not in ('cached', 'downloaded')"), "failed downloads")
    elif a.command == "source-verify":
        found = inventory.verify(readers.read_ids(spark, a.ids).select(F.col("id").alias("pdb_id")), readers.read_tsv(spark, a.log))
        writers.write_report(spark, a.out, found)
        release.gate(downloads=found["status"] == "passed")
    elif a.command == "header-keys":
        readers.read_header_keys(spark, a.data, a.index).write.mode("overwrite").parquet(a.out)
    elif a.command == "fasta-shards":
        writers.write_fasta_shards(readers.read_fasta(spark, a.fasta), a.out, "id", "sequence", a.per_shard)
    elif a.command == "clusters":
        pipeline.cluster_records(table(a.records), a.column, a.fident, a.cov).write.mode("overwrite").option("sep", "\t").csv(a.out)
    elif a.command == "build-versions":
        clusters, folds = readers.read_clusters(spark, a.clusters), readers.read_clusters(spark, a.structure_clusters)
        built = pipeline.build_versions(table(a.records), table(a.annotations), table(a.first), clusters, folds, table(a.keys), readers.read_topologies(spark, a.domains), (a.test_groups, a.valid_groups), (a.structure_test_groups, a.structure_valid_groups), a.seed, a.mode)
        for version, frames in built.items():
            for name, df in frames.items():
                df.write.mode("overwrite").parquet(f"{a.out}/{version}/{name}")
    elif a.command == "export-versions":
        for version in names(a.versions):
            release.stage(spark, pipeline.export_version(table(f"{a.versions}/{version}/selected"), table(a.records), table(a.annotations), table(a.keys)), f"{a.out}/{version}")
    elif a.command == "validate-versions":
        versions = {v: (table(f"{a.versions}/{v}/selected"), {n: table(f"{a.exported}/{v}/{n}") for n in names(f"{a.exported}/{v}")}) for v in names(a.versions)}
        writers.write_report(spark, a.out, pipeline.validate_versions(spark, versions, release.read_json(spark, a.expected) if a.expected else None, a.sums))
    elif a.command == "release":
        state, told = release.read_json(spark, a.state), release.read_json(spark, a.report)
        audit_ = told["audit"] if isinstance(told["audit"], dict) else {}
        gates = {"repair": state["status"] == "sequence_audit_passed", "audit": audit_.get("n_violations") == 0, "valid": told["counts"].get("valid") == a.valid_count, "test": told["counts"].get("test") == a.test_count}
        frames = {n: table(f"{a.exported}/{n}").withColumn("row_index", F.col("row_index").cast("long")) for n in ("train", "validation", "test")}
        release.stage(spark, frames, a.out, card="\n".join(f"{k}: {v}" for k, v in sorted(told["counts"].items())) + "\n", gates=gates)
    elif a.command == "candidates":
        c = pipeline.candidates(readers.read_fasta(spark, a.aa), readers.read_fasta(spark, a.three_di), mmcif.files(spark, a.structures))
        c.write.mode("overwrite").parquet(f"{a.out}/all")
        c = table(f"{a.out}/all")
        c.filter("reason is null").drop("reason").write.mode("overwrite").parquet(f"{a.out}/records")
        writers.write_tsv(c.filter("reason is not null").select("id", "reason"), f"{a.out}/excluded")
        writers.write_tsv(c.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).count().orderBy("reason"), f"{a.out}/counts")
    elif a.command == "annotations":
        mapping = pipeline.external_mappings(spark, a.mapping, table(a.records)) if a.mapping else None
        pipeline.annotations(table(a.records), mmcif.files(spark, a.structures), mapping).write.mode("overwrite").parquet(a.out)
    elif a.command == "split":
        r = table(a.records)
        clusters = readers.read_clusters(spark, a.clusters) if a.clusters else None
        for name, df in pipeline.split(r, pipeline.sequence_groups(r, clusters), a.test_groups, a.valid_groups, seed=a.seed, mode=a.mode).items():
            df.write.mode("overwrite").parquet(f"{a.out}/{name}")
    elif a.command == "repair":
        m = table(f"{a.split}/membership").select("id", F.col("component").alias("merged_group"), "split")
        members = m.drop("split").join(table(a.records).select("id", "length", "quality_score"), "id")
        at = lambda n: f"{a.out}/rounds/{n:04d}"
        n = 0
        while readers.exists(spark, f"{at(n + 1)}/done"):
            n += 1
        if n:
            rounds = [json.loads(r["rounds"]) for r in table(f"{at(n)}/done").orderBy("n").collect()]
            state, first = audit.RepairState(table(f"{at(n)}/selected"), table(f"{at(n)}/blocked"), table(f"{at(n)}/order"), rounds), table(f"{at(n)}/initial_eval")
        else:
            state = audit.RepairState(table(f"{a.split}/selected"), m.select("merged_group").limit(0), audit.initial_order(m))
            first = m.filter("split in ('valid', 'test')").select("merged_group").distinct()
        # given hits are an audit of the last round's selection and serve one round; without them every round audits itself
        for _ in range(1 if a.hits else a.max_rounds):
            n += 1
            hits = readers.read_hits(spark, a.hits) if a.hits else pipeline.own_hits(table(a.records), state.selected)
            state = audit.repair_round(hits, members, state, a.test_count)
            frames = {"selected": state.selected, "blocked": state.blocked, "order": state.order, "initial_eval": first, "membership": audit.repaired_membership(members, state, first), "excluded": audit.repaired_excluded(members, state, first)}
            for name, df in frames.items():
                df.write.mode("overwrite").parquet(f"{at(n)}/{name}")
            spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(state.rounds)], "n int, rounds string").write.mode("overwrite").parquet(f"{at(n)}/done")
            state = audit.RepairState(*(table(f"{at(n)}/{name}") for name in ("selected", "blocked", "order")), state.rounds, state.status)
            if state.status == "sequence_audit_passed":
                break
        for name in ("selected", "membership", "excluded"):
            table(f"{at(n)}/{name}").write.mode("overwrite").parquet(f"{a.out}/{name}")
        writers.write_report(spark, f"{a.out}/state.json", {"status": state.status, "rounds": state.rounds})
        if not a.hits:
            release.gate(repair=state.status == "sequence_audit_passed")
    elif a.command == "export":
        frames = pipeline.export(table(a.selected), table(a.records))
        pipeline.validate_export(frames, table(a.records))
        release.stage(spark, frames, a.out)
    elif a.command == "validate":
        frames = {n: table(f"{a.out}/{n}").withColumn("row_index", F.col("row_index").cast("long")) for n in ("train", "validation", "test")}
        pipeline.validate_export(frames, table(a.records))
    elif a.command == "report":
        writers.write_report(spark, a.out, pipeline.report(spark, table(a.selected), readers.read_hits(spark, a.hits) if a.hits else None))


if __name__ == "__main__":
    main()
