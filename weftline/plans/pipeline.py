"""The stages of a dataset build: each takes and gives DataFrames and writes nothing by itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import components
from ..functions.sequences import coverage, multi_value, quality_score, requested_model, sequence_stats
from ..operators import annotate, audit, edges, quality, rank, similarity, splits, validate
from ..operators.components import connected_components
from ..session import Scratch
from ..sources import mmcif, readers


def candidates(aa: DataFrame, three_di: DataFrame, structures: DataFrame) -> DataFrame:
    """Records with `reason` (null: kept) from two sequence sets (id, sequence) and structure files (see mmcif.files).

    Sequences are paired by a full outer join; metadata, and the deposited length by way of chain and entity, by left
    joins. The chain is the text after the id's first underscore, so a chain of a numbered model has no entity.
    """
    pairs = aa.select("id", F.upper("sequence").alias("aa")).join(three_di.select("id", F.lower("sequence").alias("three_di")), "id", "full_outer")
    first = F.instr("id", "_")
    pairs = pairs.withColumn("pdb_id", F.substring_index("id", "_", 1)).withColumn("chain_id", F.substr("id", first + 1))
    structures = Scratch(aa.sparkSession, "parsed").write(mmcif.parsed(structures))
    meta = mmcif.read_metadata(structures).filter("error_type is null").select("pdb_id", "method", F.col("category").alias("method_category"), "resolution")
    entities = mmcif.read_entities(structures)
    chain = mmcif.chain_entities(mmcif.read_atoms(structures), entities).select("pdb_id", F.col("chain").alias("chain_id"), F.col("entity").alias("entity_id"))
    lengths = entities.groupBy("pdb_id", F.col("entity").alias("entity_id")).agg(F.max("deposited_length").alias("deposited_length"))
    j = pairs.join(meta, "pdb_id", "left").join(chain, ["pdb_id", "chain_id"], "left").join(lengths, ["pdb_id", "entity_id"], "left")
    j = j.withColumn("length", F.length("aa")).withColumn("coverage", coverage("length", "deposited_length")).withColumn("quality_score", F.round(quality_score("resolution"), 6))
    return j.select("id", "pdb_id", "chain_id", "entity_id", "method", "method_category", "resolution", "deposited_length", "coverage", "length", "quality_score", "aa", "three_di", quality.exclusion_reason().alias("reason"))


def annotations(records: DataFrame, structures: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """Completeness, dates and identifiers of every record from its structure file; mapping: (pdb_id, chain_id, and id columns)."""
    structures = Scratch(records.sparkSession, "parsed").write(mmcif.parsed(structures))
    part = records.select("id", "deposited_length", "three_di", components("id").alias("c")).select("id", "deposited_length", "three_di", F.col("c.pdb_id").alias("pdb_id"), requested_model("c.model").alias("model"), F.col("c.chain").alias("chain"))
    keys = ["pdb_id", "model", "chain"]
    atoms = mmcif.read_atoms(structures).join(part.select(*keys).distinct(), keys, "left_semi")
    rolled = annotate.chains(annotate.residues(atoms, keys), keys)
    seq, refs = mmcif.read_references(structures)
    out = part.join(rolled, keys, "left").join(mmcif.read_entry(structures), "pdb_id", "left").join(annotate.native_accessions(seq, refs), ["pdb_id", "chain"], "left")
    out = out.withColumn("terminal_missing_residues", annotate.terminal_missing()).withColumn("s", sequence_stats("three_di"))
    out = out.withColumns({"three_di_entropy_bits": F.col("s.entropy_bits"), "three_di_max_token_fraction": F.col("s.max_fraction"), "three_di_unique_tokens": F.col("s.symbols")})
    if mapping is not None:
        m = mapping.select(F.upper("pdb_id").alias("pdb_id"), F.col("chain_id").alias("chain"), *(c for c in mapping.columns if c not in ("pdb_id", "chain_id")))
        out = out.join(m, ["pdb_id", "chain"], "left")
    return out.drop("s", "three_di", "deposited_length", "first_position", "last_position").withColumnRenamed("chain", "chain_id").withColumnRenamed("model", "model_id")


#: The mapping tables, the field each gives, and the columns it may stand in.
MAPPINGS = (
    ("pdb_chain_uniprot.csv", "sifts_uniprot_ids", ("SP_PRIMARY", "UNIPROT")),
    ("pdb_chain_pfam.csv", "sifts_pfam_ids", ("PFAM_ID",)),
    ("pdb_chain_cath_uniprot.csv", "sifts_cath_ids", ("CATH_ID",)),
)


def external_mappings(spark: SparkSession, folder: str, records: DataFrame) -> DataFrame:
    """(pdb_id, chain_id, one column a mapping table): the different ids of the chains of records, sorted and joined by ";". A missing table adds none."""
    wanted = records.select(components("id").alias("c")).select(F.col("c.pdb_id").alias("PDB"), F.col("c.chain").alias("CHAIN")).distinct()
    out = wanted
    for name, field, columns in MAPPINGS:
        path = f"{folder.rstrip('/')}/{name}"
        if not readers.exists(spark, path):
            out = out.withColumn(field, F.lit(""))
            continue
        table = readers.read_csv(spark, path).withColumn("PDB", F.upper("PDB"))
        ids = annotate.mapped_ids(table, ["PDB", "CHAIN"], {field: [c for c in columns if c in table.columns]}, wanted)
        out = out.join(ids, ["PDB", "CHAIN"], "left").withColumn(field, F.coalesce(field, F.lit("")))
    return out.withColumnsRenamed({"PDB": "pdb_id", "CHAIN": "chain_id"})


def sequence_groups(records: DataFrame, clusters: DataFrame | None = None, accessions: DataFrame | None = None) -> DataFrame:
    """(id, component) over shared entries, equal sequences, cluster rows (rep, member) and accessions (id, joined by ";")."""
    r = records.withColumn("__digest", F.sha2("aa", 256))
    families = [edges.bucket_edges(r, "pdb_id"), edges.bucket_edges(r, "__digest")]
    if clusters is not None:
        families.append(edges.cluster_edges(clusters, records))
    if accessions is not None:
        families.append(edges.value_edges(accessions.select("id", multi_value("accessions").alias("__values")).join(records.select("id"), "id", "left_semi"), "__values"))
    return edges.label_vertices(records, connected_components(edges.union_edges(*families)))


def structure_groups(records: DataFrame, clusters: DataFrame, keys: DataFrame, domains: DataFrame, topologies: DataFrame) -> DataFrame:
    """(id, component) over structure clusters in key space (keys: key, id) and domains (id, joined by ";") of one topology."""
    translated = edges.translate_keys(clusters.select(F.col("rep").alias("src"), F.col("member").alias("dst")), keys)
    by_topology = domains.select("id", F.explode(multi_value("domains")).alias("d")).select("id", F.lower("d").alias("domain")).join(topologies, "domain").select("id", "topology")
    return edges.label_vertices(records, connected_components(edges.union_edges(edges.cluster_edges(translated, records, "src", "dst"), edges.bucket_edges(by_topology, "topology"))))


def overlay(records: DataFrame, *groups: DataFrame) -> DataFrame:
    """(id, component) of the finest grouping that joins what any of the given groupings joins."""
    return edges.label_vertices(records, connected_components(edges.union_edges(*(g.select(F.col("id").alias("src"), F.col("component").alias("dst")) for g in groups))))


def split(records: DataFrame, groups: DataFrame, test_groups: float = 1000, valid_groups: float = 1000, by: Column | None = None, usable: Column | None = None, seed: int = 42, mode: str = "hash", name: str = "sequence") -> dict[str, DataFrame]:
    """selected, membership and excluded of a grouped split; by: the order of representatives, highest quality unless given.
    With usable the membership has group sizes and sampling weights, its groups being called `<name>:<group>`."""
    order, fit = (rank.by_quality() if by is None else by), (quality.evaluation_length() if usable is None else usable & quality.evaluation_length())
    base = Scratch(records.sparkSession, "split-base").write(records.join(groups, "id"))
    selected, held = splits.grouped_split(base, test_groups, valid_groups, fit, order, usable, seed, mode)
    selected = Scratch(records.sparkSession, "split-selected").write(selected)
    members = splits.membership(base, selected, held) if usable is None else splits.weighted_membership(base, selected, held, name)
    return {"selected": selected, "membership": members, "excluded": splits.excluded(base, selected, held)}


def own_hits(records: DataFrame, selected: DataFrame, fident: float = 0.30, cov: float = 0.80) -> DataFrame:
    """Hits (query_id, target_id, fident, qcov, tcov) of valid and test against train and of valid against test, by the library's own similarity join over aa."""
    texts = Scratch(records.sparkSession, "splits").write(selected.select("id", "split").join(records.select("id", F.upper("aa").alias("seq")), "id"))
    side = lambda name: texts.filter(F.col("split") == name).select("id", "seq")
    parts = [similarity.similar_sequences(side(q), side(t), fident=fident, cov=cov) for q, t in (("valid", "train"), ("test", "train"), ("valid", "test"))]
    return Scratch(records.sparkSession, "hits").write(parts[0].unionByName(parts[1]).unionByName(parts[2]))


def export(selected: DataFrame, records: DataFrame) -> dict[str, DataFrame]:
    """train, validation and test with row_index in id order, id and both sequences. An id without a record, or in two splits, raises ValueError."""
    validate.require(validate.split_overlap(selected), "ids in several splits")
    rows = validate.required_join(selected.select("id", "split"), records.select("id", "three_di", "aa"))
    names = {"train": "train", "valid": "validation", "test": "test"}
    return {to: audit.number_rows(rows.filter(F.col("split") == of).select("id", F.col("three_di").alias("sequence_3di"), F.col("aa").alias("sequence_aa")), ["id"]) for of, to in names.items()}


def validate_export(exported: dict[str, DataFrame], records: DataFrame) -> None:
    """Raises ValueError unless indexes are contiguous, ids unique, splits disjoint, and rows equal to their records with both sequences of one length."""
    rows = None
    for name, df in exported.items():
        if not validate.contiguous(df).first()["contiguous"]:
            raise ValueError(f"{name}: row index is not contiguous")
        part = df.withColumn("split", F.lit(name))
        rows = part if rows is None else rows.unionByName(part)
    validate.require(validate.duplicate_keys(rows, "id"), "repeated ids")
    validate.require(rows.filter(F.length("sequence_aa") != F.length("sequence_3di")).select("id"), "unequal lengths")
    want = records.select("id", F.col("three_di").alias("d"), F.col("aa").alias("a"))
    bad = rows.join(want, "id", "left").filter(~F.col("d").eqNullSafe(F.col("sequence_3di")) | ~F.col("a").eqNullSafe(F.col("sequence_aa")))
    validate.require(bad.select("id"), "rows that differ from their records")


def build_versions(
    records: DataFrame, annotations: DataFrame, first: DataFrame, clusters: DataFrame, structure_clusters: DataFrame, keys: DataFrame, topologies: DataFrame,
    groups: tuple[float, float] = (1000, 1000), structure_groups_held: tuple[float, float] = (500, 500), seed: int = 42, mode: str = "hash",
) -> dict[str, dict[str, DataFrame]]:
    """Four versions by name, each with `selected` (id, split): v1_1 is the first release's (id, split) with its annotations;
    sequence and structure are splits of usable records over sequence groups and over these and structure groups
    together; time is split by release date, with novelty against train. groups: test and valid groups held out.

    A record without annotation, and an id of the first release without one, raise ValueError.
    """
    scratch = Scratch(records.sparkSession, "versions")
    more = annotations.drop(*(set(annotations.columns) & set(records.columns) - {"id"}))
    base = scratch.write(validate.required_join(records, more))
    accessions = base.select("id", F.coalesce(F.nullif("sifts_uniprot_ids", F.lit("")), "native_uniprot_ids").alias("accessions"))
    sequence = scratch.write(sequence_groups(base, clusters, accessions))
    structure = scratch.write(structure_groups(base, structure_clusters, keys, base.select("id", F.col("sifts_cath_ids").alias("domains")), topologies))
    both = scratch.write(overlay(base, sequence, structure))
    parts = {name: split(base, g, *held, rank.by_completeness(), quality.usable(), seed, mode, name) for name, g, held in (("sequence", sequence, groups), ("structure", both, structure_groups_held))}
    validate.require(validate.missing_keys(first, annotations), "no annotation for")
    time = scratch.write(splits.chronological_split(base.filter(quality.usable()), rank.by_completeness()))
    novel = splits.novelty(time, sequence, "sequence_novel").join(splits.novelty(time, structure, "structure_novel"), ["id", "split"]).join(base.select("id", "release_date"), "id")
    return {"v1_1": {"selected": first.select("id", "split"), "annotations": annotations.join(first.select("id"), "id", "left_semi")}, **parts, "time": {"selected": time, "novelty": novel}}


#: The record columns of a release, and the annotation columns it leaves out.
RELEASED = ("method", "method_category", "resolution", "deposited_length", "coverage", "length")
NOT_RELEASED = ("id", "pdb_id", "chain_id")


def export_version(selected: DataFrame, records: DataFrame, annotations: DataFrame, keys: DataFrame) -> dict[str, DataFrame]:
    """train, validation and test of (id, split) in id order with sequences, record and annotation columns, and
    `<name>_structure_ids` of each: the place of every id and its structure key (keys: id, key).

    Where both tables have a column, the annotation counts. An id that lacks a record, an annotation or a key, or that
    stands in two splits, raises ValueError.
    """
    validate.require(validate.split_overlap(selected), "ids in several splits")
    fields = [c for c in annotations.columns if c not in NOT_RELEASED]
    own = records.select("id", F.col("three_di").alias("sequence_3di"), F.col("aa").alias("sequence_aa"), *(c for c in RELEASED if c not in fields))
    rows = validate.required_join(validate.required_join(validate.required_join(selected.select("id", "split"), own), annotations.select("id", *fields)), keys.select("id", F.col("key").alias("__key")))
    columns = ["id", "sequence_3di", "sequence_aa", *RELEASED, *(c for c in fields if c not in RELEASED)]
    out = {}
    for of, to in (("train", "train"), ("valid", "validation"), ("test", "test")):
        n = audit.number_rows(rows.filter(F.col("split") == of).select(*columns, "__key"), ["id"])
        out[to] = n.select("row_index", *columns)
        c = components("id")
        out[f"{to}_structure_ids"] = n.select("row_index", F.lit(of).alias("split"), "id", c["pdb_id"].alias("pdb_id"), c["model"].alias("model_id"), c["chain"].alias("chain_id"), F.col("__key").alias("structure_key"))
    return out


def validate_versions(spark: SparkSession, versions: dict[str, tuple[DataFrame, dict[str, DataFrame]]], expected: dict[str, dict[str, int]] | None = None, sums: str | None = None) -> dict:
    """A report over versions (name -> selected, exported frames); the first fault raises ValueError.

    Ids stand in one split once; every split's rows and its structure ids run from 0 without gaps, in id order, and hold
    exactly its ids; counts are as expected; sequence and structure train sets differ; the files named in the manifest `SHA256SUMS` in
    the folder `sums` have its digests.
    """
    report: dict = {"status": "passed", "versions": {}, "mapping_checksums": {}}
    for name, (selected, frames) in versions.items():
        validate.require(validate.split_overlap(selected).select("id").unionByName(validate.duplicate_keys(selected, "id").select("id")), f"{name}: repeated ids")
        counts = {r["split"]: r["count"] for r in selected.groupBy("split").count().collect()}
        for of, to in (("train", "train"), ("valid", "validation"), ("test", "test")):
            ids = selected.filter(F.col("split") == of).select("id")
            want = audit.number_rows(ids, ["id"]).select(F.col("row_index").cast("long").alias("row_index"), "id")
            for table in (to, f"{to}_structure_ids"):
                validate.require(validate.same_rows(want, frames[table].select(F.col("row_index").cast("long").alias("row_index"), "id")), f"{name}, {table}: order or ids")
            if (n := (expected or {}).get(name, {}).get(of)) is not None and counts.get(of, 0) != n:
                raise ValueError(f"{name}, {of}: {counts.get(of, 0)} rows, not {n}")
        report["versions"][name] = counts
    if {"sequence", "structure"} <= versions.keys():
        trains = [versions[v][0].filter("split = 'train'").select("id") for v in ("sequence", "structure")]
        if validate.same_rows(*trains).isEmpty():
            raise ValueError("sequence and structure train sets are the same")
    if sums:
        lines = F.split(F.trim("value"), r"\s+", 2)
        want = spark.read.text(f"{sums.rstrip('/')}/SHA256SUMS").filter(F.trim("value") != "").select(F.ltrim(lines[1], F.lit("* ")).alias("name"), lines[0].alias("sha256"))
        have = readers.checksums(spark, sums).select(F.substring_index("path", "/", -1).alias("name"), F.col("sha256").alias("found"))
        j = want.join(have, "name", "left")
        validate.require(j.filter(~F.col("found").eqNullSafe(F.col("sha256"))).select("name"), "checksum mismatch")
        report["mapping_checksums"] = {r["name"]: r["sha256"] for r in j.collect()}
    return report


def cluster_records(records: DataFrame, column: str = "aa", fident: float = 0.30, cov: float = 0.80, shared: float = 0.0) -> DataFrame:
    """(rep, member) of records by their own similarity join and greedy set cover: aa for sequence, three_di with cov 0.5 for
    structure clusters. See similar_sequences for `shared`, without which every pair whose lengths fit is aligned."""
    texts = records.filter(F.col(column).isNotNull()).select("id", F.upper(column).alias("seq"))
    pairs = similarity.similar_sequences(texts, texts, shared=shared, fident=fident, cov=cov).filter("query_id < target_id")
    return similarity.set_cover_clusters(pairs.select(F.col("query_id").alias("src"), F.col("target_id").alias("dst")), records.select("id"))


def report(spark: SparkSession, selected: DataFrame, hits: DataFrame | None) -> dict:
    """Counts per split and the audit's figures, small enough for a JSON file; audit is "missing" without hits."""
    counts = {r["split"]: r["count"] for r in selected.groupBy("split").count().collect()}
    found = "missing" if hits is None else audit.audit_summary(hits).first().asDict()
    return {"counts": counts, "audit": found, "spark": spark.version}
