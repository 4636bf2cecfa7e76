"""Queries over files that Spark writes from the given tables and the readers bring back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import canonical_id, components
from ..functions.sequences import multi_value
from ..operators import annotate, edges, quality
from ..session import Scratch, count_rows
from ..sources import mmcif, readers, writers
from . import pipeline
from .oracle import _ACC, _ANN, _COMPLETE_ORDER, _DELIVERED, _FITS, _HIT, _JOINED, _MEM, _PERIODS, _RANKED, _REC, _SEQUENCE_EDGES, _USABLE, _components, _id
from .queries import _EVAL, _annotations, _delivered, _hits, _membership, _read, _records


def _lines(df: DataFrame, path: str, *cols: Column | str) -> str:
    """Rows as lines of tab-separated text without a header, null as an empty field."""
    text = (F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in cols)
    df.select(F.concat_ws("\t", *text).alias("value")).write.text(path)
    return path


def hits_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Hits as text without a header; rows that lack a number drop out as they are read. NaN is -1 here."""
    path = _lines(_read(spark, d, "sequence_hits"), f"{Scratch(spark, 'hits-text').folder}/hits", *readers.HITS[:8])
    h = readers.read_hits(spark, path)
    known = lambda c: F.coalesce(F.nanvl(c, F.lit(-1.0)), F.lit(-1.0)).alias(c)
    return h.select("query_id", "target_id", *(known(c) for c in ("fident", "qcov", "tcov", "evalue", "bits")))


def clusters_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Delivered groups as cluster rows, read again as edges between records."""
    m = _read(spark, d, "cluster_membership").filter("id is not null and merged_group is not null")
    path = _lines(m, f"{Scratch(spark, 'cluster-text').folder}/clusters", canonical_id("merged_group"), canonical_id("id"))
    ids = _read(spark, d, "records").filter("id is not null").select(canonical_id("id").alias("id"))
    return edges.cluster_edges(readers.read_clusters(spark, path, strict=True), ids)


def ids_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Ids as a list, one a line: numbers run from 0 without gaps."""
    ids = _read(spark, d, "records").filter("id is not null")
    path = _lines(ids, f"{Scratch(spark, 'id-text').folder}/ids", "id")
    return readers.read_ids(spark, path).agg(count_rows().alias("n"), F.min("row_index").cast("long").alias("low"), F.max("row_index").cast("long").alias("high"), F.count_distinct("row_index").alias("n_numbers"), F.count_distinct("id").alias("n_ids"))


def mapping_tables(spark: SparkSession, d: str) -> DataFrame:
    """Accessions and domains of chains as mapping tables; the Pfam table is missing. The ids of each chain of records."""
    s = Scratch(spark, "mappings")
    a = _annotations(spark, d, "sifts_uniprot_ids", "sifts_cath_ids").select(components("id").alias("c"), "sifts_uniprot_ids", "sifts_cath_ids")
    for name, ids, column in (("pdb_chain_uniprot.csv", "sifts_uniprot_ids", "SP_PRIMARY"), ("pdb_chain_cath_uniprot.csv", "sifts_cath_ids", "CATH_ID")):
        a.select(F.lower("c.pdb_id").alias("PDB"), F.col("c.chain").alias("CHAIN"), F.explode(multi_value(ids)).alias(column)).write.option("header", "true").csv(f"{s.folder}/{name}")
    return pipeline.external_mappings(spark, s.folder, _read(spark, d, "records").filter("id is not null").select(canonical_id("id").alias("id")))


def topology_edges(spark: SparkSession, d: str) -> DataFrame:
    """A domain list with a comment and short rows, read as topologies; chains of one topology are linked."""
    domains = _annotations(spark, d, "sifts_cath_ids").select("id", F.explode(multi_value("sifts_cath_ids")).alias("d"))
    code = F.md5(F.lower("d"))
    parts = [F.lit(text) if text else F.substring(code, i, 1) for i, text in ((1, ""), (2, ""), (3, ""))]
    line = F.concat_ws("  ", F.upper("d"), *parts, F.lit("10"))
    listed = domains.select("d").distinct().select(F.explode(F.array(line, F.concat(F.lit("# "), line), F.concat_ws(" ", F.col("d"), F.lit("1"), F.lit("2")))).alias("value"))
    path = f"{Scratch(spark, 'domain-text').folder}/domains"
    listed.write.text(path)
    t = domains.select("id", F.lower("d").alias("domain")).join(readers.read_topologies(spark, path), "domain")
    return edges.bucket_edges(t.select("id", "topology").distinct(), "topology")


def fasta_shards(spark: SparkSession, d: str) -> DataFrame:
    """Sequences in blocks of 500, one folder a block, and what is read back from all of them."""
    path = f"{Scratch(spark, 'shards').folder}/aa"
    n = writers.write_fasta_shards(_records(spark, d, "aa").filter("aa is not null"), path, "id", "aa", 500)
    back = readers.read_fasta(spark, f"{path}/*")
    return n.join(back, "id").select("id", F.col("row_index").cast("long").alias("row_index"), F.col("shard").cast("long").alias("shard"), F.sha2("sequence", 256).alias("sha256"))


def released_text(spark: SparkSession, d: str) -> DataFrame:
    """Annotations written in id order with every column as text, and read again."""
    a = _annotations(spark, d, "release_date", "assembly_count", "sifts_pfam_ids")
    path = f"{Scratch(spark, 'release-text').folder}/annotations"
    writers.write_split(a, path, as_text=True, order="id")
    return spark.read.parquet(path)


def version_export(spark: SparkSession, d: str) -> DataFrame:
    """The released splits joined with records, annotations and structure keys; only ids all three know."""
    s = Scratch(spark, "export")
    r = s.write(_records(spark, d, "aa", "three_di", "method", "method_category", "resolution", "deposited_length", "coverage", "length"))
    a = s.write(_annotations(spark, d, "release_date", "sifts_pfam_ids"))
    known = r.filter("aa is not null").join(a.select("id"), "id", "left_semi").select("id")
    out = pipeline.export_version(s.write(_delivered(spark, d).join(known, "id", "left_semi")), r, a, known.select("id", F.md5("id").alias("key")))
    rows = None
    for name in ("train", "validation", "test"):
        part = out[name].join(out[f"{name}_structure_ids"].select("row_index", "pdb_id", "chain_id", "structure_key"), "row_index")
        part = part.select(F.lit(name).alias("table_name"), F.col("row_index").cast("long").alias("row_index"), "id", "pdb_id", "chain_id", "structure_key", F.sha2("sequence_aa", 256).alias("sha256"), "length", "release_date")
        rows = part if rows is None else rows.unionByName(part)
    return rows


def built_versions(spark: SparkSession, d: str) -> DataFrame:
    """The four versions of a release over annotated records: delivered groups as sequence clusters, strong hits in key space as structure clusters."""
    s = Scratch(spark, "built")
    a = s.write(_annotations(spark, d, "three_di_max_token_fraction", "backbone_complete_fraction", "internal_missing_residues", "release_date", "sifts_uniprot_ids", "native_uniprot_ids", "sifts_cath_ids"))
    r = s.write(_records(spark, d, "pdb_id", "aa", "resolution", "length", "quality_score").join(a.select("id"), "id", "left_semi"))
    clusters = _membership(spark, d).select(F.col("merged_group").alias("rep"), F.col("id").alias("member"))
    hits = _hits(spark, d).filter(quality.similarity_hit()).select(F.md5("query_id").alias("rep"), F.md5("target_id").alias("member")).distinct()
    domains = a.select(F.explode(multi_value(F.lower("sifts_cath_ids"))).alias("domain")).distinct()
    first = _delivered(spark, d).join(a.select("id"), "id", "left_semi")
    made = pipeline.build_versions(r, a, first, clusters, hits, r.select(F.md5("id").alias("key"), "id"), domains.withColumn("topology", F.substring(F.md5("domain"), 1, 3)), _EVAL, _EVAL)
    rows = None
    for name, frames in made.items():
        part = frames["selected"].select(F.lit(name).alias("version"), "id", "split")
        rows = part if rows is None else rows.unionByName(part)
    return rows


def _files(spark: SparkSession, d: str) -> DataFrame:
    """A structure file for each record (path, content), as mmcif.files reads them: its method and resolution, a protein and a
    nucleic entity, five atoms and a ligand, accessions, dates and assemblies. Records without a sequence give a file without a data block."""
    r = _records(spark, d, "aa", "method", "resolution").join(_annotations(spark, d, "deposition_date", "release_date", "r_work", "r_free", "assembly_count", "assembly_descriptions", "native_uniprot_ids"), "id", "left")
    chain = F.substr("id", F.lit(6))
    text = lambda c: F.coalesce(c.cast("string"), F.lit("?"))
    item = lambda name, c: F.concat(F.lit(f"{name} "), text(c), F.lit("\n"))
    quoted = lambda c: F.transform(c, lambda x: F.concat(F.lit("'"), x, F.lit("'")))

    def loop(names: list[str], rows: Column) -> Column:
        head = "loop_\n" + "".join(f"{n}\n" for n in names)
        return F.when(F.size(rows) > 0, F.concat(F.lit(head), F.array_join(rows, "\n"), F.lit("\n"))).otherwise(F.lit(""))

    res, acc = F.col("resolution"), multi_value("native_uniprot_ids")
    is_em = F.coalesce(F.col("method").contains("ELECTRON"), F.lit(False)) & ~F.coalesce(F.col("method").contains("X-RAY"), F.lit(False))
    last, alt = F.length("aa") + 1, F.when(F.length("aa") % 2 == 0, F.lit("A")).otherwise(F.lit("."))
    atom = lambda group, name, at, alt_, entity: F.concat_ws(" ", F.lit(group), F.lit(name), alt_, chain, entity, at.cast("string"), F.lit("7 ? 0.50 12.5 1"))
    first, no = F.lit(1), F.lit(".")
    atoms = F.array(*(atom("ATOM", a, first, alt, chain) for a in ("N", "CA", "C", "O")), atom("ATOM", "CA", last, no, chain), atom("HETATM", "CA", last + 1, no, F.concat(chain, F.lit("n"))))
    body = F.concat(
        F.lit("data_made\n#\n"),
        loop(["_exptl.method"], quoted(multi_value("method"))),
        F.when(is_em, item("_em_3d_reconstruction.resolution", res)).otherwise(loop(["_refine.ls_d_res_high"], F.array(text(res + 1), text(res), F.lit("?")))),
        loop(["_entity_poly.entity_id", "_entity_poly.type", "_entity_poly.pdbx_seq_one_letter_code_can"],
             F.array(F.concat(chain, F.lit(" 'polypeptide(L)'\n;"), F.regexp_replace("aa", "(.{60})", "$1\n"), F.lit("(MSE)\n;")), F.concat(chain, F.lit("n polyribonucleotide ACGU")))),
        loop([mmcif.ATOM[c] for c in ("group", "atom", "alt", "chain", "entity", "label_seq", "auth_seq", "ins", "occupancy", "b_factor", "model")], atoms),
        # the first accession stands only in the reference its row names
        loop(list(mmcif.LOOPS["ref_seq"].values()), F.transform(acc, lambda x, i: F.concat(chain, i.cast("string"), F.lit(" "), F.when(i == 0, F.lit("?")).otherwise(x), F.lit(" "), chain))),
        loop(list(mmcif.LOOPS["refs"].values()), F.transform(acc, lambda x, i: F.concat(chain, i.cast("string"), F.lit(" UNP "), x))),
        item(mmcif.LISTS["deposited"], F.col("deposition_date")),
        loop([mmcif.LISTS["revised"]], F.when(F.col("release_date").isNull(), F.array(F.lit("?"))).otherwise(F.array(F.lit("2099-01-01"), F.col("release_date")))),
        item(mmcif.LISTS["work"], F.col("r_work")), item(mmcif.LISTS["free"], F.col("r_free")),
        loop([mmcif.LISTS["assembly"]], F.when(F.col("assembly_count") > 0, F.sequence(F.lit(1), F.col("assembly_count"))).otherwise(F.array()).cast("array<string>")),
        loop([mmcif.LISTS["details"]], quoted(multi_value("assembly_descriptions"))),
    )
    return r.select(F.concat("id", F.lit(".cif.gz")).alias("path"), F.encode(F.when(F.col("aa").isNull(), F.lit("empty")).otherwise(body), "UTF-8").alias("content")).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path")


def structure_metadata(spark: SparkSession, d: str) -> DataFrame:
    m = mmcif.read_metadata(_files(spark, d))
    return m.select(F.replace("file", F.lit(".cif.gz"), F.lit("")).alias("id"), "method", "category", "resolution", "error_type")


def structure_chains(spark: SparkSession, d: str) -> DataFrame:
    """Entity, deposited length and completeness of every chain."""
    parsed = Scratch(spark, "structures").write(mmcif.parsed(_files(spark, d)))
    entities, atoms = mmcif.read_entities(parsed), mmcif.read_atoms(parsed)
    rolled = annotate.chains(annotate.residues(atoms, ["pdb_id", "chain"]), ["pdb_id", "chain"])
    j = mmcif.chain_entities(atoms, entities).join(entities, ["pdb_id", "entity"]).join(rolled, ["pdb_id", "chain"])
    return j.select(F.concat_ws("_", "pdb_id", "chain").alias("id"), "entity", "deposited_length", "observed_ca_residues", "complete_backbone_residues", "mean_ca_occupancy", "mean_ca_b_factor", "alternate_location_residues",
                    F.col("internal_missing_residues").cast("long").alias("internal_missing_residues"), annotate.terminal_missing().cast("long").alias("terminal_missing_residues"))


def structure_entries(spark: SparkSession, d: str) -> DataFrame:
    """Dates, R factors (-1 where unknown) and assemblies of every file."""
    known = lambda c: F.coalesce(F.nanvl(c, F.lit(-1.0)), F.lit(-1.0)).alias(c)
    return mmcif.read_entry(_files(spark, d)).select("pdb_id", "deposition_date", "release_date", known("r_work"), known("r_free"), "assembly_count", "assembly_descriptions")


def structure_accessions(spark: SparkSession, d: str) -> DataFrame:
    """Each chain's own accessions, or those of the references it names."""
    parsed = Scratch(spark, "structures").write(mmcif.parsed(_files(spark, d)))
    return annotate.native_accessions(*mmcif.read_references(parsed)).select(F.concat_ws("_", "pdb_id", "chain").alias("id"), "native_uniprot_ids")


QUERIES = {f.__name__: f for f in (
    hits_roundtrip, clusters_roundtrip, ids_roundtrip, mapping_tables, topology_edges, fasta_shards, released_text, version_export, built_versions, structure_metadata, structure_chains, structure_entries, structure_accessions,
)}

# as text: behind a null test on the scan, isnan is folded away by the column's statistics, which know no NaN
_KNOWN = lambda c: f"coalesce(case when {c}::varchar = 'nan' then -1 else {c} end, -1)"
_PARTS = lambda c: f"list_filter(list_transform(string_split({c}, ';'), lambda x: trim(x)), lambda x: x <> '')"
_JOIN = lambda c: f"array_to_string(list_sort(list_distinct({_PARTS(c)})), ';')"
_PDB, _CHAIN = "regexp_extract(id, '^([^_]+)_', 1)", "regexp_replace(id, '^[^_]+_(MODEL_[0-9]+_)?', '')"
_MAPPED = lambda c: f"(select {_PDB} as p, {_CHAIN} as c, array_to_string(list_sort(list(distinct v)), ';') as v from (select id, unnest({_PARTS(c)}) as v from ann) group by 1, 2)"
_CATEGORY = "case when method like '%X-RAY%' then 'xray' when method like '%ELECTRON%' then 'em' else 'other' end"
_ANNOTATED = _REC.replace("where rn = 1)", f"where rn = 1 and id in (select {_id('id')} from record_annotations where id is not null))")
_TOPOLOGY = f"top as (select distinct id, substr(md5(lower(d)), 1, 3) as topology from (select id, unnest({_PARTS('sifts_cath_ids')}) as d from ann) where id in (select id from rec))"
_STRUCTURE = f"{_SEQUENCE_EDGES} union all select q, t from hit where q in (select id from rec) and t in (select id from rec) union all select id, min(id) over (partition by topology) from top"


def _version(name: str, edges_: str) -> str:
    ranked = _RANKED.format(order=_COMPLETE_ORDER, table="full_", cond=f"{_USABLE} and {_FITS}", train=_USABLE)
    return f"""select '{name}' as version, id, split from (with recursive {_ANNOTATED}, {_ANN}, {_MEM}, {_ACC}, {_HIT}, {_TOPOLOGY}, {_JOINED}, {_components('comp', edges_)},
full_ as (select joined.*, comp.component from joined join comp using (id)), {ranked} select id, split from sel)"""


SQL = {
    "built_versions": f"""{_version('sequence', _SEQUENCE_EDGES)} union all {_version('structure', _STRUCTURE)} union all select 'time', id, split from (with {_ANNOTATED}, {_ANN}, {_JOINED}, {_PERIODS} select id, split from chrono)
union all select 'v1_1', id, split from (with {_DELIVERED}, {_ANN} select id, split from del where id in (select id from ann))""",
    "hits_roundtrip": f"select query_id, target_id, {', '.join(f'{_KNOWN(c)} as {c}' for c in ('fident', 'qcov', 'tcov', 'evalue'))}, coalesce(bits, -1)::double as bits from sequence_hits where fident is not null and qcov is not null and tcov is not null",
    "clusters_roundtrip": f"with ids as (select distinct {_id('id')} as id from records) select distinct {_id('merged_group')} as src, {_id('id')} as dst from cluster_membership where {_id('merged_group')} in (select id from ids where id is not null) and {_id('id')} in (select id from ids where id is not null)",
    "ids_roundtrip": "select count(*) as n, 0::bigint as low, count(*) - 1 as high, count(*) as n_numbers, count(distinct id) as n_ids from records where id is not null",
    "mapping_tables": f"""with {_ANN}, wanted as (select distinct {_PDB} as pdb_id, {_CHAIN} as chain_id from (select {_id('id')} as id from records where id is not null))
select pdb_id, chain_id, coalesce(u.v, '') as sifts_uniprot_ids, '' as sifts_pfam_ids, coalesce(t.v, '') as sifts_cath_ids
from wanted left join {_MAPPED('sifts_uniprot_ids')} u on u.p = pdb_id and u.c = chain_id left join {_MAPPED('sifts_cath_ids')} t on t.p = pdb_id and t.c = chain_id""",
    "topology_edges": f"""with {_ANN}, d as (select distinct id, md5(lower(d)) as m from (select id, unnest({_PARTS('sifts_cath_ids')}) as d from ann)), t as (select distinct id, substr(m, 1, 3) as topology from d)
select src, dst from (select id as src, min(id) over (partition by topology) as dst from t) where src <> dst""",
    "fasta_shards": f"with {_REC}, n as (select id, aa, row_number() over (order by id) - 1 as row_index from rec where aa is not null) select id, row_index, row_index // 500 as shard, sha256(aa) as sha256 from n",
    "released_text": f"with {_ANN} select id, coalesce(release_date, '') as release_date, coalesce(assembly_count::varchar, '') as assembly_count, coalesce(sifts_pfam_ids, '') as sifts_pfam_ids from ann",
    "version_export": f"""with {_REC}, {_ANN}, {_DELIVERED}, x as (select case del.split when 'valid' then 'validation' else del.split end as table_name, id, rec.aa, rec.length, ann.release_date from del join rec using (id) join ann using (id) where rec.aa is not null)
select table_name, row_number() over (partition by table_name order by id) - 1 as row_index, id, {_PDB} as pdb_id, {_CHAIN} as chain_id, md5(id) as structure_key, sha256(aa) as sha256, length, release_date from x""",
    "structure_metadata": f"""with {_REC} select id, case when aa is not null then coalesce(method, '') end as method, case when aa is not null then {_CATEGORY} end as category,
case when aa is not null and {_CATEGORY} <> 'other' and not isnan(resolution) then resolution end as resolution, case when aa is null then 'ValueError' end as error_type from rec""",
    "structure_chains": f"""with {_REC} select id, substr(id, 6) as entity, length(aa)::int + 1 as deposited_length, 2::bigint as observed_ca_residues, 1::bigint as complete_backbone_residues, 0.5::double as mean_ca_occupancy, 12.5::double as mean_ca_b_factor,
(length(aa) % 2 = 0)::bigint as alternate_location_residues, length(aa) - 1 as internal_missing_residues, 0::bigint as terminal_missing_residues from rec where aa is not null""",
    "structure_entries": f"""with {_REC}, {_ANN} select upper(substr(id, 1, 4)) as pdb_id, deposition_date, release_date, {_KNOWN('r_work')} as r_work, {_KNOWN('r_free')} as r_free, greatest(coalesce(assembly_count, 0), 0)::int as assembly_count,
coalesce({_JOIN('assembly_descriptions')}, '') as assembly_descriptions from rec left join (select id, deposition_date, release_date, r_work, r_free, assembly_count, assembly_descriptions from ann) using (id) where aa is not null""",
    "structure_accessions": f"with {_REC}, {_ANN} select id, {_JOIN('native_uniprot_ids')} as native_uniprot_ids from rec join (select id, native_uniprot_ids from ann) using (id) where aa is not null and len({_PARTS('native_uniprot_ids')}) > 0",
}
