"""Queries over the given tables, one or more for each operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.formatting import python_format
from ..functions.ids import canonical_id, components, entry_key, letters
from ..functions.sequences import coverage, joined, method_category, multi_value, quality_score, sequence_stats, shard_path
from ..operators import annotate, audit, edges, quality, rank, similarity, skew, splits, validate
from ..operators.components import connected_components
from ..session import Scratch, count_rows
from ..sources import readers, writers
from ..streaming import deliveries


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _latest(rows: DataFrame, *cols: str) -> DataFrame:
    """Each id's latest delivered row."""
    return rows.filter("id is not null").groupBy("id").agg(F.max(F.struct("loaded_at", *cols)).alias("x")).select("id", *(f"x.{c}" for c in cols))


def _records(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    r = _read(spark, d, "records")
    text = {"aa": letters("aa"), "three_di": F.nullif(F.regexp_replace(F.lower("three_di"), "[^a-z]+", ""), F.lit("")), "pdb_id": entry_key("pdb_id", "id")}
    return _latest(r.select(canonical_id("id").alias("id"), "loaded_at", *(text.get(c, F.col(c)).alias(c) for c in cols)), *cols)


def _annotations(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    return _latest(_read(spark, d, "record_annotations").select(canonical_id("id").alias("id"), "loaded_at", *cols), *cols)


def _membership(spark: SparkSession, d: str) -> DataFrame:
    """Each id's smallest delivered group."""
    m = _read(spark, d, "cluster_membership").filter("id is not null and merged_group is not null")
    return m.groupBy(canonical_id("id").alias("id")).agg(F.min(canonical_id("merged_group")).alias("merged_group"))


def streamed_reason_counts(spark: SparkSession, d: str) -> DataFrame:
    """Delivered rows by week and exclusion reason, counted by a stream."""
    counts = deliveries.reason_counts(deliveries.read_deliveries(spark, f"{d}/records.parquet"))
    return deliveries.run_available(counts, "reasons").select(F.date_format("period_start", "yyyy-MM-dd").alias("period_start"), "reason", "n")


def streamed_first_deliveries(spark: SparkSession, d: str) -> DataFrame:
    """Chains as they are first delivered, repeats within the watermark dropped as they come: once each with every time of delivery."""
    stream = deliveries.read_deliveries(spark, f"{d}/records.parquet").filter("id is not null and loaded_at is not null").select(canonical_id("id").alias("id"), "loaded_at")
    rows = deliveries.run_available(deliveries.first_deliveries(stream.withColumn("at", F.col("loaded_at").cast("string")), ["id", "at"]), "first", "append")
    return rows.groupBy("id").agg(count_rows().alias("n_deliveries"), F.date_format(F.min("loaded_at"), "yyyy-MM-dd").alias("first_day"))


def _p3_inputs(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    r = _read(spark, d, "records").select(entry_key("pdb_id", "id").alias("key"), "resolution", "loaded_at")
    m = _read(spark, d, "cluster_membership").select(canonical_id(F.nullif(F.trim("merged_group"), F.lit(""))).alias("key"), F.col("selected_representative").alias("value"), canonical_id("id").alias("id"))
    return {
        "records.pdb_id": skew.per_key_summary(r, "key", "resolution", "loaded_at"),
        "cluster_membership.merged_group": skew.per_key_summary(m, "key", "value", "id"),
    }


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    parts = [skew.heavy_keys(s, 0.02).select(F.lit(name).alias("key_field"), F.col("key").alias("key_value")) for name, s in _p3_inputs(spark, d).items()]
    return parts[0].unionByName(parts[1])


def p3_summary(spark: SparkSession, d: str) -> DataFrame:
    """Counts and summaries of every entry and every group."""
    parts = [s.select(F.lit(name).alias("key_field"), F.col("key").alias("key_value"), "n_rows", "n_values", "low", "high", "n_orders") for name, s in _p3_inputs(spark, d).items()]
    return parts[0].unionByName(parts[1])


_QUALITY = ("pdb_id", "aa", "three_di", "method", "method_category", "resolution", "deposited_length", "length", "quality_score")


def _reasoned(spark: SparkSession, d: str) -> DataFrame:
    return _records(spark, d, *_QUALITY).withColumn("reason", quality.exclusion_reason())


def exclusion_reason_counts(spark: SparkSession, d: str) -> DataFrame:
    return _reasoned(spark, d).groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(count_rows().alias("n"))


def filter_totals(spark: SparkSession, d: str) -> DataFrame:
    return _reasoned(spark, d).agg(count_rows().alias("n_records"), F.count("aa").alias("n_aa"), F.count("three_di").alias("n_3di"), F.count_if(F.col("reason").isNull()).alias("n_kept"), F.count("reason").alias("n_excluded"), F.count_distinct("pdb_id").alias("n_entries"))


def kept_records(spark: SparkSession, d: str) -> DataFrame:
    k = _reasoned(spark, d).filter("reason is null")
    return k.select("id", F.length("aa").cast("int").alias("n"), coverage(F.length("aa"), "deposited_length").alias("coverage"), quality_score("resolution").alias("quality"))


def formatted_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Measures as text, rounded the way the release files round them."""
    return _records(spark, d, "resolution", "coverage").select("id", python_format(".3f")("resolution").alias("resolution"), python_format(".4f")("coverage").alias("coverage"))


def pairing_full_outer(spark: SparkSession, d: str) -> DataFrame:
    r, a = _read(spark, d, "records").select(canonical_id("id").alias("id")).distinct(), _read(spark, d, "record_annotations").select(canonical_id("id").alias("id")).distinct()
    return quality.pair(r, a).select("id", "pairing")


def id_components(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "records").filter("id is not null").select(canonical_id("id").alias("id")).distinct().select("id", components("id").alias("c")).select("id", "c.pdb_id", "c.model", F.col("c.chain").alias("chain"))


def sequence_complexity(spark: SparkSession, d: str) -> DataFrame:
    s = _records(spark, d, "three_di").select("id", sequence_stats("three_di").alias("s"))
    return s.filter("s is not null").select("id", F.round("s.entropy_bits", 6).alias("entropy_bits"), F.round("s.max_fraction", 6).alias("max_fraction"), "s.symbols")


def _annotated(spark: SparkSession, d: str, *more: str) -> DataFrame:
    r = _records(spark, d, "pdb_id", "aa", "resolution", "length", "quality_score")
    return r.join(_annotations(spark, d, "three_di_max_token_fraction", "backbone_complete_fraction", "internal_missing_residues", *more), "id", "left")


def usable_filter(spark: SparkSession, d: str) -> DataFrame:
    return _annotated(spark, d).select("id", quality.usable().alias("usable"), quality.evaluation_length().alias("fits_evaluation"))


def method_rollup(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "records").groupBy(method_category("method").alias("category"), "method").agg(count_rows().alias("n"))


def multivalue_mapping(spark: SparkSession, d: str) -> DataFrame:
    """Per entry the different Pfam and CATH ids of its chains in records."""
    a = _read(spark, d, "record_annotations").select(canonical_id("id").alias("id"), F.upper(F.substring("id", 1, 4)).alias("pdb_id"), "sifts_pfam_ids", "sifts_cath_ids")
    wanted = _read(spark, d, "records").select(canonical_id("id").alias("id")).distinct()
    long = a.join(wanted, "id", "left_semi").select("pdb_id", F.explode_outer(F.filter(F.array_union(F.transform(multi_value("sifts_pfam_ids"), lambda x: F.struct(F.lit("pfam").alias("k"), x.alias("x"))), F.transform(multi_value("sifts_cath_ids"), lambda x: F.struct(F.lit("cath").alias("k"), x.alias("x")))), lambda s: s["x"] != "")).alias("s"))
    return long.groupBy("pdb_id").agg(joined(F.when(F.col("s.k") == "pfam", F.col("s.x"))).alias("pfam_ids"), joined(F.when(F.col("s.k") == "cath", F.col("s.x"))).alias("cath_ids"))


def _accessions(spark: SparkSession, d: str) -> DataFrame:
    a = _annotations(spark, d, "sifts_uniprot_ids", "native_uniprot_ids")
    return a.select("id", multi_value(F.coalesce(F.nullif("sifts_uniprot_ids", F.lit("")), "native_uniprot_ids")).alias("accessions"))


def ref_accession_fallback(spark: SparkSession, d: str) -> DataFrame:
    return _accessions(spark, d).select("id", F.explode("accessions").alias("accession"))


def exact_duplicate_groups(spark: SparkSession, d: str) -> DataFrame:
    g = validate.duplicate_keys(_records(spark, d, "aa").filter("aa is not null").select(F.sha2("aa", 256).alias("digest")), "digest")
    return g


def dedupe_argmin(spark: SparkSession, d: str) -> DataFrame:
    return rank.dedupe_exact(_records(spark, d, "aa", "quality_score"), "aa", rank.by_quality()).select("id")


def group_representative(spark: SparkSession, d: str) -> DataFrame:
    r = _annotated(spark, d).join(_membership(spark, d), "id").filter(quality.usable() & quality.evaluation_length())
    return rank.representative(r, ["merged_group"], rank.by_completeness())


def _sequence_edges(spark: SparkSession, d: str, accessions: bool = True) -> DataFrame:
    """Chains of one cluster, entry or exact sequence, and of one accession except for the first split, which does not use these."""
    r = _records(spark, d, "pdb_id", "aa").withColumn("digest", F.sha2("aa", 256))
    ids = r.select("id")
    parts = [edges.cluster_edges(_membership(spark, d), ids, "merged_group", "id"), edges.bucket_edges(r, "pdb_id"), edges.bucket_edges(r, "digest")]
    if accessions:
        parts.append(edges.value_edges(_accessions(spark, d).join(ids, "id", "left_semi"), "accessions"))
    return edges.union_edges(*parts)


def _structure_edges(spark: SparkSession, d: str) -> DataFrame:
    """Chains that share a domain family."""
    a = _annotations(spark, d, "sifts_pfam_ids").join(_records(spark, d, "pdb_id").select("id"), "id", "left_semi")
    return edges.value_edges(a.select("id", multi_value("sifts_pfam_ids").alias("families")), "families")


def _labels(spark: SparkSession, d: str, e: DataFrame) -> DataFrame:
    return edges.label_vertices(_records(spark, d, "pdb_id"), connected_components(e))


def components_sequence(spark: SparkSession, d: str) -> DataFrame:
    return _labels(spark, d, _sequence_edges(spark, d))


def components_structure(spark: SparkSession, d: str) -> DataFrame:
    return _labels(spark, d, _structure_edges(spark, d))


def _overlay_edges(spark: SparkSession, d: str) -> DataFrame:
    """Both families at once: what either grouping joins, one run of components joins."""
    return edges.union_edges(_sequence_edges(spark, d), _structure_edges(spark, d))


def components_overlay(spark: SparkSession, d: str) -> DataFrame:
    return _labels(spark, d, _overlay_edges(spark, d))


def group_sizes_weights(spark: SparkSession, d: str) -> DataFrame:
    return rank.group_weights(_labels(spark, d, _sequence_edges(spark, d)))


#: Test and valid groups held out, as shares of the eligible ones.
_EVAL = (0.1, 0.1)


def _split(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    r = Scratch(spark, "base").write(_records(spark, d, "aa", "length", "quality_score").join(_labels(spark, d, _sequence_edges(spark, d, accessions=False)), "id"))
    selected, held = splits.grouped_split(r, *_EVAL, quality.evaluation_length(), rank.by_quality())
    return r, Scratch(spark, "selected").write(selected), held


def grouped_split(spark: SparkSession, d: str) -> DataFrame:
    return _split(spark, d)[1]


def split_membership(spark: SparkSession, d: str) -> DataFrame:
    return splits.membership(*_split(spark, d))


def split_excluded(spark: SparkSession, d: str) -> DataFrame:
    return splits.excluded(*_split(spark, d))


def split_counts(spark: SparkSession, d: str) -> DataFrame:
    return _split(spark, d)[1].groupBy("split").agg(count_rows().alias("n"))


def _quality_split(spark: SparkSession, d: str, e: DataFrame, name: str) -> DataFrame:
    r = Scratch(spark, "base").write(_annotated(spark, d).join(_labels(spark, d, e), "id"))
    selected, held = splits.grouped_split(r, *_EVAL, quality.usable() & quality.evaluation_length(), rank.by_completeness(), quality.usable())
    return splits.weighted_membership(r, selected, held, name)


def quality_split(spark: SparkSession, d: str) -> DataFrame:
    """The split by completeness over sequence groups: only usable records, with sampling weights."""
    return _quality_split(spark, d, _sequence_edges(spark, d), "sequence")


def structure_split(spark: SparkSession, d: str) -> DataFrame:
    """The same over the overlay of sequence and structure groups."""
    return _quality_split(spark, d, _overlay_edges(spark, d), "structure")


def _chronological(spark: SparkSession, d: str) -> DataFrame:
    return splits.chronological_split(_annotated(spark, d, "release_date").filter(quality.usable()), rank.by_completeness())


def chronological_split(spark: SparkSession, d: str) -> DataFrame:
    return _chronological(spark, d)


def novelty_labels(spark: SparkSession, d: str) -> DataFrame:
    s = Scratch(spark, "periods").write(_chronological(spark, d))
    one = splits.novelty(s, connected_components(_sequence_edges(spark, d)), "sequence_novel")
    two = splits.novelty(s, connected_components(_structure_edges(spark, d)), "structure_novel")
    return one.join(two, ["id", "split"])


def key_translation_edges(spark: SparkSession, d: str) -> DataFrame:
    """Strong hits between the delivered groups of their two ends."""
    h = _read(spark, d, "sequence_hits").filter(quality.similarity_hit()).select(canonical_id("query_id").alias("src"), canonical_id("target_id").alias("dst")).distinct()
    return edges.translate_keys(h, _membership(spark, d), "id", "merged_group").filter("src != dst").distinct()


def hits_audit(spark: SparkSession, d: str) -> DataFrame:
    return audit.audit_summary(_read(spark, d, "sequence_hits"))


def _delivered(spark: SparkSession, d: str) -> DataFrame:
    """The released splits as (id, split), each id in one split: evaluation first."""
    parts = [_read(spark, d, t).filter("id is not null").select(canonical_id("id").alias("id"), F.lit(n).alias("split")) for t, n in (("train", "train"), ("validation", "valid"), ("test", "test"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("id").agg(F.max("split").alias("split"))


def _hits(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "sequence_hits").select(canonical_id("query_id").alias("query_id"), canonical_id("target_id").alias("target_id"), "fident", "qcov", "tcov")


def cross_split_hits(spark: SparkSession, d: str) -> DataFrame:
    return audit.cross_split_hits(_hits(spark, d), _delivered(spark, d))


def _repair_start(spark: SparkSession, d: str) -> tuple[DataFrame, audit.RepairState]:
    s = Scratch(spark, "repair-start")
    members = s.write(_records(spark, d, "length", "quality_score").join(_membership(spark, d), "id"))
    selected = s.write(_delivered(spark, d).join(members.select("id"), "id", "left_semi"))
    placed = members.select("id", "merged_group").join(selected, "id").groupBy("merged_group").agg(F.max(F.col("split") == "train").alias("t"), F.max(F.col("split") != "train").alias("e"))
    order = audit.initial_order(placed.filter("t and not e").select("merged_group", F.lit("train").alias("split")))
    blocked = members.select("merged_group").limit(0)
    return members, audit.RepairState(selected, blocked, s.write(order))


def repair_round(spark: SparkSession, d: str) -> DataFrame:
    """The splits after one repair round; test is refilled to its size before, or as far as unused groups go: larger tables have too few."""
    members, state = _repair_start(spark, d)
    return audit.repair_round(_hits(spark, d), members, state, partly=True).selected


def repair_fixpoint(spark: SparkSession, d: str) -> DataFrame:
    """Membership once no hit crosses splits; what refills test is audited in the next round."""
    members, state = _repair_start(spark, d)
    start = state.selected.filter("split != 'train'").join(members.select("id", "merged_group"), "id").select("merged_group").distinct()
    hits = Scratch(spark, "hits").write(_hits(spark, d).filter(quality.similarity_hit()))
    state = audit.repair_to_fixpoint(lambda _: hits, members, state, partly=True)
    return audit.repaired_membership(members, state, start)


def residue_chain_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Line items as atoms: orders as chains, line numbers as residues, each line one atom; -1 where no CA atom is known."""
    atom = F.element_at(F.array(F.lit("N"), F.lit("CA"), F.lit("C"), F.lit("O")), (F.pmod("l_partkey", F.lit(4)) + 1).cast("int"))
    atoms = _read(spark, d, "lineitem").select(F.col("l_orderkey").alias("chain"), F.col("l_linenumber").cast("string").alias("label_seq"), F.lit("?").alias("auth_seq"), F.lit("?").alias("ins"), atom.alias("atom"), F.when(F.col("l_returnflag") == "R", "A").otherwise(".").alias("alt"), F.col("l_quantity").alias("occupancy"), F.col("l_tax").alias("b_factor"))
    c = annotate.chains(annotate.residues(atoms, ["chain"]), ["chain"]).withColumn("seven", F.lit(7))
    unknown = lambda c, kind: F.coalesce(c.cast(kind), F.lit(-1).cast(kind))
    return c.select(
        "chain", "observed_ca_residues", "complete_backbone_residues", unknown(F.col("internal_missing_residues"), "long").alias("internal_missing_residues"),
        unknown(annotate.terminal_missing(deposited="seven"), "long").alias("terminal_missing_residues"), unknown(F.col("min_ca_occupancy"), "double").alias("min_ca_occupancy"), "alternate_location_residues")


def download_reconcile(spark: SparkSession, d: str) -> DataFrame:
    """Entries annotated against entries delivered."""
    e = _read(spark, d, "record_annotations").select(F.upper(F.substring("id", 1, 4)).alias("id"))
    r = _read(spark, d, "records").select(F.upper(F.substring("id", 1, 4)).alias("id"), F.col("aa").isNotNull().alias("ok"))
    return validate.reconcile(e, r, ok="ok")


def shard_assignment(spark: SparkSession, d: str) -> DataFrame:
    """Records numbered in id order and dealt round to 16 shards and to blocks of 500."""
    ids = _read(spark, d, "records").filter("id is not null").select(canonical_id("id").alias("id")).distinct()
    n = audit.number_rows(ids, ["id"])
    return n.select("id", F.col("row_index").cast("long").alias("row_index"), F.pmod("row_index", F.lit(16)).cast("int").alias("shard"), F.floor(F.col("row_index") / 500).cast("long").alias("block"))


def split_validation(spark: SparkSession, d: str) -> DataFrame:
    """Ids of the released tables that stand in more than one split, or twice in one."""
    rows = None
    for t in ("train", "validation", "test"):
        part = _read(spark, d, t).filter("id is not null").select(canonical_id("id").alias("id"), F.lit(t).alias("split"))
        rows = part if rows is None else rows.unionByName(part)
    return validate.split_overlap(rows).select("id", F.lit("overlap").alias("problem")).unionByName(validate.duplicate_keys(rows, "id", "split").select("id", F.lit("repeated").alias("problem")).distinct())


def row_index_export(spark: SparkSession, d: str) -> DataFrame:
    """The released test ids numbered in order, with the identifiers of each."""
    ids = _read(spark, d, "test").filter("id is not null").select(canonical_id("id").alias("id")).distinct()
    n = audit.number_rows(ids, ["id"]).select("id", F.col("row_index").cast("long").alias("row_index"), components("id").alias("c"))
    return n.select("row_index", F.lit("test").alias("split"), "id", "c.pdb_id", "c.model", F.col("c.chain").alias("chain"))


def path_checksum(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "documents").select("doc_id", shard_path("cif", F.lpad(F.col("doc_id").cast("string"), 7, "0")).alias("path"), F.sha2("text", 256).alias("sha256"))


def set_operations(spark: SparkSession, d: str) -> DataFrame:
    r, a = _read(spark, d, "records").select(canonical_id("id").alias("id")), _read(spark, d, "record_annotations").select(canonical_id("id").alias("id"))
    n = lambda df, name: df.agg(count_rows().alias("n")).select(F.lit(name).alias("operation"), "n")
    return n(r.union(a), "union_all").union(n(r.union(a).distinct(), "union")).union(n(r.intersect(a), "intersect")).union(n(r.exceptAll(a), "except_all")).union(n(r.subtract(a), "except"))


def sorted_limit(spark: SparkSession, d: str) -> DataFrame:
    """The 20 longest chains."""
    return _records(spark, d, "length").filter("length is not null").orderBy(F.desc("length"), "id").limit(20)


def vector_neighbours_topk(spark: SparkSession, d: str) -> DataFrame:
    e = _read(spark, d, "embeddings")
    return similarity.nearest_vectors(e.filter("vec_id % 50 = 0"), e, 5).select("query_id", "target_id", F.round("cosine", 6).alias("cosine"), F.col("rank").cast("int").alias("rank"))


def _texts(spark: SparkSession, d: str, table: str, col: str) -> DataFrame:
    return _read(spark, d, table).select(canonical_id("id").alias("id"), letters(col).alias("seq"))


def _pairs_of_splits(spark: SparkSession, d: str, col: str, cov: float) -> DataFrame:
    """(kind, query_id, target_id, fident): the released splits against each other, named as audit.cross_split_hits does."""
    out = None
    for kind, q, t in (("valid_train", "validation", "train"), ("test_train", "test", "train"), ("valid_test", "validation", "test")):
        h = similarity.similar_sequences(_texts(spark, d, q, col), _texts(spark, d, t, col), cov=cov).select(F.lit(kind).alias("kind"), "query_id", "target_id", "fident")
        out = h if out is None else out.unionByName(h)
    return out


def sequence_similarity_audit(spark: SparkSession, d: str) -> DataFrame:
    """Released validation and test chains against train, and validation against test."""
    return _pairs_of_splits(spark, d, "sequence_aa", 0.8).select("kind", "query_id", "target_id", F.round("fident", 6).alias("fident"))


def structure_similarity_topk(spark: SparkSession, d: str) -> DataFrame:
    """The same pairs of splits by structural alphabet, ten best of each chain and pair of splits."""
    h = similarity.top_hits(_pairs_of_splits(spark, d, "sequence_3di", 0.5), by=("kind", "query_id"))
    return h.select("kind", "query_id", "target_id", F.round("fident", 6).alias("fident"), F.col("rank").cast("int").alias("rank"))


def similarity_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Greedy set cover over the strong hits."""
    ids = _read(spark, d, "records").select(canonical_id("id").alias("id")).distinct()
    h = _hits(spark, d).filter(quality.similarity_hit()).select(F.col("query_id").alias("src"), F.col("target_id").alias("dst"))
    return similarity.set_cover_clusters(edges.cluster_edges(h, ids, "src", "dst"), ids)


def fasta_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Records written as FASTA and read again."""
    s = Scratch(spark, "fasta")
    writers.write_fasta(_records(spark, d, "aa").filter("aa is not null"), f"{s.folder}/aa", "id", "aa")
    return readers.read_fasta(spark, f"{s.folder}/aa").select("id", F.sha2("sequence", 256).alias("sha256"))


def tsv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Membership written as tab-separated text and read again."""
    s = Scratch(spark, "tsv")
    writers.write_tsv(_read(spark, d, "cluster_membership"), f"{s.folder}/m")
    return readers.read_tsv(spark, f"{s.folder}/m").groupBy("merged_group", "split").agg(count_rows().alias("n"))


QUERIES = {f.__name__: f for f in (
    exclusion_reason_counts, filter_totals, kept_records, formatted_metrics, pairing_full_outer, id_components, sequence_complexity, usable_filter, method_rollup, multivalue_mapping, ref_accession_fallback,
    exact_duplicate_groups, dedupe_argmin, group_representative, components_sequence, components_structure, components_overlay, group_sizes_weights, grouped_split, split_membership, split_excluded, split_counts,
    quality_split, structure_split, chronological_split, novelty_labels, key_translation_edges, hits_audit, cross_split_hits, repair_round, repair_fixpoint, residue_chain_rollup, download_reconcile, shard_assignment,
    split_validation, row_index_export, path_checksum, set_operations, sorted_limit, vector_neighbours_topk, sequence_similarity_audit, structure_similarity_topk, similarity_clusters, fasta_roundtrip, tsv_roundtrip, streamed_reason_counts, streamed_first_deliveries,
    p3_found, p3_summary,
)}
