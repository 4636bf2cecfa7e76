"""The queries of this subpackage and the SQL they are held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import canonical_id
from . import grouping, languages, mixing, overlap, packing, splitting, survivors, tokens


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def p1_survivors(spark: SparkSession, d: str) -> DataFrame:
    """Each group's survivor with its best known values, and method and chain fields filled by layers; completeness, trust and recency are dimensions."""
    r = _read(spark, d, "records")
    known = survivors.known_values(r, _read(spark, d, "record_annotations"))
    at = F.col("loaded_at")
    more = r.filter("id is not null").select(canonical_id("id").alias("id"), "method", "entity_id", "loaded_at").groupBy("id").agg(*(survivors.latest_value(F.col(c), F.col(c).isNotNull(), at).alias(c) for c in ("method", "entity_id")))
    return survivors.best_representatives(known.join(more, "id", "left"), "digest", "id", (*survivors.CRITERIA, survivors.RECENCY), fill=("method", "entity_id"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    known = survivors.known_values(_read(spark, d, "records"), _read(spark, d, "record_annotations"))
    return survivors.best_representatives(known, "digest", "id").select("group_id", "survivor_id")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return splitting.split_conflicts(_read(spark, d, "cluster_membership"))


def p2_split(spark: SparkSession, d: str) -> DataFrame:
    return splitting.grouped_split(_read(spark, d, "records"), _read(spark, d, "cluster_membership"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return overlap.cross_split_pairs(*(_read(spark, d, t) for t in ("train", "validation", "test")))


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    return overlap.overlap_report(*(_read(spark, d, t) for t in ("train", "validation", "test")))


def _groups(spark: SparkSession, d: str) -> DataFrame:
    ids = _read(spark, d, "records").filter("id is not null").select(canonical_id("id").alias("id")).distinct()
    hits = _read(spark, d, "sequence_hits").filter(grouping.strong_hit()).select(canonical_id("query_id").alias("src"), canonical_id("target_id").alias("dst"))
    known = hits.distinct().join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")
    return grouping.consolidate_matches(known)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _groups(spark, d).select("group_id", "id")


def p5_groups(spark: SparkSession, d: str) -> DataFrame:
    """Every id of records with its group; an id without links is its own group."""
    ids = _read(spark, d, "records").filter("id is not null").select(canonical_id("id").alias("id")).distinct()
    return ids.join(_groups(spark, d), "id", "left").select("id", F.coalesce("group_id", "id").alias("group_id"))


#: Sources kept apart in containers, without case and separators: what was mirrored, and the shelf articles are taken from.
_APART = (("mirrordump", "openshelf"),)


def _packed(spark: SparkSession, d: str) -> DataFrame:
    docs = _read(spark, d, "documents").select("doc_id", "paper_id", tokens.source_key("source").alias("source"), "text")
    return packing.pack(tokens.with_tokens(docs), exclusive=_APART)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return packing.cut_items(_packed(spark, d))


def p6_containers(spark: SparkSession, d: str) -> DataFrame:
    """Every text with its container; no two versions of a paper, and no two of a pair of _APART, in one."""
    return _packed(spark, d)


def _mixed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    docs = _read(spark, d, "documents").select("doc_id", "source", "text")
    return mixing.mix_sources(tokens.with_tokens(docs), _read(spark, d, "source_targets"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d)[1].filter("not target_met").select("source")


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d)[1]


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d)[0]


def _segments(spark: SparkSession, d: str, places: bool = False) -> DataFrame:
    docs = _read(spark, d, "documents").select("doc_id", "lang", "text")
    return languages.segments(docs, languages.fit(docs, _read(spark, d, "lang_reference")), places=places)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return languages.unnamed_languages(_segments(spark, d))


def p8_segments(spark: SparkSession, d: str) -> DataFrame:
    """Every stretch of one language with its place in the text."""
    return _segments(spark, d, places=True)


def p8_documents(spark: SparkSession, d: str) -> DataFrame:
    return languages.document_languages(_segments(spark, d))


QUERIES = {f.__name__: f for f in (p1_found, p1_survivors, p2_found, p2_split, p4_found, p4_report, p5_found, p5_groups, p6_found, p6_containers, p7_found, p7_shares, p7_mix, p8_found, p8_segments, p8_documents)}


def _id(c: str) -> str:
    return f"upper(substr({c}, 1, 4)) || substr({c}, 5)"


def _best(c: str, usable: str) -> str:
    return f"max(row(loaded_at, {c})) filter (where {usable})"


_SEQ = lambda c: f"nullif(regexp_replace(upper({c}), '[^A-Z]', '', 'g'), '')"
_KNOWN = f"""r as (select {_id('id')} as id, {_SEQ('aa')} as aa, resolution, quality_score, loaded_at from records where id is not null),
a as (select {_id('id')} as id, internal_missing_residues as i, backbone_complete_fraction as f, loaded_at from record_annotations where id is not null),
k as (select id, {_best('aa', 'aa is not null')} as aa, {_best('resolution', 'resolution > 0 and not isnan(resolution)')} as r, {_best('quality_score', 'quality_score > 0 and not isnan(quality_score)')} as q from r group by id),
m as (select id, {_best('i', 'i >= 0')} as i, {_best('f', 'f between 0 and 1 and not isnan(f)')} as f from a group by id),
j as (select k.id, k.aa[2] as aa, k.r[2] as r, k.q[2] as q, m.i[2] as i, m.f[2] as f from k left join m using (id)),
w as (select *, row_number() over (partition by aa order by i asc nulls last, f desc nulls last, r asc nulls last, q desc nulls last, id) as rn, min(id) over (partition by aa) as g, count(*) over (partition by aa) as n from j where aa is not null)"""
_LABEL = "case when lower(trim(split)) in ('train', 'training') then 'train' when lower(trim(split)) in ('valid', 'validation', 'val') then 'valid' when lower(trim(split)) in ('test', 'testing') then 'test' end"
_GROUP = _id("nullif(trim(merged_group), '')")
_KEYS = f"keys as (select {_id('id')} as id, upper(substr(id, 1, 4)) as e, {_GROUP} as g, {_LABEL} as s from cluster_membership where id is not null)"
_PAIRS = f"""x as (select distinct 'train' as split, {_id('id')} as id, {_SEQ('sequence_aa')} as seq from train union select 'validation', {_id('id')}, {_SEQ('sequence_aa')} from validation union select 'test', {_id('id')}, {_SEQ('sequence_aa')} from test),
v as (select * from x where id is not null and seq is not null),
pairs as (select e.split as eval_split, e.id as e, t.id as t, levenshtein(e.seq, t.seq) as edits from v e join v t on e.split <> 'train' and t.split = 'train' and abs(length(e.seq) - length(t.seq)) <= greatest(length(e.seq), length(t.seq)) // 10
  where levenshtein(e.seq, t.seq) <= greatest(length(e.seq), length(t.seq)) // 10)"""
_GROUPS = f"""ids as (select distinct {_id('id')} as id from records where id is not null),
h as (select distinct {_id('query_id')} as a, {_id('target_id')} as b from sequence_hits where fident >= 0.3 and not isnan(fident) and qcov >= 0.8 and not isnan(qcov) and tcov >= 0.8 and not isnan(tcov)),
e as (select a, b from h where a <> b and a in (select id from ids) and b in (select id from ids)), s as (select a, b from e union select b, a from e),
reach(id, label) as (select distinct a, a from s union select s.b, r.label from reach r join s on r.id = s.a where r.label < s.b), groups as (select id, min(label) as group_id from reach group by id)"""
_TOKENS = r"len(regexp_extract_all(text, '\p{L}+|\p{N}+|[^\s\p{L}\p{N}]'))"  # words and single signs: no text and no source is near its limit, so any tokenizer gives the same rows
_SOURCE = lambda c: f"nullif(regexp_replace(lower({c}), '[\\s_\\-./:]+', '', 'g'), '')"
_FIRST = lambda c: f"first({c} order by layer, d0, d1, d2, d3, d4, id) filter (where {c} is not null) as"
#: layer: one more than the longest chain of members that dominate one another down to this one.
_LAYERS = f"""more as (select {_id('id')} as id, {_best('method', 'method is not null')} as method, {_best('entity_id', 'entity_id is not null')} as entity_id, max(epoch_us(loaded_at)) as t from records where id is not null group by 1),
v as (select w.*, coalesce(i, 'infinity'::double) as d0, coalesce(-f, 'infinity'::double) as d1, coalesce(r, 'infinity'::double) as d2, coalesce(-q, 'infinity'::double) as d3, coalesce(-more.t, 'infinity'::double) as d4, more.t, more.method[2] as method, more.entity_id[2] as entity_id from w left join more using (id) where n > 1),
dom as (select a.id as up, b.id as down from v a join v b on a.aa = b.aa and a.d0 <= b.d0 and a.d1 <= b.d1 and a.d2 <= b.d2 and a.d3 <= b.d3 and a.d4 <= b.d4 and (a.d0 < b.d0 or a.d1 < b.d1 or a.d2 < b.d2 or a.d3 < b.d3 or a.d4 < b.d4)),
lay(id, k) as (select id, 1 from v union select down, k + 1 from lay join dom on up = lay.id), depth as (select id, max(k) as layer from lay group by 1), z as (select * from v join depth using (id))"""
SQL: dict[str, str] = {
    "p1_survivors": f"""with recursive {_KNOWN}, {_LAYERS} select g as group_id, {_FIRST('id')} survivor_id, max(n) as group_size, {_FIRST('i')} internal_missing_residues, {_FIRST('f')} backbone_complete_fraction,
{_FIRST('r')} resolution, {_FIRST('q')} quality_score, {_FIRST('t')} last_delivered, {_FIRST('method')} method, {_FIRST('entity_id')} entity_id from z group by g""",
    "p6_found": f"select doc_id from documents where {_TOKENS} > 8192",
    "p7_found": f"""with k as (select {_SOURCE('source')} as k, {_TOKENS} as n from documents), s as (select k, sum(n) as s from k group by 1), a as (select sum(n) as w from k)
select source from source_targets left join s on k = {_SOURCE('source_targets.source')}, a where coalesce(s, 0) * max_repeats < target_share * w""",
    "p1_found": f"with {_KNOWN} select g as group_id, id as survivor_id from w where rn = 1 and n > 1",
    "p2_found": f"with {_KEYS} select 'pdb_id' as key_field, e as key_value from keys where s is not null group by e having count(distinct s) > 1 union all select 'merged_group', g from keys where s is not null and g is not null group by g having count(distinct s) > 1",
    "p2_split": f"""with recursive {_KEYS}, ids as (select distinct {_id('id')} as id, upper(substr(id, 1, 4)) as e from records where id is not null),
ed as (select distinct 'e' || e as a, 'g' || g as b from keys where g is not null), s as (select a, b from ed union select b, a from ed), v as (select 'e' || e as v from ids union select a from s),
reach(v, l) as (select v, v from v union select s.b, r.l from reach r join s on r.v = s.a where r.l < s.b), comp as (select v, min(l) as c from reach group by v),
p as (select id, c from ids join comp on v = 'e' || e), z as (select c, min(id) as component_id, count(*) as n from p group by c), t as (select count(*) as all_n from p),
y as (select *, n > 0.05 * all_n as large from z, t), l as (select coalesce(sum(n) filter (where large), 0) as large_n from y), cut as (select all_n - large_n as rest, greatest(0.8 * all_n - large_n, 0.0) as cut from t, l),
o as (select c, component_id, n, sum(n) over (order by md5('42:' || component_id), component_id rows between unbounded preceding and current row) - n / 2 as middle from y where not large),
d as (select c, component_id, case when middle < cut then 'train' when middle < cut + (rest - cut) * 0.5 then 'valid' else 'test' end as split from o, cut union all select c, component_id, 'train' from y where large)
select id, component_id, split from p join d using (c)""",
    "p4_found": f"with {_PAIRS} select distinct least(e, t) as id_a, greatest(e, t) as id_b, eval_split from pairs",
    "p4_report": f"""with {_PAIRS}, hit as (select eval_split as split, e as id, min(edits) as edits from pairs group by 1, 2), u as (select distinct split, id from v where split <> 'train')
select split as eval_split, substr(id, 1, 4) as source, count(*) as n_ids, count(*) filter (where edits = 0) as n_exact, count(*) filter (where edits > 0) as n_near from u left join hit using (split, id) group by 1, 2""",
    "p5_found": f"with recursive {_GROUPS} select group_id, id from groups",
    "p5_groups": f"with recursive {_GROUPS} select ids.id, coalesce(group_id, ids.id) as group_id from ids left join groups using (id)",
}
