"""The same queries in SQL."""

from __future__ import annotations


def _id(c: str) -> str:
    return f"upper(substr({c}, 1, 4)) || substr({c}, 5)"


_REC = f"""rec as (select * exclude (rn) from (
  select {_id('id')} as id, coalesce(nullif(upper(regexp_replace(pdb_id, '\\s+', '', 'g')), ''), upper(substr(id, 1, 4))) as pdb_id,
    nullif(regexp_replace(upper(aa), '[^A-Z]+', '', 'g'), '') as aa, nullif(regexp_replace(lower(three_di), '[^a-z]+', '', 'g'), '') as three_di,
    method, method_category, resolution, deposited_length, coverage, length, quality_score,
    row_number() over (partition by {_id('id')} order by loaded_at desc nulls last) as rn
  from records where id is not null) where rn = 1)"""
_ANN = f"""ann as (select * exclude (rn, cid) replace (cid as id) from (
  select *, {_id('id')} as cid, row_number() over (partition by {_id('id')} order by loaded_at desc nulls last) as rn
  from record_annotations where id is not null) where rn = 1)"""
_MEM = f"mem as (select {_id('id')} as id, min({_id('merged_group')}) as merged_group from cluster_membership where id is not null and merged_group is not null group by 1)"
_NAN = lambda c: f"(case when isnan({c}) then null else {c} end)"
_USABLE = f"""(coalesce({_NAN('three_di_max_token_fraction')}, 1) <= 0.95 and coalesce({_NAN('backbone_complete_fraction')}, 0) >= 0.9
  and coalesce(internal_missing_residues, 1000000000) <= coalesce(greatest(10, length // 10), 10))"""
_FITS = "coalesce(length between 30 and 510, false)"
_REASON = f"""case when aa is null then 'missing_aa' when three_di is null then 'missing_3di' when coalesce(method, '') = '' then 'missing_structure_metadata'
  when length(aa) <> length(three_di) then 'length_mismatch' when length(aa) < 30 then 'too_short'
  when length(translate(aa, 'ACDEFGHIKLMNPQRSTVWY', '')) / length(aa) > 0.2 then 'too_many_unknown_aa'
  when not regexp_matches(upper(three_di), '^[ACDEFGHIKLMNPQRSTVWY]*$') then 'invalid_3di'
  when not coalesce(method_category in ('xray', 'em'), false) then 'method_excluded'
  when resolution is null or isnan(resolution) or resolution <= 0 then 'missing_resolution'
  when method_category = 'xray' and resolution > 3 then 'low_xray_resolution' when method_category = 'em' and resolution > 4 then 'low_em_resolution' end"""
_JOINED = f"joined as (select rec.*, ann.three_di_max_token_fraction, ann.backbone_complete_fraction, ann.internal_missing_residues, ann.release_date from rec left join ann using (id))"
_QUALITY_ORDER = "coalesce(-(case when isnan(quality_score) then null else quality_score end), 'infinity'::double), id"
_COMPLETE_ORDER = f"coalesce(internal_missing_residues, 1000000000), -coalesce({_NAN('backbone_complete_fraction')}, 0), coalesce({_NAN('resolution')}, 999), id"
_ACC = "acc as (select id, unnest(list_distinct(list_filter(list_transform(string_split(coalesce(nullif(sifts_uniprot_ids, ''), native_uniprot_ids), ';'), lambda x: trim(x)), lambda x: x <> ''))) as accession from ann)"
_FAM = "fam as (select id, unnest(list_filter(list_transform(string_split(sifts_pfam_ids, ';'), lambda x: trim(x)), lambda x: x <> '')) as family from ann where id in (select id from rec))"
_HIT = f"hit as (select distinct {_id('query_id')} as q, {_id('target_id')} as t from sequence_hits where fident >= 0.3 and not isnan(fident) and qcov >= 0.8 and not isnan(qcov) and tcov >= 0.8 and not isnan(tcov))"


def _star(table: str, key: str) -> str:
    return f"select id as a, min(id) over (partition by {key}) as b from {table} where {key} is not null"


def _components(name: str, edges: str) -> str:
    """CTEs that end in `name` (id, component); labels travel only to larger ids, the smallest reaches all."""
    return f"""{name}_e as ({edges}), {name}_s as (select a, b from {name}_e where a <> b union select b, a from {name}_e where a <> b),
{name}_r(id, label) as (select id, id from rec union select s.b, r.label from {name}_r r join {name}_s s on r.id = s.a where r.label < s.b),
{name} as (select id, min(label) as component from {name}_r group by id)"""


_CLUSTER_EDGES = f"{_star('rec', 'pdb_id')} union all {_star('rec', 'aa')} union all select merged_group, id from mem where id in (select id from rec) and merged_group in (select id from rec)"
_SEQUENCE_EDGES = f"{_CLUSTER_EDGES} union all select id, min(id) over (partition by accession) from (select * from acc where id in (select id from rec))"
_STRUCTURE_EDGES = _star("fam", "family")
_OVERLAY_EDGES = f"{_SEQUENCE_EDGES} union all {_STRUCTURE_EDGES}"
_RANKED = """base as (select rec.*, comp.component from rec join comp using (id)),
elig as (select component, id, row_number() over (partition by component order by {order}) as rn from {table} where {cond}),
pos as (select component, id, row_number() over (order by md5('42:' || component), component) as p, greatest(1, floor(0.1::double * count(*) over ())) as k from elig where rn = 1),
held as (select component, id as representative, case when p <= k then 'test' else 'valid' end as split from pos where p <= 2 * k),
tr as (select id, row_number() over (partition by aa order by {order}) as rn from {table} where aa is not null and component not in (select component from held) and {train}),
sel as (select representative as id, split from held union all select id, 'train' from tr where rn = 1)"""
_SPLIT = f"with recursive {_REC}, {_MEM}, {_components('comp', _CLUSTER_EDGES)}, " + _RANKED.format(order=_QUALITY_ORDER, table="base", cond=_FITS, train="true")


def _quality_split(edges: str, name: str) -> str:
    ranked = _RANKED.format(order=_COMPLETE_ORDER, table="full_", cond=f"{_USABLE} and {_FITS}", train=_USABLE)
    return f"""with recursive {_REC}, {_ANN}, {_MEM}, {_ACC}, {_FAM}, {_JOINED}, {_components('comp', edges)}, full_ as (select joined.*, comp.component from joined join comp using (id)), {ranked}
select base.id, '{name}:' || base.component as group_id, count(*) over (partition by base.component) as group_size, 1.0::double / count(*) over (partition by base.component) as sampling_weight, coalesce(held.split, 'train') as split, (sel.id is not null)::int as selected
from base left join held using (component) left join sel on sel.id = base.id"""


_PERIODS = f"""dated as (select *, case when release_date <= '2024-12-31' then 'train' when release_date <= '2025-12-31' then 'valid' when release_date <= '2026-09-30' then 'test' end as split from joined where {_USABLE} and coalesce(release_date, '') <> ''),
chrono as (select id, split from (select id, split, row_number() over (partition by split, aa order by {_COMPLETE_ORDER}) as rn from dated where split is not null and aa is not null) where rn = 1)"""
_DELIVERED = f"del as (select id, max(split) as split from (select {_id('id')} as id, 'train' as split from train union all select {_id('id')}, 'valid' from validation union all select {_id('id')}, 'test' from test) where id is not null group by id)"
_CROSS = f"""crossed as (select distinct case when least(case a.split when 'valid' then 0 when 'test' then 1 else 2 end, case b.split when 'valid' then 0 when 'test' then 1 else 2 end) = 0 then 'valid' else 'test' end
  || '_' || case when greatest(case a.split when 'valid' then 0 when 'test' then 1 else 2 end, case b.split when 'valid' then 0 when 'test' then 1 else 2 end) = 2 then 'train' else 'test' end as kind,
  case when (case a.split when 'valid' then 0 when 'test' then 1 else 2 end) < (case b.split when 'valid' then 0 when 'test' then 1 else 2 end) then q else t end as query,
  case when (case a.split when 'valid' then 0 when 'test' then 1 else 2 end) < (case b.split when 'valid' then 0 when 'test' then 1 else 2 end) then t else q end as target
  from hit join {{s}} a on a.id = q join {{s}} b on b.id = t where a.split <> b.split)"""


def _summary(field: str, key: str, value: str, order: str, table: str) -> str:
    v = f"(case when isnan({value}::double) then null else {value}::double end)"
    return f"select '{field}' as key_field, {key} as key_value, count(*) as n_rows, count({v}) as n_values, min({v}) as low, max({v}) as high, count(distinct {order}) as n_orders from {table} group by 2"


_ENTRY_KEY = "coalesce(nullif(upper(regexp_replace(pdb_id, '\\s+', '', 'g')), ''), upper(substr(id, 1, 4)))"
_GROUP_KEY = _id("nullif(trim(merged_group), '')")


def _similar(col: str, cov: float) -> str:
    text = lambda t: f"(select distinct {_id('id')} as id, nullif(regexp_replace(upper({col}), '[^A-Z]+', '', 'g'), '') as seq from {t} where id is not null)"
    part = lambda kind, q, t: f"""select '{kind}' as kind, q.id as query_id, t.id as target_id, max(1 - levenshtein(q.seq, t.seq) / greatest(length(q.seq), length(t.seq))) as fident from {text(q)} q join {text(t)} t
  on q.id <> t.id and length(q.seq) >= {cov} * length(t.seq) and length(t.seq) >= {cov} * length(q.seq) group by q.id, t.id"""  # noqa: E731
    return f"sim as (select * from ({part('valid_train', 'validation', 'train')} union all {part('test_train', 'test', 'train')} union all {part('valid_test', 'validation', 'test')}) where fident >= 0.3)"


_REPAIR = f"""{_REC}, {_MEM}, {_DELIVERED}, {_HIT}, members as (select id, merged_group, length, quality_score from rec join mem using (id)), start as (select id, split from del where id in (select id from members)), {_CROSS.format(s='start')},
struck as (select distinct case when kind = 'valid_test' then 'test' else 'train' end as split, merged_group from crossed join members on members.id = target), placed as (select id, split, merged_group from start join members using (id)),
kept as (select * from placed where (split, merged_group) not in (select (split, merged_group) from struck)),
groups as (select merged_group from placed group by 1 having bool_and(split = 'train')),
reps as (select merged_group, id, row_number() over (partition by merged_group order by {_QUALITY_ORDER}) as rn from members where {_FITS}),
free as (select g.merged_group, r.id, row_number() over (order by md5('42:' || g.merged_group), g.merged_group) as p from groups g join reps r on r.merged_group = g.merged_group and rn = 1
  where g.merged_group not in (select merged_group from struck) and g.merged_group not in (select merged_group from kept where split <> 'train')),
fill as (select id, merged_group from free where p <= (select count(*) from placed where split = 'test') - (select count(*) from kept where split = 'test'))"""

SQL: dict[str, str] = {
    "exclusion_reason_counts": f"with {_REC} select coalesce({_REASON}, 'kept') as reason, count(*) as n from rec group by 1",
    "filter_totals": f"with {_REC}, r as (select *, {_REASON} as reason from rec) select count(*) as n_records, count(aa) as n_aa, count(three_di) as n_3di, count(*) - count(reason) as n_kept, count(reason) as n_excluded, count(distinct pdb_id) as n_entries from r",
    "kept_records": f"with {_REC}, r as (select *, {_REASON} as reason from rec) select id, length(aa)::int as n, case when deposited_length > 0 then least(1.0::double, length(aa)::double / deposited_length) end as coverage, 1.0::double / resolution as quality from r where reason is null",
    "formatted_metrics": f"with {_REC} select id, case when resolution is null or isnan(resolution) then '' else printf('%.3f', resolution) end as resolution, case when coverage is null or isnan(coverage) then '' else printf('%.4f', coverage) end as coverage from rec",
    "pairing_full_outer": f"select coalesce(r.id, a.id) as id, case when r.id is null then 'right_only' when a.id is null then 'left_only' else 'both' end as pairing from (select distinct {_id('id')} as id from records where id is not null) r full outer join (select distinct {_id('id')} as id from record_annotations where id is not null) a on r.id = a.id",
    "id_components": f"""select id, split_part(id, '_', 1) as pdb_id, regexp_extract(id, '^[^_]+_MODEL_([0-9]+)_.+$', 1) as model,
  case when regexp_matches(id, '^[^_]+_MODEL_[0-9]+_.+$') then regexp_extract(id, '^[^_]+_MODEL_[0-9]+_(.+)$', 1) when instr(id, '_') > 0 then substr(id, instr(id, '_') + 1) else '' end as chain from (select distinct {_id('id')} as id from records where id is not null)""",
    "sequence_complexity": f"""with {_REC}, ch as (select id, three_di, unnest(string_split(three_di, '')) as c from rec where three_di is not null), k as (select id, c, count(*)::double as k from ch where c <> '' group by 1, 2)
select id, round(log2(sum(k)) - sum(k * log2(k)) / sum(k), 6) as entropy_bits, round(max(k) / sum(k), 6) as max_fraction, count(*)::int as symbols from k group by id""",
    "usable_filter": f"with {_REC}, {_ANN}, {_JOINED} select id, {_USABLE} as usable, {_FITS} as fits_evaluation from joined",
    "method_rollup": "select case when upper(method) like '%X-RAY DIFFRACTION%' then 'xray' when upper(method) like '%ELECTRON MICROSCOPY%' then 'em' when method is not null then 'other' end as category, method, count(*) as n from records group by 1, 2",
    "multivalue_mapping": f"""with a as (select upper(substr(id, 1, 4)) as pdb_id, sifts_pfam_ids, sifts_cath_ids from record_annotations where {_id('id')} in (select {_id('id')} from records where id is not null)),
x as (select distinct pdb_id, 'pfam' as k, trim(v) as v from (select pdb_id, unnest(string_split(sifts_pfam_ids, ';')) as v from a) union select pdb_id, 'cath', trim(v) from (select pdb_id, unnest(string_split(sifts_cath_ids, ';')) as v from a))
select p.pdb_id, coalesce(string_agg(v, ';' order by v) filter (where k = 'pfam'), '') as pfam_ids, coalesce(string_agg(v, ';' order by v) filter (where k = 'cath'), '') as cath_ids from (select distinct pdb_id from a) p left join (select * from x where v <> '') x using (pdb_id) group by 1""",
    "ref_accession_fallback": f"with {_ANN}, acc as (select id, unnest(list_filter(list_transform(string_split(coalesce(nullif(sifts_uniprot_ids, ''), native_uniprot_ids), ';'), lambda x: trim(x)), lambda x: x <> '')) as accession from ann) select id, accession from acc",
    "exact_duplicate_groups": f"with {_REC} select sha256(aa) as digest, count(*) as n from rec where aa is not null group by aa having count(*) > 1",
    "dedupe_argmin": f"with {_REC} select id from (select id, row_number() over (partition by aa order by {_QUALITY_ORDER}) as rn from rec where aa is not null) where rn = 1",
    "group_representative": f"with {_REC}, {_ANN}, {_MEM}, {_JOINED} select merged_group, id as representative from (select merged_group, id, row_number() over (partition by merged_group order by {_COMPLETE_ORDER}) as rn from joined join mem using (id) where {_USABLE} and {_FITS}) where rn = 1",
    "components_sequence": f"with recursive {_REC}, {_ANN}, {_MEM}, {_ACC}, {_components('comp', _SEQUENCE_EDGES)} select id, component from comp",
    "components_structure": f"with recursive {_REC}, {_ANN}, {_FAM}, {_components('comp', _STRUCTURE_EDGES)} select id, component from comp",
    "components_overlay": f"with recursive {_REC}, {_ANN}, {_MEM}, {_ACC}, {_FAM}, {_components('comp', _OVERLAY_EDGES)} select id, component from comp",
    "group_sizes_weights": f"with recursive {_REC}, {_ANN}, {_MEM}, {_ACC}, {_components('comp', _SEQUENCE_EDGES)} select id, 'sequence:' || component as group_id, count(*) over (partition by component) as group_size, 1.0::double / count(*) over (partition by component) as sampling_weight from comp",
    "grouped_split": f"{_SPLIT} select id, split from sel",
    "split_counts": f"{_SPLIT} select split, count(*) as n from sel group by 1",
    "split_membership": f"{_SPLIT} select base.id, base.component, case when sel.split in ('valid', 'test') then sel.split when held.split is not null then 'heldout_excluded' else 'train' end as split, coalesce((sel.split in ('valid', 'test'))::int, 0) as selected from base left join held using (component) left join sel on sel.id = base.id",
    "split_excluded": f"{_SPLIT} select base.id, case when held.component is not null then 'heldout_group_nonrepresentative' else 'exact_aa_duplicate' end as reason from base left join held using (component) where base.id not in (select id from sel)",
    "quality_split": _quality_split(_SEQUENCE_EDGES, "sequence"),
    "structure_split": _quality_split(_OVERLAY_EDGES, "structure"),
    "chronological_split": f"with {_REC}, {_ANN}, {_JOINED}, {_PERIODS} select id, split from chrono",
    "novelty_labels": f"""with recursive {_REC}, {_ANN}, {_MEM}, {_ACC}, {_FAM}, {_JOINED}, {_PERIODS}, {_components('comp', _SEQUENCE_EDGES)}, {_components('fold', _STRUCTURE_EDGES)}
select c.id, c.split, (comp.component not in (select component from comp join chrono using (id) where split = 'train'))::int as sequence_novel, (fold.component not in (select component from fold join chrono using (id) where split = 'train'))::int as structure_novel
from chrono c join comp using (id) join fold using (id) where c.split <> 'train'""",
    "key_translation_edges": f"with {_MEM}, {_HIT} select distinct coalesce(a.merged_group, q) as src, coalesce(b.merged_group, t) as dst from hit left join mem a on a.id = q left join mem b on b.id = t where coalesce(a.merged_group, q) <> coalesce(b.merged_group, t)",
    "hits_audit": "select count(*) as n_hits, count(*) filter (where fident >= 0.3 and not isnan(fident) and qcov >= 0.8 and not isnan(qcov) and tcov >= 0.8 and not isnan(tcov)) as n_violations from sequence_hits",
    "cross_split_hits": f"with {_DELIVERED}, {_HIT}, {_CROSS.format(s='del')} select kind, query, target from crossed",
    "repair_round": f"""with {_REPAIR} select id, split from kept where not (split = 'train' and merged_group in (select merged_group from fill)) union all select id, 'test' from fill""",
    "residue_chain_rollup": """with atoms as (select l_orderkey as chain, l_linenumber as pos, (['N', 'CA', 'C', 'O'])[(l_partkey % 4)::int + 1] as atom, l_returnflag = 'R' as alt, l_quantity as occ from lineitem),
res as (select chain, pos, bool_or(atom = 'CA') as ca, count(distinct atom) = 4 as bb, bool_or(alt) as alt, max(occ) filter (where atom = 'CA') as occ from atoms group by 1, 2)
select chain, count(*) filter (where ca) as observed_ca_residues, count(*) filter (where bb) as complete_backbone_residues, coalesce(max(pos) filter (where ca) - min(pos) filter (where ca) + 1 - count(distinct pos) filter (where ca), -1)::bigint as internal_missing_residues,
  (case when max(pos) filter (where ca) is null then -1 else min(pos) filter (where ca) - 1 + greatest(0, 7 - max(pos) filter (where ca)) end)::bigint as terminal_missing_residues, coalesce(min(occ) filter (where ca), -1) as min_ca_occupancy, count(*) filter (where ca and alt) as alternate_location_residues from res group by 1""",
    "download_reconcile": """with e as (select distinct upper(substr(id, 1, 4)) as id, 1 as e from record_annotations where id is not null), d as (select upper(substr(id, 1, 4)) as id, count(*) as n, count(*) filter (where aa is null) as failed from records where id is not null group by 1)
select count(e) as expected, count(n) as delivered, count(*) filter (where n is null) as missing, count(*) filter (where e is null) as extra, count(*) filter (where n > 1) as repeated, coalesce(sum(failed), 0)::bigint as failed from e full outer join d using (id)""",
    "shard_assignment": f"select id, i as row_index, (i % 16)::int as shard, i // 500 as block from (select id, row_number() over (order by id) - 1 as i from (select distinct {_id('id')} as id from records where id is not null))",
    "split_validation": f"""with r as (select {_id('id')} as id, 'train' as split from train where id is not null union all select {_id('id')}, 'validation' from validation where id is not null union all select {_id('id')}, 'test' from test where id is not null)
select id, 'overlap' as problem from r group by id having count(distinct split) > 1 union all select distinct id, 'repeated' from (select id, split from r group by 1, 2 having count(*) > 1)""",
    "row_index_export": f"""select row_number() over (order by id) - 1 as row_index, 'test' as split, id, split_part(id, '_', 1) as pdb_id, regexp_extract(id, '^[^_]+_MODEL_([0-9]+)_.+$', 1) as model,
  case when regexp_matches(id, '^[^_]+_MODEL_[0-9]+_.+$') then regexp_extract(id, '^[^_]+_MODEL_[0-9]+_(.+)$', 1) else substr(id, instr(id, '_') + 1) end as chain from (select distinct {_id('id')} as id from test where id is not null)""",
    "path_checksum": "select doc_id, 'cif/' || substr(lpad(doc_id::varchar, 7, '0'), 2, 2) || '/' || lpad(doc_id::varchar, 7, '0') || '.cif.gz' as path, sha256(text) as sha256 from documents",
    "set_operations": f"""with r as (select {_id('id')} as id from records), a as (select {_id('id')} as id from record_annotations)
select 'union_all' as operation, count(*) as n from (select * from r union all select * from a) union all select 'union', count(*) from (select * from r union select * from a) union all select 'intersect', count(*) from (select * from r intersect select * from a)
union all select 'except_all', count(*) from (select * from r except all select * from a) union all select 'except', count(*) from (select * from r except select * from a)""",
    "sorted_limit": f"with {_REC} select id, length from rec where length is not null order by length desc, id limit 20",
    "vector_neighbours_topk": """with q as (select vec_id as qi, embedding as qe from embeddings where vec_id % 50 = 0), s as (select qi, vec_id as ti, list_cosine_similarity(qe::double[], embedding::double[]) as c from q join embeddings on qi <> vec_id)
select qi as query_id, ti as target_id, round(c, 6) as cosine, rn::int as rank from (select *, row_number() over (partition by qi order by round(c, 9) desc, ti) as rn from s) where rn <= 5""",
    "sequence_similarity_audit": f"with {_similar('sequence_aa', 0.8)} select kind, query_id, target_id, round(fident, 6) as fident from sim",
    "structure_similarity_topk": f"with {_similar('sequence_3di', 0.5)} select kind, query_id, target_id, round(fident, 6) as fident, rn::int as rank from (select *, row_number() over (partition by kind, query_id order by fident desc, target_id) as rn from sim) where rn <= 10",
    "similarity_clusters": f"""with recursive {_HIT}, ids as (select distinct {_id('id')} as id from records where id is not null),
strong as (select q as a, t as b from hit where q <> t and q in (select id from ids) and t in (select id from ids)),
r(kind, a, b) as (select 'open', a, b from (select a, b from strong union select b, a from strong) union all select * from (
  with e as (select a, b from r where kind = 'open'), own as (select a as v, lpad((1000000000 - count(*))::varchar, 10, '0') || md5(a) || a as k from e group by a),
  one as (select own.v, own.k, least(own.k, m) as m from own join (select e.a as v, min(own.k) as m from e join own on own.v = e.b group by 1) using (v)),
  reps as (select one.v as rep from one join (select e.a as v, min(one.m) as m2 from e join one on one.v = e.b group by 1) using (v) where k = m and k <= m2),
  taken as (select e.a as rep, e.b as member from e join reps on rep = e.a union all select rep, rep from reps)
  select 'taken', rep, member from taken union all select 'open', a, b from e where a not in (select member from taken) and b not in (select member from taken)))
select coalesce(r.a, id) as rep, id as member from ids left join r on r.kind = 'taken' and r.b = id""",
    "fasta_roundtrip": f"with {_REC} select id, sha256(aa) as sha256 from rec where aa is not null",
    "tsv_roundtrip": "select merged_group, split, count(*) as n from cluster_membership group by 1, 2",
    "streamed_reason_counts": f"""select strftime(date '1970-01-01' + (7 * floor(epoch(loaded_at) / 604800))::int, '%Y-%m-%d') as period_start, coalesce({_REASON}, 'kept') as reason, count(*) as n
from (select nullif(aa, '') as aa, nullif(three_di, '') as three_di, method, method_category, resolution, loaded_at from records where loaded_at is not null) group by 1, 2""",
    "streamed_first_deliveries": f"select {_id('id')} as id, count(distinct loaded_at) as n_deliveries, strftime(min(loaded_at), '%Y-%m-%d') as first_day from records where id is not null and loaded_at is not null group by 1",
    "p3_found": f"""select 'records.pdb_id' as key_field, k as key_value from (select {_ENTRY_KEY} as k, count(*) as n from records group by 1) where k is not null and n >= 0.02 * (select count(*) from records)
union all select 'cluster_membership.merged_group', k from (select {_GROUP_KEY} as k, count(*) as n from cluster_membership group by 1) where k is not null and n >= 0.02 * (select count(*) from cluster_membership)""",
    "p3_summary": _summary("records.pdb_id", _ENTRY_KEY, "resolution", "loaded_at", "records") + " union all " + _summary("cluster_membership.merged_group", _GROUP_KEY, "selected_representative", _id("id"), "cluster_membership"),
}
