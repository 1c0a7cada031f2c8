"""DuckDB SQL twins of the registered queries (correctness oracle).

They run directly on the relation ``fx`` (FIXTURES.md) derived from
``lineitem``: no VCF text is parsed here, so agreement with the Spark side
checks render -> scan -> parse -> operator end to end.  The rendered line is
rebuilt in SQL only where the Spark side depends on it (byte counts, and
the ``(contig_idx, pos, line)`` tie-break of file order).
"""

from __future__ import annotations

FX = """
select *,
  case when quantity=1 then null
       when linenumber=7 then substr(ref,1,1)
       when linenumber=6 then ref||'AC'
       when linestatus='F' then 'T'
       when ref='A' then 'G' else 'A' end as alt1,
  case when quantity>45 then ref||'TG' end as alt2
from (select
  'chr'||cast(l_suppkey%22+1 as varchar(8)) as chrom, l_suppkey%22 as contig_idx,
  (l_orderkey*3001+l_partkey*17+l_linenumber)%45000000+1 as pos,
  case l_returnflag when 'A' then 'A' when 'N' then 'C' else 'G' end
    || case when l_linenumber=7 then 'TT' else '' end as ref,
  case when l_tax=0 then null else l_extendedprice end as qual,
  case when l_discount=0 then 'LowQual' else 'PASS' end as filter,
  l_discount as af1, l_discount/2 as af2,
  l_linenumber as linenumber, l_linestatus as linestatus, cast(l_quantity as int) as quantity,
  l_linenumber%4 as g1, l_partkey%4 as g2, l_suppkey%4 as g3
 from lineitem) t
"""


def _gt(code: str, sep: str = "/") -> str:
    return (f"case {code} when 0 then '0{sep}0' when 1 then '0{sep}1' when 2 then '1{sep}1' "
            f"else '.{sep}.' end")


def _gq(code: str) -> str:
    return f"case when {code}=3 then '.' else cast(quantity as varchar) end"


BASE = f"""
with fx as ({FX}),
v as (
  select *,
    case when alt1 is null then '.' when alt2 is not null then alt1||','||alt2 else alt1 end as alt_text,
    case when alt1 is null then 0 when alt2 is not null then 2 else 1 end as n_alts,
    case when alt1 is null then 0 else g1 end as c1,
    case when alt1 is null then 0 else g2 end as c2,
    case when alt1 is null then 0 else g3 end as c3,
    'AF='||case when alt2 is not null then cast(af1 as varchar)||','||cast(af2 as varchar)
                else cast(af1 as varchar) end||';DB' as info
  from fx),
l as (
  select *,
    chrom||chr(9)||cast(pos as varchar)||chr(9)||'.'||chr(9)||ref||chr(9)||alt_text||chr(9)
      ||coalesce(cast(qual as varchar),'.')||chr(9)||filter||chr(9)||info||chr(9)||'GT:GQ'||chr(9)
      ||{_gt('c1')}||':'||{_gq('c1')}||chr(9)||{_gt('c2')}||':'||{_gq('c2')}||chr(9)
      ||{_gt('c3', '|')}||':'||{_gq('c3')} as line
  from v),
o as (select *, row_number() over (order by contig_idx, pos, line) - 1 as ordinal from l),
a as (
  select chrom, contig_idx, pos, ref, qual, filter, alt1 as alt, 1 as allele_idx, af1 as af
    from v where alt1 is not null
  union all
  select chrom, contig_idx, pos, ref, qual, filter, alt2 as alt, 2 as allele_idx, af2 as af
    from v where alt2 is not null),
n1 as (
  select *, case when len(ref) < 2 or len(alt) < 2 then 0
    else coalesce(list_max(list_filter(range(1, least(len(ref), len(alt))),
         lambda k: right(ref, k) = right(alt, k))), 0) end as suf
  from a),
n2 as (select *, left(ref, len(ref) - suf) as r2, left(alt, len(alt) - suf) as a2 from n1),
n3 as (
  select *, case when len(r2) < 2 or len(a2) < 2 then 0
    else coalesce(list_max(list_filter(range(1, least(len(r2), len(a2))),
         lambda k: left(r2, k) = left(a2, k))), 0) end as pre
  from n2),
na as (select chrom, pos + pre as pos, substr(r2, pre + 1) as ref, substr(a2, pre + 1) as alt,
              pos as orig_pos, allele_idx, qual, filter, af from n3),
g as (
  select chrom, pos, ref, 'S1' as sample, 0 as sample_idx, c1 as code, quantity from v
  union all select chrom, pos, ref, 'S2', 1, c2, quantity from v
  union all select chrom, pos, ref, 'S3', 2, c3, quantity from v),
pr as (
  select p_partkey as region_id, 'chr'||cast(p_partkey%22+1 as varchar) as chrom,
         (p_partkey*7919)%45000000+1 as rstart,
         (p_partkey*7919)%45000000+1 + cast(p_size as bigint)*1000 as rend
  from part),
shards as (select ordinal // 5000 as shard_id, * from o)
"""

RECORD_COLS = "chrom, pos, ref, alt_text as alts, qual"


def _q(body: str) -> str:
    return BASE + body


def _overlap(chrom: str, start: int, end: int) -> str:
    return f"(chrom = '{chrom}' and pos <= {end} and pos + length(ref) - 1 >= {start})"


def _gt_class(code: str) -> str:
    return (f"case {code} when 0 then 'hom_ref' when 1 then 'het' when 2 then 'hom_alt' "
            f"else 'missing' end")


def _shard_hash_run(run: str, size: int) -> str:
    return f"""
  select '{run}' as run_id, cast(ordinal // {size} as int) as shard_id, count(*) as n_records,
         sha256(string_agg(sha256(line), ',' order by ordinal)) as shard_hash
  from o group by ordinal // {size}"""


SQL: dict[str, str] = {
    "scan_variants": _q("""
select chrom, pos, cast(null as varchar) as id, ref, alt_text as alts, qual, filter, n_alts,
       cast(strlen(line) + 1 as bigint) as raw_len from l"""),
    "scan_empty": _q("""
select chrom, pos, cast(null as varchar) as id, ref, alt_text as alts, qual, filter, n_alts,
       cast(strlen(line) + 1 as bigint) as raw_len from l where chrom = 'chrUn'"""),
    "flatten_fixed": _q("""
select chrom, contig_idx, pos, cast(null as varchar) as id, ref, alt_text as alts, qual, filter,
       info, 1 as n_filters from v"""),
    "flatten_info": _q("""
select chrom, pos, ref, 2 as n_info_keys, af1, case when alt2 is not null then af2 end as af2,
       case when alt2 is not null then 2 else 1 end as n_af, true as has_db from v"""),
    "flatten_genotypes": _q(f"""
select chrom, pos, ref, 3 as n_samples, 'GT:GQ' as format,
  {_gt('c1')} as gt_s1, case when c1 = 3 then null else quantity end as gq_s1,
  {_gt('c2')} as gt_s2, case when c2 = 3 then null else quantity end as gq_s2,
  {_gt('c3', '|')} as gt_s3, case when c3 = 3 then null else quantity end as gq_s3
from v"""),
    "typed_rejects": _q("""
select count(*) as n_records, cast(0 as bigint) as records_with_bad_fields,
       count(*) filter (where qual is null) as missing_qual, cast(0 as bigint) as bad_qual,
       cast(0 as bigint) as bad_af,
       cast(sum((c1 = 3)::int + (c2 = 3)::int + (c3 = 3)::int) as bigint) as missing_gq,
       cast(0 as bigint) as bad_gq
from v"""),
    "header_summary": _q("""
select 'VCFv4.2' as version, 3 as n_samples, 'S1,S2,S3' as samples, 22 as n_contigs, 2 as n_info,
       2 as n_format, count(*) as n_records from fx"""),
    "count_in_range": _q("""
select chrom, count(*) as variants from fx where pos between 10000000 and 20000000 group by chrom"""),
    "region_scan": _q(f"""
select {RECORD_COLS} from v where {_overlap('chr3', 10000000, 20000000)}"""),
    "filter_quality": _q(f"""
select {RECORD_COLS} from v where qual >= 50000"""),
    "project_core": _q("""
select chrom, pos, ref, qual from fx"""),
    "region_set_semi": _q(f"""
select {RECORD_COLS} from v
where {_overlap('chr1', 10000000, 20000000)} or {_overlap('chr1', 15000000, 25000000)}
   or {_overlap('chr2', 1, 5000000)}"""),
    "region_set_counts": _q(f"""
select 0 as region_id, 'chr1:10000000-20000000' as region, count(*) as n_variants
  from v where {_overlap('chr1', 10000000, 20000000)}
union all
select 1, 'chr1:15000000-25000000', count(*) from v where {_overlap('chr1', 15000000, 25000000)}
union all
select 2, 'chr2:1-5000000', count(*) from v where {_overlap('chr2', 1, 5000000)}"""),
    "region_join_parts": _q("""
select pr.region_id, count(v.pos) as n_variants
from pr left join v on v.chrom = pr.chrom and v.pos <= pr.rend and v.pos + length(v.ref) - 1 >= pr.rstart
group by pr.region_id"""),
    "region_semi_parts": _q("""
select ordinal, chrom, pos, ref, alt_text as alts, qual from o
where exists (select 1 from pr where pr.chrom = o.chrom and o.pos <= pr.rend
              and o.pos + length(o.ref) - 1 >= pr.rstart)"""),
    "split_multiallelic": _q("""
select chrom, pos, ref, alt, allele_idx, af, qual, filter from a"""),
    "normalize_alleles": _q("""
select chrom, pos, ref, alt, orig_pos, allele_idx from na"""),
    "allele_class_counts": _q("""
select case when not regexp_full_match(alt, '[ACGTNacgtn]+') then 'SYMBOLIC'
            when len(ref) = 1 and len(alt) = 1 then 'SNV'
            when len(ref) = len(alt) then 'MNV'
            when len(ref) < len(alt) then 'INS' else 'DEL' end as allele_class,
       count(*) as n_alleles
from a group by 1"""),
    "filter_af": _q("""
select chrom, pos, ref, alt, af from a where af between cast(0.02 as double) and cast(0.04 as double)"""),
    "af_bins": _q("""
select cast(floor(af / cast(0.05 as double)) as bigint) as af_bin, count(*) as n_alleles
from a group by 1"""),
    "genotype_class_counts": _q(f"""
select sample, {_gt_class('code')} as gt_class, count(*) as n_genotypes from g group by 1, 2"""),
    "genotypes_long": _q(f"""
select chrom, pos, ref, sample,
       case when sample = 'S3' then {_gt('code', '|')} else {_gt('code')} end as gt,
       case when code = 3 then null else quantity end as gq
from g"""),
    "stream_summary": _q("""
select count(*) as total_variants, cast(coalesce(sum(strlen(line) + 1), 0) as bigint) as total_bytes,
       cast(sum(strlen(line) + 1) as double) / nullif(count(*), 0) as avg_bytes
from l"""),
    "count_by_chrom": _q("""
select chrom, count(*) as variants, count(*) filter (where qual is null) as null_qual
from fx group by chrom"""),
    "stage_counts": _q("""
select * from (values (0, 'lines', (select count(*) + 30 from fx)),
                      (1, 'header_lines', 30),
                      (2, 'records', (select count(*) from fx)),
                      (3, 'alleles', (select count(*) from a)),
                      (4, 'genotypes', (select 3 * count(*) from fx)),
                      (5, 'records_with_bad_fields', 0)) t(step, stage, n_rows)"""),
    "preview_text": _q("""
select ordinal, 'Variant '||cast(ordinal + 1 as varchar)||': '||chrom||':'||cast(pos as varchar)||' '||ref
       ||'>'||alt_text||' (QUAL='||coalesce(cast(qual as varchar), 'None')||')' as text
from o where ordinal < 10"""),
    "limit_variants": _q(f"""
select ordinal, {RECORD_COLS} from o where ordinal < 1000"""),
    "coordinate_sorted": _q("""
select chrom, count(*) as n_records, min(pos) as min_pos, max(pos) as max_pos,
       cast(0 as bigint) as n_unsorted
from fx group by chrom"""),
    "shard_manifest": _q("""
select cast(shard_id as int) as shard_id, printf('shard_%04d', shard_id) as shard_name,
       count(*) as n_records, min(ordinal) as first_ordinal, max(ordinal) as last_ordinal,
       arg_min(chrom, ordinal) as first_chrom, arg_min(pos, ordinal) as first_pos,
       arg_max(chrom, ordinal) as last_chrom, arg_max(pos, ordinal) as last_pos
from shards group by shard_id"""),
    "shard_names": _q("""
select printf('shard_%04d', shard_id) as shard_name, count(*) as n_records from shards group by shard_id"""),
    "read_shard": _q(f"""
select ordinal, {RECORD_COLS} from shards where shard_id = 3"""),
    "shard_validation": _q("""
select cast(shard_id as int) as shard_id, count(*) as n_records,
       least(5000, (select count(*) from fx) - shard_id * 5000) as expected_records,
       true as ordinals_dense, cast(0 as bigint) as n_unsorted, false as starts_before_previous
from shards group by shard_id"""),
    "dedup_shards": _q(f"""
, h as ({_shard_hash_run('run-a', 5000)} union all {_shard_hash_run('run-b', 5000)}
        union all {_shard_hash_run('run-c', 7000)})
select run_id, shard_id, n_records, shard_hash,
       row_number() over (partition by shard_hash order by run_id, shard_id) = 1 as keep,
       first_value(run_id) over (partition by shard_hash order by run_id, shard_id) as kept_run
from h""".replace("\n, h as", ", h as", 1)),
    "load_variants": _q("""
select chrom, count(*) as variants from a where pos between 10000000 and 20000000 group by chrom"""),
    "tsv_roundtrip": _q("""
select chrom, pos, ref, alt, allele_idx, af, qual from a"""),
    "parquet_roundtrip": _q("""
select chrom, pos, ref, alt_text as alts, qual, 3 as n_samples from v"""),
    "schema_evolution": _q("""
select 1 as schema_version, count(*) as n_rows, cast(0 as bigint) as n_with_af from fx
union all
select 2, count(*), count(*) from fx where qual is not null"""),
    "join_alleles": _q("""
, calls as (select * from na where filter = 'PASS'),
  known as (select chrom, pos, ref, alt, count(*) as n_known from na where qual is not null
            group by all)
select c.chrom, count(*) as n_alleles, count(k.n_known) as n_matched,
       cast(coalesce(sum(k.n_known), 0) as bigint) as n_known_rows
from calls c left join known k using (chrom, pos, ref, alt)
group by c.chrom""".replace("\n, calls", ", calls", 1)),
    "snapshot_diff": _q("""
, b as (select chrom, pos, ref, alt, count(*) as n,
               list_sort(list(coalesce(cast(qual as varchar), 'null') || '/' || cast(af as varchar))) as p
        from na where filter = 'PASS' group by all),
  f as (select chrom, pos, ref, alt, count(*) as n,
               list_sort(list(coalesce(cast(qual as varchar), 'null') || '/' || cast(af as varchar))) as p
        from na where qual is not null group by all),
  d as (select case when b.n is null then 'added' when f.n is null then 'removed'
                    when b.n <> f.n or b.p <> f.p then 'changed' else 'unchanged' end as change,
               coalesce(b.n, 0) as nb, coalesce(f.n, 0) as na_
        from b full outer join f using (chrom, pos, ref, alt))
select change, count(*) as n_keys, cast(sum(nb) as bigint) as n_before, cast(sum(na_) as bigint) as n_after
from d group by change""".replace("\n, b as", ", b as", 1)),
    "orphan_rows": _q("""
select 'records_without_alleles' as check, count(*) as n_rows from fx where alt1 is null
union all
select 'alleles_without_record', 0"""),
    "info_violations": _q("""
select 'AF' as key, 'wrong_number' as issue, count(*) as n_records from fx where alt1 is null
group by all having count(*) > 0"""),
    "completeness": _q("""
select count(*) as n_records, count(*) as missing_id, count(*) filter (where qual is null) as missing_qual,
       count(*) filter (where alt1 is null) as missing_alt, cast(0 as bigint) as missing_filter,
       cast(0 as bigint) as missing_info,
       cast(sum((c1 = 3)::int + (c2 = 3)::int + (c3 = 3)::int) as bigint) as missing_gt,
       cast(sum((c1 = 3)::int + (c2 = 3)::int + (c3 = 3)::int) as bigint) as missing_gq,
       3 * count(*) as n_genotypes
from v"""),
}


# The faulty fixture (sources/dirty.py): the same remainders, fixed values.
DIRTY = BASE + f""",
d as (
  select *, pos % 50 = 0 as f_qual, pos % 97 = 1 as f_pos, pos % 41 = 2 as f_af, pos % 37 = 3 as f_rep,
         pos % 29 = 4 as f_unk, pos % 31 = 5 as f_contig, pos % 200 = 6 as f_moved, pos % 53 = 7 as f_gq,
         pos % 59 = 8 and pos % 50 <> 0 as f_qsuf, pos % 61 = 9 and pos % 41 <> 2 as f_asuf,
         pos % 47 = 10 and pos % 59 <> 8 and pos % 50 <> 0 as f_tiny,
         alt2 is not null and g1 = 1 as f_12, linenumber = 4 as f_hap
  from v),
dl as (
  select *, case when f_contig then 'scaf' || cast(contig_idx as varchar) else chrom end as dchrom,
         case when f_pos then null else pos end as dpos,
         case when f_12 then '1/2' else {_gt('c1')} end as t1, {_gt('c2')} as t2,
         case when f_hap then '1' else {_gt('c3', '|')} end as t3,
         case when f_gq then 'q' else {_gq('c1')} end as q1, {_gq('c2')} as q2, {_gq('c3')} as q3
  from d),
dr as (
  select *, dchrom || chr(9) || case when f_pos then 'x' else '' end || cast(pos as varchar) || chr(9) || '.' || chr(9) || ref
      || chr(9) || alt_text || chr(9) || case when f_qual then 'high' when f_qsuf then cast(quantity as varchar) || 'd'
                                         when f_tiny then '0.0' || repeat('0', linenumber) || '25'
                                         else coalesce(cast(qual as varchar), '.') end
      || chr(9) || filter || chr(9)
      || 'AF=' || case when f_af then 'abc' when f_asuf then '0.1f' when alt2 is not null then cast(af1 as varchar) || ',' || cast(af2 as varchar)
                  else cast(af1 as varchar) end || ';DB'
      || case when f_rep then ';AF=9' else '' end || case when f_unk then ';ZZ=1' else '' end || chr(9)
      || case when linenumber = 5 then 'GQ:GT' else 'GT:GQ' end || chr(9)
      || case when linenumber = 5 then q1 || ':' || t1 else t1 || ':' || q1 end || chr(9)
      || case when linenumber = 2 then t2 when linenumber = 5 then q2 || ':' || t2 else t2 || ':' || q2 end || chr(9)
      || case when linenumber = 5 then q3 || ':' || t3 else t3 || ':' || q3 end as dline
  from dl),
dx as (
  select *, row_number() over (order by contig_idx, case when f_moved then 0 else pos end, dline) - 1 as dord from dr),
dk as (
  select *, case when f_contig then (1::bigint << 40) + min(dord) over (partition by dchrom) else contig_idx end as rnk
  from dx)
"""


def _back() -> str:
    return "coalesce(case when pchrom = dchrom then dpos < ppos else rnk < prnk end, false)"


def _gt_text_class(t: str) -> str:
    return (f"case when {t} like '%.%' then 'missing' when {t} in ('0/0', '0|0') then 'hom_ref' "
            f"when {t} in ('1/1', '1|1', '1') then 'hom_alt' else 'het' end")


_LAG = """(select *, lag(dchrom) over w as pchrom, lag(dpos) over w as ppos, lag(rnk) over w as prnk, lag(dord) over w as pord
       from {} window w as (order by dord))"""

SQL |= {
    "typed_rejects_dirty": DIRTY + """
select count(*) as n_records, count(*) filter (where f_qual or f_qsuf or f_pos or f_af or f_asuf or f_rep) as records_with_bad_fields,
       count(*) filter (where f_qual or f_qsuf or (qual is null and not f_tiny)) as missing_qual,
       count(*) filter (where f_qual or f_qsuf) as bad_qual,
       count(*) filter (where f_pos) as bad_pos, count(*) filter (where f_af or f_asuf) as bad_af,
       count(*) filter (where f_rep) as repeated_info,
       cast(sum((f_gq or c1 = 3)::int + (linenumber = 2 or c2 = 3)::int + (c3 = 3)::int) as bigint) as missing_gq,
       count(*) filter (where f_gq) as bad_gq
from d""",
    "info_violations_dirty": DIRTY + """
select 'ZZ' as key, 'unknown_key' as issue, count(*) as n_records from d where f_unk group by all having count(*) > 0
union all
select 'AF', 'wrong_number', count(*) from d where alt1 is null or ((f_af or f_asuf) and alt2 is not null) group by all having count(*) > 0
union all
select 'AF', 'wrong_type', count(*) from d where f_af or f_asuf group by all having count(*) > 0""",
    "coordinate_sorted_dirty": DIRTY + f"""
select dchrom as chrom, count(*) as n_records, min(dpos) as min_pos, max(dpos) as max_pos,
       count(*) filter (where {_back()}) as n_unsorted
from {_LAG.format('dk')} group by dchrom""",
    "genotype_class_counts_dirty": DIRTY + f"""
select sample, gt_class, count(*) as n_genotypes from (
  select 'S1' as sample, {_gt_text_class('t1')} as gt_class from dl
  union all select 'S2', {_gt_text_class('t2')} from dl union all select 'S3', {_gt_text_class('t3')} from dl)
group by all""",
    "shard_validation_dirty": DIRTY + f""",
kept as (select * from dk where dord % 997 <> 5 union all select * from dk where dord % 701 = 3),
p as {_LAG.format('kept')},
s as (select *, dord // 5000 as sid, pord is not null and pord // 5000 = dord // 5000 as inside from p)
select cast(sid as int) as shard_id, count(*) as n_records,
       least(5000, (select count(*) from dk) - sid * 5000) as expected_records,
       coalesce(not max(inside and dord - pord <> 1), true) and min(dord) = sid * 5000 as ordinals_dense,
       count(*) filter (where inside and {_back()}) as n_unsorted,
       coalesce(max(not inside and pord + 1 = dord and {_back()}), false) as starts_before_previous
from s group by sid""",
    "orphan_rows_dirty": _q("""
, r as (select ordinal from o where ordinal % 997 <> 5 union all select ordinal from o where ordinal % 701 = 3),
  al as (select ordinal from o where alt1 is not null and ordinal % 503 <> 2
         union all select ordinal from o where alt2 is not null and ordinal % 503 <> 2)
select 'records_without_alleles' as check, count(*) as n_rows from r where ordinal not in (select ordinal from al)
union all
select 'alleles_without_record', count(*) from al where ordinal not in (select ordinal from r)""".replace("\n, r as", ", r as", 1)),
    "region_join_far": _q("""
select * from (
  select 0 as region_id, 'chr1' as chrom, count(*) as n_variants from v where chrom = 'chr1' and pos + length(ref) - 1 >= 1000
  union all select 1, 'chr2', count(*) from v where chrom = 'chr2'
  union all select 2, 'chr3', count(*) from v where chrom = 'chr3' and pos <= 10000000
  union all select 3, 'chr4', 0)"""),
    "table_range_read": _q("""
select substr(chrom, 4) as chrom, count(*) as variants from a where pos between 500000 and 20000000 group by all"""),
    "incremental_load": _q("""
select case chrom when 'chr2' then 'run-b' else 'run-a' end as run_id, chrom, count(*) as n_alleles
from a where chrom in ('chr2', 'chr4') group by all"""),
    "coordinate_sort": _q("select ordinal, chrom, pos, ref from o"),
    "summary_by_chrom": _q("""
select chrom, count(*) as variants, (select count(*) from l) as total_variants,
       (select cast(sum(strlen(line) + 1) as bigint) from l) as total_bytes
from l group by chrom"""),
    "load_genotypes": _q(f"""
select chrom, pos, ref, sample, {_gt('code')} as gt, case when code = 3 then null else quantity end as gq
from (select * from g where sample <> 'S3') where pos between 500000 and 20000000
union all
select chrom, pos, ref, sample, {_gt('code', '|')}, case when code = 3 then null else quantity end
from (select * from g where sample = 'S3') where pos between 500000 and 20000000"""),
    "columnar_per_shard": _q("""
select cast(shard_id as int) as shard_id, count(*) as n_records, min(ordinal) as first_ordinal, 3 * count(*) as n_genotypes
from shards group by shard_id"""),
    "tsv_per_shard": _q(f"""
select cast(shard_id as int) as shard_id, chrom, pos, ref,
       {_gt('c1')} || ';' || {_gt('c2')} || ';' || {_gt('c3', '|')} as genotypes_gt
from shards"""),
}

from .oracle_tables import SQL as _TABLE_SQL  # noqa: E402

SQL |= _TABLE_SQL
