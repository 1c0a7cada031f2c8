"""DuckDB twins of the queries in ``registry_tables.py``."""

from __future__ import annotations

from .oracle import BASE, DIRTY, RECORD_COLS, _overlap, _q
from .sources.fixture import HEADER_LINES

# The fuller fixture (sources/rich.py): the same fixed rules.
RICH = BASE + """,
r0 as (select *, linenumber = 3 and alt1 is not null as sub, linenumber % 2 = 0 as hap, quantity % 3 = 0 as full_info from v),
r1 as (select *, case when sub then ref || 'CA' else ref end as ref2, case when sub then alt1 || 'TA' else alt1 end as b1 from r0),
r as (select *, case when alt2 is not null then ref2 || 'TG' end as b2, n_alts as n from r1),
ra as (select *, b1 as balt, 1 as i from r where b1 is not null union all select *, b2, 2 from r where b2 is not null)
"""


def _call(code: str, sep: str, hap: str) -> str:
    """GT of a sample on the row of allele ``i``."""
    return f"""case when {hap} then case {code} when 0 then '0' when 1 then case when i = 1 then '1' else '.' end
                when 2 then case when n = 2 then case when i = 2 then '1' else '.' end else '1' end end
           else case {code} when 0 then '0{sep}0'
                when 1 then case when n = 1 then '0{sep}1' when i = 1 then '1{sep}.' else '.{sep}1' end
                when 2 then case when i = 1 then '1{sep}1' else '.{sep}.' end else '.{sep}.' end end"""


def _sample(name: str, code: str, sep: str, hap: str) -> str:
    return f"""
select chrom, pos, ref2 as ref, balt as alt, i as allele_idx, '{name}' as sample, {_call(code, sep, hap)} as gt,
       case when {code} = 3 then null else quantity end as gq,
       case when {code} = 3 then null when {hap} then quantity || ',' || (quantity + 10 * i)
            else quantity || ',' || (quantity + 10 * (i * (i + 1) // 2)) || ',' || (quantity + 10 * (i * (i + 1) // 2 + i)) end as pl,
       quantity || ',' || (quantity + i) as ad
from ra"""


def _merkle(run: str, size: int) -> str:
    """Hash tree of a run's shards: blocks of 256 records, one level above them."""
    parts = ", ".join(f"sum(('0x' || substr(h, {1 + 12 * k}, 12))::BIGINT)::BIGINT as s{k}" for k in range(5))
    text = "concat_ws(',', n, s0, s1, s2, s3, s4)"
    return f"""
  select '{run}' as run_id, sid as shard_id, total as n_records, sha256({text}) as shard_hash from (
    select sid, sum(c)::BIGINT as total, count(*) as n, {parts} from (
      select sid, n as c, sha256((blk % 256) || ':' || sha256({text})) as h from (
        select sid, blk, count(*) as n, {parts} from (
          select (ordinal // {size})::int as sid, (ordinal % {size}) // 256 as blk,
                 sha256(((ordinal % {size}) % 256) || ':' || line) as h from o) group by sid, blk)) group by sid)"""


_HEADER = " union all ".join("select '" + ln.replace("'", "''").replace("\t", "' || chr(9) || '") + "' as value" for ln in HEADER_LINES)

SQL: dict[str, str] = {
    "incremental_redo": _q("""
select 'run-a' as run_id, 'empty' as state, 0 as n_now, count(*) filter (where chrom = 'chr1') as n_before, 0 as n_alleles from v
union all
select 'run-b', 'records', count(*) filter (where chrom = 'chr2' and pos <= 20000000), count(*) filter (where chrom = 'chr2'),
       count(alt1) filter (where chrom = 'chr2' and pos <= 20000000) + count(alt2) filter (where chrom = 'chr2' and pos <= 20000000)
from v
union all select 'run-c', 'not committed', 0, count(*) filter (where chrom = 'chr3'), 0 from v
union all select 'run-d', 'empty', 0, 0, 0
union all select 'run-e', 'not committed', 0, 0, 0"""),
    "region_over_shards": _q(f"""
select 'run-a' as run_id, cast(ordinal // 1000 as int) as shard_id, ordinal, {RECORD_COLS} from o
where {_overlap('chr3', 10000000, 20000000)}"""),
    "shard_text": _q(f"""
select value from ({_HEADER}) h union all select line from shards where shard_id = 1"""),
    "run_inventory": _q("""
, k as (select count(distinct shard_id) as n from shards)
select 'shards' as kind, n as n_folders from k union all select 'headers', 1 union all select 'manifests', 1
union all select 'params', 1 union all select 'zones', 1 union all select 'commits', 1""".replace("\n, k as", ", k as", 1)),
    "allele_lookup": _q("""
select chrom, pos, ref, alt, allele_idx, af, qual from a where ref = 'G' and alt = 'T' and pos between 500000 and 20000000"""),
    "count_in_range_rollup": _q("""
select chrom, count(*) as variants from a where pos between 500000 and 20000000 group by chrom"""),
    "table_append": _q("""
select chrom, count(*) as n_rows, count(qual) as n_qual, 'type changed: qual double -> string' as refused from a group by chrom"""),
    "flatten_rich": RICH + """
select chrom, pos, ref2 as ref, case when n = 0 then '.' when n = 1 then b1 else b1 || ',' || b2 end as alts,
       case when full_info and n > 0 then linenumber || case when n = 2 then ',' || (linenumber + 1) else '' end end as ac,
       case when full_info then 6 end as an,
       case when full_info then quantity || case when n > 0 then ',' || (quantity + 2) else '' end
                                         || case when n = 2 then ',' || (quantity + 4) else '' end end as rd,
       true as db,
       case when c1 <> 3 then array_to_string(list_transform(range(0, (n + 1) * (n + 2) // 2), lambda k: quantity + 10 * k), ',') end as pl_s1,
       0 as n_bad
from r""",
    "split_fields": RICH + """
select chrom, pos, ref2 as ref, balt as alt, i as allele_idx, case when full_info then linenumber + i - 1 end as ac,
       case when full_info then 6 end as an, case when i = 1 then af1 else af2 end as af,
       case when full_info then quantity || ',' || (quantity + 2 * i) end as rd,
       case when full_info then cast(quantity + 100 as double) || ',' || cast(quantity + 100 + i * (i + 1) // 2 as double) || ','
                                || cast(quantity + 100 + i * (i + 1) // 2 + i as double) end as gl,
       true as db
from ra""",
    "split_sample_fields": RICH + _sample("S1", "c1", "/", "false") + " union all " + _sample("S2", "c2", "/", "hap")
    + " union all " + _sample("S3", "c3", "|", "false"),
    "decompose_mnv": RICH + """
select chrom, pos, ref2 as ref, balt as alt, i as allele_idx, qual, cast(null as varchar) as event_id,
       cast(null as int) as event_offset, cast(null as int) as event_parts
from ra where not (sub and i = 1)
union all
select chrom, pos + k, substr(ref2, k + 1, 1), substr(balt, k + 1, 1), i, qual, chrom || ':' || pos || ':' || ref2 || ':' || balt, k, 2
from ra, (values (0), (1)) t(k) where sub and i = 1""",
    "recompose_mnv": RICH + """
select chrom, pos, ref2 as ref, balt as alt, i as allele_idx, qual from ra""",
    "merged_regions": _q("""
, m as (select *, coalesce(max(rend) over w, 0) as reach from pr window w as (partition by chrom order by rstart, rend
               rows between unbounded preceding and 1 preceding)),
  isl as (select *, sum((rstart > reach)::int) over (partition by chrom order by rstart, rend) as island from m)
select chrom, min(rstart) as start, max(rend) as "end", count(*) as n_regions from isl group by chrom, island""".replace("\n, m as", ", m as", 1)),
    "region_set_sorted": _q("""
select row_number() over (order by ordinal) - 1 as place, chrom, pos, ref, alt_text as alts, qual from o
where exists (select 1 from pr where pr.chrom = o.chrom and o.pos <= pr.rend and o.pos + length(o.ref) - 1 >= pr.rstart)"""),
    "merkle_shards": _q(f"""
, h as ({_merkle('run-a', 5000)} union all {_merkle('run-b', 5000)} union all {_merkle('run-c', 7000)})
select run_id, shard_id, n_records, shard_hash,
       row_number() over (partition by shard_hash order by run_id, shard_id) = 1 as keep,
       first_value(run_id) over (partition by shard_hash order by run_id, shard_id) as kept_run
from h""".replace("\n, h as", ", h as", 1)),
    "merkle_diff": _q("""
, b as (select ordinal // 5000 as sid, (ordinal % 5000) // 256 as block, min(ordinal) as lo, max(ordinal) as hi from o group by all),
  t as (select max(ordinal) as last from o)
select cast(sid as int) as shard_id, block, case when lo > last - 300 then 'removed' else 'changed' end as change
from b, t where hi > last - 300 or (4321 between lo and hi)""".replace("\n, b as", ", b as", 1)),
    "preview_text_dirty": DIRTY + """
select dord as ordinal, 'Variant ' || (dord + 1) || ': ' || dchrom || ':' || dpos || ' ' || ref || '>' || alt_text || ' (QUAL='
       || case when f_qual or f_qsuf then 'None' when f_tiny then cast(cast('0.0' || repeat('0', linenumber) || '25' as double) as varchar)
               else 'None' end || ')' as text
from dx where dord < 3000 and (f_qual or f_qsuf or f_tiny or qual is null)""",
    "tsv_odd_texts": r"""
select l_orderkey, l_partkey, l_linenumber,
       case l_linenumber when 1 then '.' when 2 then '' when 3 then null when 4 then '\.' when 5 then '\\.' when 6 then '..'
            else l_returnflag end as odd
from lineitem""",
    "read_shard_runs": _q("""
, x as (select 'run-a' as run_id, chrom, 'chr1' as region, count(*) as n from v where chrom = 'chr1' group by all
        union all select 'run-b', chrom, 'chr2:1-20000000', count(*) from v where chrom = 'chr2' and pos <= 20000000 group by all)
select run_id, chrom, n as n_records, (n + 699) // 700 as n_shards, region, 700 as records_per_shard, n as records_written
from x""".replace("\n, x as", ", x as", 1)),
}
SQL["region_tree_join"] = _q("""
select pr.region_id, count(v.pos) as n_variants
from pr left join v on v.chrom = pr.chrom and v.pos <= pr.rend and v.pos + length(v.ref) - 1 >= pr.rstart
group by pr.region_id""")
SQL["join_alleles_bucketed"] = _q("""
, calls as (select * from na where filter = 'PASS'),
  known as (select chrom, pos, ref, alt, count(*) as n_known from na where qual is not null group by all)
select c.chrom, count(*) as n_alleles, count(k.n_known) as n_matched, cast(coalesce(sum(k.n_known), 0) as bigint) as n_known_rows
from calls c left join known k using (chrom, pos, ref, alt)
group by c.chrom""".replace("\n, calls", ", calls", 1))
