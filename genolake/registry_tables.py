"""Registered queries over committed runs and stored tables (see ``registry.py``; twins in ``oracle_tables.py``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .operators import aggregate as A
from .operators import alleles as AL
from .operators import compare as C
from .operators import intervals as I
from .operators import regions as R
from .operators import split as SP
from .operators.flatten import alt_text, flatten, with_typed_info
from .operators.ordinal import with_sorted_ordinal
from .plans import buckets as B
from .plans import clustered as CL
from .plans import commits as L
from .plans import export as E
from .plans import inventory as INV
from .plans import rollup as RU
from .plans import shard as S
from .plans import table as TB
from .plans.zones import region_over_shards as read_region
from .registry import (EMPTY_REGION, RECORDS_PER_SHARD, REGION, TABLE_BUCKET, WIDE_RANGE, _alleles, _ordered, _pass_and_qual,
                       _record_cols, _run, dirty_scan, fixture_scan, part_regions, query)
from .session import scratch_path, session_key
from .sources.rich import materialize_rich_vcf
from .sources.scan import VcfScan, open_vcf
from .streaming.incremental import read_loaded, start_incremental_load

BUCKETS = 16
LOOKUP = ("G", "T")
DAMAGED = 4_321  # one record's ordinal

_RICH: dict[tuple, VcfScan] = {}


def rich_scan(spark, sf_dir) -> VcfScan:
    key = (session_key(spark), materialize_rich_vcf(spark, sf_dir))
    if key not in _RICH:
        _RICH[key] = open_vcf(spark, key[1])
    return _RICH[key]


# --- the commit log ---------------------------------------------------------------

@query
def incremental_redo(spark, sf_dir):
    """Five runs, then a redo to nothing, a redo to fewer shards and a tombstone; the table follows, an old snapshot stays."""
    base, out = scratch_path(spark, "redo-runs"), scratch_path(spark, "redo-alleles")
    scan = fixture_scan(spark, sf_dir)

    def run(name, size, region, redo=False):
        S.shard(spark, None, base, size, region, run_id=name, scan=scan, redo=redo)

    run("run-a", 500, "chr1"), run("run-b", 500, "chr2"), run("run-c", 500, "chr3"), run("run-d", 500, EMPTY_REGION)
    start_incremental_load(spark, base, out, header=scan.header).awaitTermination()
    before = L.latest_version(spark, base)
    run("run-a", 500, EMPTY_REGION, True), run("run-b", 9000, "chr2:1-20000000", True)
    L.remove_run(spark, base, "run-c")
    S.read_shards(spark, base, "run-b").write.parquet(f"{base}/shards/run_id=run-e/shard_id=0")  # never committed
    start_incremental_load(spark, base, out, header=scan.header).awaitTermination()
    names = spark.range(5).select(F.concat(F.lit("run-"), F.substring(F.lit("abcde"), F.col("id") + 1, F.lit(1))).alias("run_id"))
    state = L.runs_at(L.read_log(spark, base)).select("run_id", F.col("n_shards").cast("long").alias("n_shards"), "n_records")
    now = S.read_shards(spark, base).groupBy("run_id").agg(F.count(F.lit(1)).alias("n_now"))
    old = S.read_shards(spark, base, version=before).groupBy("run_id").agg(F.count(F.lit(1)).alias("n_before"))
    loaded = read_loaded(spark, out).groupBy("run_id").agg(F.count(F.lit(1)).alias("n_alleles"))
    x = names.join(state, "run_id", "left").join(now, "run_id", "left").join(old, "run_id", "left").join(loaded, "run_id", "left")
    committed = F.when(F.col("n_records").isNull(), "not committed").when(F.col("n_records") == 0, "empty").otherwise("records")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return x.select("run_id", committed.alias("state"), zero("n_now"), zero("n_before"), zero("n_alleles"))


@query
def region_over_shards(spark, sf_dir):
    """A region read from a run's shards: the zone map names the folders that are opened."""
    base = _run(spark, sf_dir, 1000)
    v = read_region(spark, base, REGION, header=fixture_scan(spark, sf_dir).header)
    return v.select("run_id", "shard_id", "ordinal", *_record_cols(v))


@query
def shard_text(spark, sf_dir):
    """One shard as a VCF of its own: the run's header, then its records."""
    base = _run(spark, sf_dir)
    return S.shard_as_vcf_text(spark, base, "run-a", 1)


@query
def run_inventory(spark, sf_dir):
    """The files of a run by kind: folders that hold data, from a listing of the base."""
    base = _run(spark, sf_dir)
    files = INV.list_files(spark, base).where(~F.col("relative_path").rlike(r"(^|/)[._][^/]*$"))
    kind = F.substring_index("relative_path", "/", 1)
    folder = F.regexp_replace("relative_path", "/[^/]*$", "")
    return files.groupBy(kind.alias("kind")).agg(F.count_distinct(folder).alias("n_folders"))


# --- bucketed, clustered and counted tables ------------------------------------------

@query
def join_alleles_bucketed(spark, sf_dir):
    """``join_alleles`` over two bucketed tables: no shuffle of calls or known alleles."""
    calls, known = _pass_and_qual(spark, sf_dir)
    cols = ["chrom", "pos", "ref", "alt", "qual"]
    n = B.buckets_for(fixture_scan(spark, sf_dir).body().count(), BUCKETS)
    a = B.write_bucketed(calls.select(*cols), scratch_path(spark, "calls-bucketed"), n)
    b = B.write_bucketed(known.select(*cols), scratch_path(spark, "known-bucketed"), n, files_per_bucket=2)
    j = C.annotate_by_allele(B.open_bucketed(spark, a), B.open_bucketed(spark, b))
    return j.groupBy("chrom").agg(F.count(F.lit(1)).alias("n_alleles"), F.count_if(F.col("n_known") > 0).alias("n_matched"),
                                  F.sum("n_known").cast("long").alias("n_known_rows"))


@query
def allele_lookup(spark, sf_dir):
    """One allele in a range, from the table in Z-order with Bloom filters."""
    path = scratch_path(spark, "clustered-table")
    a = _alleles(spark, sf_dir).select("chrom", "pos", "ref", "alt", "allele_idx", "af", "qual")
    CL.load_clustered(a, path, TABLE_BUCKET)
    return CL.find_allele(spark, path, *LOOKUP, start=WIDE_RANGE[0], end=WIDE_RANGE[1]).select(
        "chrom", "pos", "ref", "alt", "allele_idx", "af", "qual")


@query
def count_in_range_rollup(spark, sf_dir):
    """The range count from kept bucket counts and the two buckets it cuts."""
    path = scratch_path(spark, "rollup-table")
    a = _alleles(spark, sf_dir).select("chrom", "pos", "ref", "alt").withColumn("odd", F.col("pos") % 2)
    RU.load_with_rollup(a.where("odd = 0"), path, 3_000_000)
    RU.load_with_rollup(a.where("odd = 1"), path, 3_000_000, mode="append")
    return RU.count_in_range(spark, path, *WIDE_RANGE)


@query
def table_append(spark, sf_dir):
    """A load, an append and an append that the stored schema refuses."""
    path = scratch_path(spark, "append-table")
    a = _alleles(spark, sf_dir).select("chrom", "pos", "ref", "alt", "qual")
    TB.load_table(a.where("qual IS NULL"), path, width=TABLE_BUCKET)
    TB.load_table(a.where("qual IS NOT NULL"), path, width=TABLE_BUCKET, mode="append")
    try:
        TB.load_table(a.withColumn("qual", F.col("qual").cast("string")), path, width=TABLE_BUCKET, mode="append")
        refused = "nothing"
    except ValueError as e:
        refused = str(e).split(": ", 1)[1]
    return TB.read_table(spark, path).groupBy("chrom").agg(F.count(F.lit(1)).alias("n_rows"), F.count("qual").alias("n_qual")) \
        .withColumn("refused", F.lit(refused))


# --- per-allele values -----------------------------------------------------------------

@query
def flatten_rich(spark, sf_dir):
    """AC, AN, a declared list and PL as parsed from full records."""
    scan = rich_scan(spark, sf_dir)
    v = with_typed_info(scan.variants(), scan.header)
    text = lambda c: F.array_join(c.cast("array<string>"), ",")
    first = F.get(F.col("genotypes"), 0)
    return v.select("chrom", "pos", "ref", alt_text("alts").alias("alts"), text(F.col("ac")).alias("ac"), "an",
                    text(F.col("info_typed.RD")).alias("rd"), F.col("info_typed.DB").alias("db"),
                    text(first["pl"]).alias("pl_s1"), F.size("_bad").alias("n_bad"))


@query
def split_fields(spark, sf_dir):
    """Number=A, R and G keys of INFO cut to each allele."""
    scan = rich_scan(spark, sf_dir)
    a = SP.split_fields(scan.variants(), scan.header)
    text = lambda c: F.array_join(F.col(c).cast("array<string>"), ",")
    return a.select("chrom", "pos", "ref", "alt", "allele_idx", F.col("info_AC").alias("ac"), F.col("info_AN").alias("an"),
                    F.col("info_AF").alias("af"), text("info_RD").alias("rd"), text("info_GL").alias("gl"),
                    F.col("info_DB").alias("db"))


@query
def split_sample_fields(spark, sf_dir):
    """GT, PL (by genotype index, haploid calls too) and AD of every sample on each allele's row."""
    scan = rich_scan(spark, sf_dir)
    a = SP.split_sample_fields(scan.variants(), scan.header)
    text = lambda c: F.array_join(F.col(c).cast("array<string>"), ",")
    return a.select("chrom", "pos", "ref", "alt", "allele_idx", "sample", "gt", F.col("fmt_GQ").alias("gq"),
                    text("fmt_PL").alias("pl"), text("fmt_AD").alias("ad"))


@query
def decompose_mnv(spark, sf_dir):
    """Substitutions of several bases as single-base rows that share an event."""
    v = rich_scan(spark, sf_dir).variants()
    d = SP.decompose_substitutions(AL.split_multiallelic(v, keep=("chrom", "pos", "ref", "qual")))
    return d.select("chrom", "pos", "ref", "alt", "allele_idx", "qual", "event_id", "event_offset", "event_parts")


@query
def recompose_mnv(spark, sf_dir):
    """The same rows put together again: the alleles they came from."""
    v = _ordered(rich_scan(spark, sf_dir), "chrom", "pos", "ref", "alts", "qual", "af")
    d = SP.decompose_substitutions(AL.split_multiallelic(v, keep=("ordinal", "chrom", "pos", "ref", "qual")))
    return SP.recompose_substitutions(d, ("ordinal", "allele_idx")).select("chrom", "pos", "ref", "alt", "allele_idx", "qual")


# --- intervals ---------------------------------------------------------------------------

@query
def region_tree_join(spark, sf_dir):
    """Variants and regions by interval trees: no bins."""
    v = _ordered(fixture_scan(spark, sf_dir), "chrom", "pos", "ref")
    regions = part_regions(spark, sf_dir)
    n = I.tree_pairs(v, regions).groupBy("region_id").agg(F.count(F.lit(1)).alias("n"))
    return regions.select("region_id").join(n, "region_id", "left").select(
        "region_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_variants"))


@query
def merged_regions(spark, sf_dir):
    return I.merge_regions(part_regions(spark, sf_dir)).select("chrom", "start", "end", "n_regions")


@query
def region_set_sorted(spark, sf_dir):
    """Variants of many overlapping regions, each once, in coordinate order."""
    v = _ordered(fixture_scan(spark, sf_dir), "chrom", "contig_idx", "pos", "ref", "alts", "qual", "value")
    merged = I.merge_regions(part_regions(spark, sf_dir)).select("chrom", "start", "end")
    out = R.overlapping_any(v, merged, key="ordinal")
    out = with_sorted_ordinal(out, R.coordinate_keys(("value",)), "place")
    return out.select("place", *_record_cols(out))


# --- hashes, texts -------------------------------------------------------------------------

@query
def merkle_shards(spark, sf_dir):
    """``dedup_shards`` by hash trees."""
    base = scratch_path(spark, "shard-runs")
    _run(spark, sf_dir, RECORDS_PER_SHARD, "run-a", base)
    _run(spark, sf_dir, RECORDS_PER_SHARD, "run-b", base)
    _run(spark, sf_dir, 7000, "run-c", base)
    h = C.dedup_shards(C.merkle_hashes(C.block_hashes(S.read_shards(spark, base))))
    return h.select("run_id", "shard_id", "n_records", "shard_hash", "keep", "kept_run")


@query
def merkle_diff(spark, sf_dir):
    """Which blocks differ once a record is changed and the last records are lost."""
    recs = S.shard_records(fixture_scan(spark, sf_dir), RECORDS_PER_SHARD).select(
        F.lit("run-a").alias("run_id"), "shard_id", "ordinal", F.col("value").alias("line"))
    last = recs.agg(F.max("ordinal")).first()[0]
    hurt = recs.where(F.col("ordinal") <= last - 300).withColumn(
        "line", F.when(F.col("ordinal") == DAMAGED, F.concat("line", F.lit("!"))).otherwise(F.col("line")))
    return C.differing_blocks(C.block_hashes(recs), C.block_hashes(hurt))


@query
def preview_text_dirty(spark, sf_dir):
    """Display text of records with very small, missing and unreadable QUAL."""
    v = dirty_scan(spark, sf_dir).head(3000)
    return v.where("qual < 1 OR qual IS NULL").select("ordinal", A.preview_text(v).alias("text"))


@query
def tsv_odd_texts(spark, sf_dir):
    """A point, an empty text, a backslash and a null through a text table and back."""
    path = scratch_path(spark, "odd-tsv")
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    n = F.col("l_linenumber")
    odd = (F.when(n == 1, ".").when(n == 2, "").when(n == 3, None).when(n == 4, "\\.").when(n == 5, "\\\\.").when(n == 6, "..")
           .otherwise(F.col("l_returnflag")))
    E.write_tsv(li.select("l_orderkey", "l_partkey", "l_linenumber", odd.alias("odd")), path)
    return E.read_tsv(spark, path, "l_orderkey long, l_partkey long, l_linenumber int, odd string")


@query
def read_shard_runs(spark, sf_dir):
    """Records per run and contig, flattened from the shards of two committed runs."""
    base = scratch_path(spark, "two-runs")
    scan = fixture_scan(spark, sf_dir)
    for name, region in (("run-a", "chr1"), ("run-b", "chr2:1-20000000")):
        S.shard(spark, None, base, 700, region, run_id=name, scan=scan)
    v = flatten(S.read_shards(spark, base).select(F.col("line").alias("value"), "run_id", "shard_id"), scan.header)
    p = S.read_params(spark, base).select("run_id", "region", "records_per_shard", "records_written")
    n = v.groupBy("run_id", "chrom").agg(F.count(F.lit(1)).alias("n_records"), F.count_distinct("shard_id").alias("n_shards"))
    return n.join(p, "run_id").select("run_id", "chrom", "n_records", "n_shards", "region", "records_per_shard", "records_written")
