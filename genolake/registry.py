"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

All queries start from the fixture VCF rendered from ``lineitem`` (see
``sources/fixture.py``), written once per session as text and scanned with
``spark.read.text`` - the same path a real VCF takes.  Output columns are
aliased to the names the DuckDB twins in ``oracle.py`` use.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import aggregate as A
from .operators import alleles as AL
from .operators import compare as C
from .operators import quality as Q
from .operators import regions as R
from .operators.flatten import alt_text, flatten
from .operators.ordinal import SPLIT_COLS, with_ordinal, with_sorted_ordinal
from .plans import export as E
from .plans import shard as S
from .plans import table as TB
from .plans.summary import summarize
from .session import scratch_path, session_key
from .streaming.incremental import read_loaded, start_incremental_load
from .sources.dirty import materialize_dirty_vcf
from .sources.fixture import materialize_fixture_vcf
from .sources.scan import VcfScan, open_vcf

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Fixed parameters of the registered queries.
RANGE = (10_000_000, 20_000_000)
WIDE_RANGE = (500_000, 20_000_000)
REGION = "chr3:10000000-20000000"
REGION_SET = ["chr1:10000000-20000000", "chr1:15000000-25000000", "chr2:1-5000000"]
EMPTY_REGION = "chrUn"
RECORDS_PER_SHARD = 5000
QUAL_MIN = 50000.0
AF_RANGE = (0.02, 0.04)
AF_BIN = 0.05
LIMIT = 1000
PREVIEW = 10
READ_SHARD = 3
TABLE_BUCKET = 10_000_000  # coordinate bucket of the loaded table (folders per contig ~ 45M / this)


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


_SCANS: dict[tuple, VcfScan] = {}


def fixture_scan(spark: SparkSession, sf_dir: str) -> VcfScan:
    """The fixture VCF, opened once per session and path (header read once)."""
    path = materialize_fixture_vcf(spark, sf_dir)
    key = (session_key(spark), path)
    if key not in _SCANS:
        _SCANS[key] = open_vcf(spark, path)
    return _SCANS[key]


def _ordered(scan: VcfScan, *cols: str, region=None) -> DataFrame:
    """Records with file-order ``ordinal``; only ``cols`` are parsed and written for it (default: the wide record)."""
    v = scan.variants(region, with_split=True)
    return with_ordinal(v.select(*cols, *SPLIT_COLS) if cols else v)


def _record_cols(v: DataFrame) -> list:
    return [F.col("chrom"), F.col("pos"), F.col("ref"), alt_text("alts").alias("alts"), F.col("qual")]


# --- scans, flatten, typing -------------------------------------------------

@query
def scan_variants(spark, sf_dir):
    v = fixture_scan(spark, sf_dir).variants()
    return v.select("chrom", "pos", "id", "ref", alt_text("alts").alias("alts"), "qual",
                    F.array_join("filters", ";").alias("filter"), F.size("alts").alias("n_alts"),
                    F.col("raw_len").cast("long").alias("raw_len"))


@query
def scan_empty(spark, sf_dir):
    v = fixture_scan(spark, sf_dir).variants(EMPTY_REGION)
    return v.select("chrom", "pos", "id", "ref", alt_text("alts").alias("alts"), "qual",
                    F.array_join("filters", ";").alias("filter"), F.size("alts").alias("n_alts"),
                    F.col("raw_len").cast("long").alias("raw_len"))


@query
def flatten_fixed(spark, sf_dir):
    v = fixture_scan(spark, sf_dir).variants()
    return v.select("chrom", F.col("contig_idx").cast("long").alias("contig_idx"), "pos", "id", "ref",
                    alt_text("alts").alias("alts"), "qual", F.array_join("filters", ";").alias("filter"),
                    F.col("info_text").alias("info"), F.size("filters").alias("n_filters"))


@query
def flatten_info(spark, sf_dir):
    v = fixture_scan(spark, sf_dir).variants()
    return v.select("chrom", "pos", "ref", F.size("info").alias("n_info_keys"),
                    F.get("af", 0).alias("af1"), F.get("af", 1).alias("af2"), F.size("af").alias("n_af"),
                    F.map_contains_key("info", "DB").alias("has_db"))


@query
def flatten_genotypes(spark, sf_dir):
    v = fixture_scan(spark, sf_dir).variants()
    g = F.col("genotypes")
    cols = []
    for i in range(3):
        cols += [F.get(g, i)["gt"].alias(f"gt_s{i + 1}"), F.get(g, i)["gq"].alias(f"gq_s{i + 1}")]
    return v.select("chrom", "pos", "ref", F.size(g).alias("n_samples"), F.col("format"), *cols)


@query
def typed_rejects(spark, sf_dir):
    v = fixture_scan(spark, sf_dir).variants()
    g = F.col("genotypes")
    return v.agg(
        F.count(F.lit(1)).alias("n_records"),
        F.count_if(F.size("_bad") > 0).alias("records_with_bad_fields"),
        F.count_if(F.col("qual").isNull()).alias("missing_qual"),
        F.count_if(F.array_contains("_bad", "qual")).alias("bad_qual"),
        F.count_if(F.array_contains("_bad", "AF")).alias("bad_af"),
        F.coalesce(F.sum(F.size(F.filter(g, lambda x: x["gq"].isNull()))), F.lit(0)).cast("long")
        .alias("missing_gq"),
        F.coalesce(F.sum(F.size(F.filter(g, lambda x: x["bad"]))), F.lit(0)).cast("long").alias("bad_gq"))


@query
def header_summary(spark, sf_dir):
    scan = fixture_scan(spark, sf_dir)
    h = scan.header
    return scan.body().agg(F.count(F.lit(1)).alias("n_records")).select(
        F.lit(h.version).alias("version"), F.lit(len(h.samples)).alias("n_samples"),
        F.lit(",".join(h.samples[:5])).alias("samples"), F.lit(len(h.contigs)).alias("n_contigs"),
        F.lit(len(h.info)).alias("n_info"), F.lit(len(h.format)).alias("n_format"), "n_records")


# --- filters, projections, regions -------------------------------------------

@query
def count_in_range(spark, sf_dir):
    return A.count_in_range(fixture_scan(spark, sf_dir).variants(), *RANGE)


@query
def region_scan(spark, sf_dir):
    v = fixture_scan(spark, sf_dir).variants(REGION)
    return v.select(*_record_cols(v))


@query
def filter_quality(spark, sf_dir):
    v = fixture_scan(spark, sf_dir).variants()
    return v.where(F.col("qual") >= QUAL_MIN).select(*_record_cols(v))


@query
def project_core(spark, sf_dir):
    return fixture_scan(spark, sf_dir).variants().select("chrom", "pos", "ref", "qual")


@query
def region_set_semi(spark, sf_dir):
    v = fixture_scan(spark, sf_dir).variants()
    out = R.overlapping_any(v, R.regions_frame(spark, REGION_SET))
    return out.select(*_record_cols(out))


@query
def region_set_counts(spark, sf_dir):
    v = fixture_scan(spark, sf_dir).variants()
    return R.region_counts(v, R.regions_frame(spark, REGION_SET)).select("region_id", "region", "n_variants")


def part_regions(spark, sf_dir) -> DataFrame:
    """One region per ``part`` row: a large region set that grows with the data."""
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    start = (F.col("p_partkey") * 7919) % 45000000 + 1
    return p.select(F.col("p_partkey").alias("region_id"),
                    F.concat(F.lit("chr"), (F.col("p_partkey") % 22 + 1).cast("string")).alias("chrom"),
                    start.alias("start"), (start + F.col("p_size").cast("long") * 1000).alias("end"))


@query
def region_join_parts(spark, sf_dir):
    v = fixture_scan(spark, sf_dir).variants()
    return R.region_counts(v, part_regions(spark, sf_dir)).select("region_id", "n_variants")


@query
def region_semi_parts(spark, sf_dir):
    v = _ordered(fixture_scan(spark, sf_dir), "chrom", "pos", "ref", "alts", "qual")
    out = R.overlapping_any(v, part_regions(spark, sf_dir), key="ordinal")
    return out.select("ordinal", *_record_cols(out))


# --- alleles and genotypes -----------------------------------------------------

def _alleles(spark, sf_dir) -> DataFrame:
    v = fixture_scan(spark, sf_dir).variants()
    return AL.split_multiallelic(v, keep=("chrom", "pos", "ref", "qual", "filters"))


@query
def split_multiallelic(spark, sf_dir):
    a = _alleles(spark, sf_dir)
    return a.select("chrom", "pos", "ref", "alt", "allele_idx", "af", "qual",
                    F.array_join("filters", ";").alias("filter"))


@query
def normalize_alleles(spark, sf_dir):
    a = AL.normalize_alleles(_alleles(spark, sf_dir))
    return a.select("chrom", "pos", "ref", "alt", "orig_pos", "allele_idx")


@query
def allele_class_counts(spark, sf_dir):
    return AL.allele_class_counts(_alleles(spark, sf_dir))


@query
def filter_af(spark, sf_dir):
    a = _alleles(spark, sf_dir)
    return a.where(F.col("af").between(*AF_RANGE)).select("chrom", "pos", "ref", "alt", "af")


@query
def af_bins(spark, sf_dir):
    a = _alleles(spark, sf_dir)
    return (a.groupBy(F.floor(F.col("af") / F.lit(AF_BIN)).cast("long").alias("af_bin"))
            .agg(F.count(F.lit(1)).alias("n_alleles")))


@query
def genotype_class_counts(spark, sf_dir):
    scan = fixture_scan(spark, sf_dir)
    out = AL.genotype_class_counts(scan.variants(), scan.header.samples)
    return out.select("sample", "gt_class", "n_genotypes")


@query
def genotypes_long(spark, sf_dir):
    scan = fixture_scan(spark, sf_dir)
    return AL.genotypes_long(scan.variants(), scan.header.samples).select(
        "chrom", "pos", "ref", "sample", "gt", "gq")


# --- aggregates and summaries --------------------------------------------------

@query
def stream_summary(spark, sf_dir):
    return A.stream_summary(fixture_scan(spark, sf_dir).variants())


@query
def count_by_chrom(spark, sf_dir):
    return A.count_by_chrom(fixture_scan(spark, sf_dir).variants())


@query
def stage_counts(spark, sf_dir):
    scan = fixture_scan(spark, sf_dir)
    return A.stage_counts(scan.lines, scan.header)


# --- order, limit, preview -------------------------------------------------------

@query
def preview_text(spark, sf_dir):
    v = fixture_scan(spark, sf_dir).head(PREVIEW)
    return v.select("ordinal", A.preview_text(v).alias("text"))


@query
def limit_variants(spark, sf_dir):
    v = fixture_scan(spark, sf_dir).head(LIMIT)
    return v.select("ordinal", *_record_cols(v))


@query
def coordinate_sorted(spark, sf_dir):
    return Q.coordinate_order_report(_ordered(fixture_scan(spark, sf_dir), "contig_idx", "chrom", "pos"))


# --- sharding ---------------------------------------------------------------------

@query
def shard_manifest(spark, sf_dir):
    recs = S.shard_records(fixture_scan(spark, sf_dir), RECORDS_PER_SHARD)
    return S.manifest_of(recs).select("shard_id", "shard_name", "n_records", "first_ordinal", "last_ordinal",
                                      "first_chrom", "first_pos", "last_chrom", "last_pos")


def _run(spark, sf_dir, records_per_shard=RECORDS_PER_SHARD, run_id="run-a", base=None):
    base = base or scratch_path(spark, "shard-runs")
    S.shard(spark, None, base, records_per_shard, run_id=run_id, scan=fixture_scan(spark, sf_dir))
    return base


@query
def shard_names(spark, sf_dir):
    base = _run(spark, sf_dir)
    recs = S.read_shards(spark, base, "run-a")
    return (recs.groupBy("shard_id").agg(F.count(F.lit(1)).alias("n_records"))
            .select(F.format_string(S.SHARD_NAME, F.col("shard_id")).alias("shard_name"), "n_records"))


@query
def read_shard(spark, sf_dir):
    base = _run(spark, sf_dir)
    s = S.read_shards(spark, base, "run-a", READ_SHARD)
    v = flatten(s.select(F.col("line").alias("value"), "ordinal"), None)
    return v.select("ordinal", *_record_cols(v))


@query
def shard_validation(spark, sf_dir):
    base = _run(spark, sf_dir)
    total = S.read_manifest(spark, base, "run-a").agg(F.sum("n_records")).first()[0]
    return Q.shard_validation(S.read_shards(spark, base, "run-a"), RECORDS_PER_SHARD, total)


@query
def dedup_shards(spark, sf_dir):
    base = scratch_path(spark, "shard-runs")
    _run(spark, sf_dir, RECORDS_PER_SHARD, "run-a", base)
    _run(spark, sf_dir, RECORDS_PER_SHARD, "run-b", base)
    _run(spark, sf_dir, 7000, "run-c", base)
    h = C.dedup_shards(C.shard_hashes(S.read_shards(spark, base)))
    return h.select("run_id", "shard_id", "n_records", "shard_hash", "keep", "kept_run")


# --- loads and exports -------------------------------------------------------------

@query
def load_variants(spark, sf_dir):
    path = scratch_path(spark, "variants-table")
    a = _alleles(spark, sf_dir).select("chrom", "pos", "ref", "alt", "allele_idx", "af", "qual")
    TB.load_table(a, path, width=TABLE_BUCKET)
    t = TB.read_table(spark, path)
    return (t.where(TB.range_filter(*RANGE, width=TABLE_BUCKET))
            .groupBy("chrom").agg(F.count(F.lit(1)).alias("variants")))


TSV_SCHEMA = "chrom string, pos long, ref string, alt string, allele_idx int, af double, qual double"


@query
def tsv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "alleles-tsv")
    a = _alleles(spark, sf_dir).select("chrom", "pos", "ref", "alt", "allele_idx", "af", "qual")
    E.write_tsv(a, path)
    return E.read_tsv(spark, path, TSV_SCHEMA)


@query
def parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "variants-parquet")
    v = fixture_scan(spark, sf_dir).variants()
    E.write_columnar(v.select("chrom", "pos", "ref", "alts", "qual", "genotypes"), path, "parquet")
    back = spark.read.parquet(path)
    return back.select("chrom", "pos", "ref", alt_text("alts").alias("alts"), "qual",
                       F.size("genotypes").alias("n_samples"))


@query
def schema_evolution(spark, sf_dir):
    base = scratch_path(spark, "schema-evolution")
    v = fixture_scan(spark, sf_dir).variants()
    v.select("chrom", "pos", "ref", "qual").write.parquet(f"{base}/schema_version=1")
    v.select("chrom", "pos", "ref", "qual", "af").where(F.col("qual").isNotNull()) \
        .write.parquet(f"{base}/schema_version=2")
    t = spark.read.option("mergeSchema", "true").parquet(base)
    return t.groupBy(F.col("schema_version").cast("int").alias("schema_version")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("af").isNotNull()).alias("n_with_af"))


# --- comparisons and quality ------------------------------------------------------

def _pass_and_qual(spark, sf_dir):
    v = fixture_scan(spark, sf_dir).variants()
    a = AL.normalize_alleles(AL.split_multiallelic(v, keep=("chrom", "pos", "ref", "qual", "filters")))
    before = a.where(F.array_contains("filters", "PASS"))
    after = a.where(F.col("qual").isNotNull())
    return before, after


@query
def join_alleles(spark, sf_dir):
    calls, known = _pass_and_qual(spark, sf_dir)
    j = C.annotate_by_allele(calls, known)
    return j.groupBy("chrom").agg(F.count(F.lit(1)).alias("n_alleles"),
                                  F.count_if(F.col("n_known") > 0).alias("n_matched"),
                                  F.sum("n_known").cast("long").alias("n_known_rows"))


@query
def snapshot_diff(spark, sf_dir):
    before, after = _pass_and_qual(spark, sf_dir)
    d = C.snapshot_diff(before, after, payload=("qual", "af"))
    return d.groupBy("change").agg(F.count(F.lit(1)).alias("n_keys"),
                                   F.sum("n_before").cast("long").alias("n_before"),
                                   F.sum("n_after").cast("long").alias("n_after"))


@query
def orphan_rows(spark, sf_dir):
    v = _ordered(fixture_scan(spark, sf_dir), "alts", "af")
    a = AL.split_multiallelic(v, keep=("ordinal",))
    return Q.orphan_rows(v, a)


@query
def info_violations(spark, sf_dir):
    scan = fixture_scan(spark, sf_dir)
    return Q.info_violations(scan.variants(), scan.header)


@query
def completeness(spark, sf_dir):
    return Q.completeness(fixture_scan(spark, sf_dir).variants())




# --- the faulty fixture: every check finds something --------------------------------

def dirty_scan(spark: SparkSession, sf_dir: str) -> VcfScan:
    path = materialize_dirty_vcf(spark, sf_dir)
    key = (session_key(spark), path)
    if key not in _SCANS:
        _SCANS[key] = open_vcf(spark, path)
    return _SCANS[key]


@query
def typed_rejects_dirty(spark, sf_dir):
    v = dirty_scan(spark, sf_dir).variants()
    g = F.col("genotypes")
    return v.agg(
        F.count(F.lit(1)).alias("n_records"),
        F.count_if(F.size("_bad") > 0).alias("records_with_bad_fields"),
        F.count_if(F.col("qual").isNull()).alias("missing_qual"),
        F.count_if(F.array_contains("_bad", "qual")).alias("bad_qual"),
        F.count_if(F.array_contains("_bad", "pos")).alias("bad_pos"),
        F.count_if(F.array_contains("_bad", "AF")).alias("bad_af"),
        F.count_if(F.array_contains("_bad", "INFO")).alias("repeated_info"),
        F.sum(F.size(F.filter(g, lambda x: x["gq"].isNull()))).cast("long").alias("missing_gq"),
        F.sum(F.size(F.filter(g, lambda x: x["bad"]))).cast("long").alias("bad_gq"))


@query
def info_violations_dirty(spark, sf_dir):
    scan = dirty_scan(spark, sf_dir)
    return Q.info_violations(scan.variants(), scan.header)


@query
def coordinate_sorted_dirty(spark, sf_dir):
    return Q.coordinate_order_report(_ordered(dirty_scan(spark, sf_dir), "contig_idx", "chrom", "pos"))


@query
def genotype_class_counts_dirty(spark, sf_dir):
    scan = dirty_scan(spark, sf_dir)
    return AL.genotype_class_counts(scan.variants(), scan.header.samples).select("sample", "gt_class", "n_genotypes")


LOST, DOUBLED = (997, 5), (701, 3)  # ordinals by remainder


def _damaged(records: DataFrame) -> DataFrame:
    o = F.col("ordinal")
    return records.where(o % LOST[0] != LOST[1]).unionByName(records.where(o % DOUBLED[0] == DOUBLED[1]))


@query
def shard_validation_dirty(spark, sf_dir):
    recs = S.shard_records(dirty_scan(spark, sf_dir), RECORDS_PER_SHARD)
    total = recs.agg(F.max("ordinal")).first()[0] + 1
    return Q.shard_validation(_damaged(recs), RECORDS_PER_SHARD, total)


@query
def orphan_rows_dirty(spark, sf_dir):
    v = _ordered(fixture_scan(spark, sf_dir), "alts", "af")
    a = AL.split_multiallelic(v, keep=("ordinal",))
    return Q.orphan_rows(_damaged(v.select("ordinal")), a.where(F.col("ordinal") % 503 != 2))


# --- more of the same operators ------------------------------------------------------

FAR = 3_000_000_000


@query
def region_join_far(spark, sf_dir):
    """Positions past 2^31 and open-ended regions, by the binned join."""
    v = fixture_scan(spark, sf_dir).variants().select("chrom", (F.col("pos") + FAR).alias("pos"), "ref")
    regions = R.regions_frame(spark, [f"chr1:{FAR + 1000}-", "chr2", f"chr3:{FAR}-{FAR + 10_000_000}", "chr4:1-1000"])
    return R.region_counts(v, regions, small_max=0, bin_width=1_000_000).select("region_id", "chrom", "n_variants")


@query
def table_range_read(spark, sf_dir):
    path = scratch_path(spark, "range-table")
    a = _alleles(spark, sf_dir).select(F.substring("chrom", 4, 2).alias("chrom"), "pos", "ref", "alt")
    TB.load_table(a, path, width=3_000_000)
    return TB.read_range(spark, path, *WIDE_RANGE).groupBy("chrom").agg(F.count(F.lit(1)).alias("variants"))


@query
def incremental_load(spark, sf_dir):
    """Two runs and a redo, loaded by three calls with default settings; a run that was not committed stays out."""
    base, out = scratch_path(spark, "incremental-runs"), scratch_path(spark, "incremental-alleles")
    scan = fixture_scan(spark, sf_dir)
    S.shard(spark, None, base, 9000, "chr1", run_id="run-a", scan=scan)
    start_incremental_load(spark, base, out, header=scan.header).awaitTermination()
    S.shard(spark, None, base, 9000, "chr2", run_id="run-b", scan=scan)
    (S.shard_records(scan, 9000, "chr3").select("shard_id", "ordinal", F.col("value").alias("line"), "raw_len", "chrom",
                                               "contig_idx", "pos", "ref")
     .write.partitionBy("shard_id").parquet(f"{base}/shards/run_id=run-c"))
    start_incremental_load(spark, base, out, header=scan.header).awaitTermination()
    S.shard(spark, None, base, 9000, "chr4", run_id="run-a", scan=scan, redo=True)
    start_incremental_load(spark, base, out, header=scan.header).awaitTermination()
    return read_loaded(spark, out).groupBy("run_id", "chrom").agg(F.count(F.lit(1)).alias("n_alleles"))


@query
def coordinate_sort(spark, sf_dir):
    """Records in hash order sorted again: numbered by their place in the sorted partitions."""
    v = fixture_scan(spark, sf_dir).variants().select("chrom", "contig_idx", "pos", "ref", "value")
    out = with_sorted_ordinal(v.repartition(16, "ref", "pos"), R.coordinate_keys(("value",)))
    return out.select("ordinal", "chrom", "pos", "ref")


@query
def summary_by_chrom(spark, sf_dir):
    """The summary job's ``chromosomes`` map, as rows, with its totals."""
    out = summarize(spark, materialize_fixture_vcf(spark, sf_dir), preview=0)
    rows = [(c, n, out["total_variants"], out["total_bytes"]) for c, n in out["chromosomes"].items()]
    return spark.createDataFrame(rows, "chrom string, variants long, total_variants long, total_bytes long")


@query
def load_genotypes(spark, sf_dir):
    """The genotype table: partitioned like the allele table, read back by range."""
    scan = fixture_scan(spark, sf_dir)
    path = scratch_path(spark, "genotype-table")
    g = AL.genotypes_long(scan.variants(), scan.header.samples).select("chrom", "pos", "ref", "sample", "gt", "gq")
    TB.load_table(g, path, width=TABLE_BUCKET)
    return TB.read_range(spark, path, *WIDE_RANGE).select("chrom", "pos", "ref", "sample", "gt", "gq")


@query
def columnar_per_shard(spark, sf_dir):
    """A run's shards as columnar files, genotypes included, a folder for each shard."""
    base = _run(spark, sf_dir)
    v = flatten(S.read_shards(spark, base, "run-a").select(F.col("line").alias("value"), "shard_id", "ordinal"), None)
    path = f"{base}/columnar/run_id=run-a"
    E.write_columnar(v.select("shard_id", "ordinal", "chrom", "pos", "ref", "alts", "qual", "genotypes"), path)
    return spark.read.parquet(path).groupBy("shard_id").agg(
        F.count(F.lit(1)).alias("n_records"), F.min("ordinal").alias("first_ordinal"),
        F.sum(F.size("genotypes")).cast("long").alias("n_genotypes"))


@query
def tsv_per_shard(spark, sf_dir):
    """A run's shards as text tables with their genotype columns, read back."""
    base = _run(spark, sf_dir)
    v = flatten(S.read_shards(spark, base, "run-a").select(F.col("line").alias("value"), "shard_id", "ordinal"), None)
    path = f"{base}/tsv/run_id=run-a"
    flat = E.write_tsv(v.select("shard_id", "chrom", "pos", "ref", "af", "genotypes"), path, partition_by=("shard_id",))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in flat.schema.fields if f.name != "shard_id")
    t = E.read_tsv(spark, path, schema + ", shard_id int")
    return t.select("shard_id", "chrom", "pos", "ref", "genotypes_gt")


from . import registry_tables  # noqa: E402,F401  (adds its queries to QUERIES)
