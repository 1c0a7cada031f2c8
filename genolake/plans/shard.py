"""The shard job (K1-K5, K3, S6): consecutive records -> fixed-size shards + manifest.

Layout under ``base`` (append-only; ``<f>`` is the run id, with a suffix for a redo)::

    shards/run_id=<f>/shard_id=<k>/part-*.parquet    records: ordinal, line, chrom, pos, ...
    headers/run_id=<f>/part-*.json                   the VCF header lines, once per run (K3)
    manifests/run_id=<f>/part-*.json                 one row per shard (K4)
    zones/run_id=<f>/part-*.parquet                  coordinate range of each contig in each shard (S4)
    params/run_id=<f>/part-*.json                    the run's parameters
    commits/v=<n>/part-*.json                        the log of committed runs, written last (plans/commits.py)

Plan shape: ``with_ordinal`` writes the records once with their input split and
numbers them by a broadcast of the splits' offsets (counted first; beyond a
million splits a shuffle join), so the partitioned write that follows has no
shuffle: a shard that straddles two input splits gets two files in its folder.
``compact=True`` instead shuffles on ``shard_id`` to get exactly one file per
shard (the reference's one-file-per-shard form).

Readers take a run's folder from the log, never from a listing: runs that are
half-written, replaced or removed are not seen, and a reader that fixed a
version keeps its snapshot while redos go on.
"""

from __future__ import annotations

import re
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.region import overlaps, parse_region
from ..operators.flatten import flatten
from ..operators.ordinal import with_ordinal, with_shard_id
from ..session import discard, scratch_path
from ..sources.scan import VcfScan, open_vcf
from ..sources.vcf_text import DEFAULT_REMOTE_SCHEMES, naming_source
from . import commits as L
from .inventory import resolve_sink, safe_join
from .zones import ZONE_SCHEMA, zone_columns

RUN_ID_FORMAT = "%Y-%m-%d_%H-%M-%S"
# Columns of a shard file; ``shard_id`` (and ``run_id`` when reading a base)
# come from folder names.  Explicit so that empty runs read back too.
SHARD_FILE_SCHEMA = ("ordinal long, line string, raw_len int, chrom string, contig_idx int, pos long, "
                     "ref string, shard_id int")
SHARD_SCHEMA = SHARD_FILE_SCHEMA + ", run_id string"
SHARD_NAME = "shard_%04d"


def new_run_id(now: datetime | None = None) -> str:
    return (now or datetime.now()).strftime(RUN_ID_FORMAT)


def checked_run_id(run_id: str) -> str:
    """A run id is one folder name: letters, digits, ``.``, ``_`` and ``-``."""
    if not re.fullmatch(r"[A-Za-z0-9._-]+", run_id) or set(run_id) == {"."}:
        raise ValueError(f"invalid run id: {run_id!r}")
    return run_id


def shard_records(scan: VcfScan, records_per_shard: int = 10000, region=None,
                  use_info_end: bool = False, path: str | None = None) -> DataFrame:
    """Records with ``ordinal`` and ``shard_id`` (the source is read once, by ``with_ordinal``; ``path``: its scratch folder).

    A region is judged by the bases of REF, or by INFO/END where a record has
    it and ``use_info_end`` is set."""
    if records_per_shard is None or int(records_per_shard) <= 0:
        raise ValueError(f"records_per_shard must be a positive integer, got {records_per_shard!r}")
    r = parse_region(region, scan.header.contigs) if isinstance(region, str) else region
    v = flatten(scan.body(r, with_split=True), scan.header)
    if r is not None:
        v = v.where(overlaps(r, info="info" if use_info_end else None))
    v = v.select("value", "raw_len", "chrom", "contig_idx", "pos", "ref", "_split_file", "_split_start")
    return with_shard_id(with_ordinal(v, path=path), records_per_shard)


def manifest_of(records: DataFrame, shards_path: str | None = None) -> DataFrame:
    """One row per shard: counts, ordinal range, first/last coordinate, name, path."""
    m = records.groupBy("shard_id").agg(
        F.count(F.lit(1)).alias("n_records"),
        F.min("ordinal").alias("first_ordinal"),
        F.max("ordinal").alias("last_ordinal"),
        F.min_by("chrom", "ordinal").alias("first_chrom"),
        F.min_by("pos", "ordinal").alias("first_pos"),
        F.max_by("chrom", "ordinal").alias("last_chrom"),
        F.max_by("pos", "ordinal").alias("last_pos"),
        F.sum("raw_len").cast("long").alias("n_bytes"))
    return _named(m, shards_path)


def zones_and_edges(records: DataFrame) -> DataFrame:
    """``shard_zones`` with what the manifest needs of each (shard, contig): one pass, numbers only in its buffers."""
    return records.groupBy("shard_id", "chrom").agg(
        *zone_columns(), F.min("ordinal").alias("first_ordinal"), F.max("ordinal").alias("last_ordinal"),
        F.min_by("pos", "ordinal").alias("first_pos"), F.max_by("pos", "ordinal").alias("last_pos"),
        F.sum("raw_len").cast("long").alias("n_bytes"))


def manifest_of_zones(zones: DataFrame, shards_path: str | None = None) -> DataFrame:
    """``manifest_of`` from the rows of ``zones_and_edges``, a few a shard."""
    m = zones.groupBy("shard_id").agg(
        F.sum("n_records").alias("n_records"),
        F.min("first_ordinal").alias("first_ordinal"),
        F.max("last_ordinal").alias("last_ordinal"),
        F.min_by("chrom", "first_ordinal").alias("first_chrom"),
        F.min_by("first_pos", "first_ordinal").alias("first_pos"),
        F.max_by("chrom", "last_ordinal").alias("last_chrom"),
        F.max_by("last_pos", "last_ordinal").alias("last_pos"),
        F.sum("n_bytes").cast("long").alias("n_bytes"))
    return _named(m, shards_path)


def _named(m: DataFrame, shards_path: str | None) -> DataFrame:
    """A manifest with the shards' names and paths."""
    m = m.withColumn("shard_name", F.format_string(SHARD_NAME, F.col("shard_id")))
    if shards_path:
        m = m.withColumn("path", F.concat(F.lit(shards_path.rstrip("/") + "/shard_id="),
                                          F.col("shard_id").cast("string")))
    return m


def shard(spark: SparkSession, source, base: str, records_per_shard: int = 10000, region=None,
          run_id: str | None = None, compact: bool = False, scan: VcfScan | None = None,
          redo: bool = False, use_info_end: bool = False, remote_schemes=DEFAULT_REMOTE_SCHEMES,
          sink: str = "local") -> DataFrame:
    """Run the shard job (see ``_shard``); a read failure is an ``IOError`` that names the source (S5)."""
    with naming_source(source, "shard"):
        return _shard(spark, source, base, records_per_shard, region, run_id, compact, scan, redo, use_info_end,
                      remote_schemes, sink)


def _shard(spark, source, base, records_per_shard, region, run_id, compact, scan, redo, use_info_end, remote_schemes,
           sink) -> DataFrame:
    """Run the shard job; returns the manifest DataFrame (read back from disk).

    A repeated run id fails instead of overwriting.  ``redo=True`` deliberately
    replaces a run: its data go to a new folder, and readers change over to it
    with the commit at the end; other runs are untouched.
    """
    resolve_sink(sink)
    run_id = checked_run_id(run_id or new_run_id())
    scan = scan or open_vcf(spark, source, remote_schemes)
    base = base.rstrip("/")
    state = L.run_state(spark, base, run_id)
    if state and not redo:
        raise FileExistsError(f"run {run_id} is committed already (version {state['version']}); redo=True replaces it")
    folder = L.new_folder(run_id, redo)
    shards_path, headers_path, manifests_path, zones_path, params_path = (
        safe_join(base, f"{kind}/run_id={folder}") for kind in ("shards", "headers", "manifests", "zones", "params"))
    numbered = scratch_path(spark, "ordinals")
    recs = shard_records(scan, records_per_shard, region, use_info_end, numbered)
    out = recs.select("shard_id", "ordinal", F.col("value").alias("line"), "raw_len",
                      "chrom", "contig_idx", "pos", "ref")
    if compact:
        out = out.repartition("shard_id")
    # Row count of the write, observed in the same job (A8); compared with
    # the manifest read back from disk before the run is committed.
    obs = Observation(f"shard-{run_id}")
    out = out.observe(obs, F.count(F.lit(1)).alias("records_written"))
    (out.sortWithinPartitions("shard_id", "ordinal")
     .write.mode("errorifexists").option("compression", "zstd").partitionBy("shard_id").parquet(shards_path))
    written_rows = int(obs.get.get("records_written", 0))
    discard(spark, numbered)  # as large as the shards; from here on only those are read
    header = spark.createDataFrame([(i, ln) for i, ln in enumerate(scan.header.lines)], "line_no int, line string")
    header.coalesce(1).write.mode("errorifexists").json(headers_path)
    written = spark.read.schema(SHARD_FILE_SCHEMA).parquet(shards_path)
    zones = zones_and_edges(written)
    zones.write.mode("errorifexists").parquet(zones_path)
    zones = spark.read.schema(zones.schema).parquet(zones_path)
    manifest_of_zones(zones, shards_path).write.mode("errorifexists").json(manifests_path)
    manifest = spark.read.schema(MANIFEST_SCHEMA).json(manifests_path)
    totals = manifest.agg(F.count(F.lit(1)).alias("shards"), F.coalesce(F.sum("n_records"), F.lit(0)).alias("n")).first()
    if int(totals["n"]) != written_rows:
        raise RuntimeError(f"run {run_id}: {written_rows} records written but {totals['n']} read back")
    params = spark.createDataFrame(
        [(run_id, folder, str(source), int(records_per_shard), str(region) if region else None,
          datetime.now(timezone.utc).replace(tzinfo=None), bool(compact), written_rows)], PARAMS_SCHEMA)
    params.coalesce(1).write.mode("errorifexists").json(params_path)
    L.commit(spark, base, run_id, "replace" if state else "add", folder, totals["shards"], written_rows)
    return read_manifest(spark, base, run_id)


PARAMS_SCHEMA = ("run_id string, folder string, source string, records_per_shard int, region string, finished_at timestamp_ntz, "
                 "compact boolean, records_written long")
MANIFEST_SCHEMA = ("shard_id int, n_records long, first_ordinal long, last_ordinal long, first_chrom string, "
                   "first_pos long, last_chrom string, last_pos long, n_bytes long, shard_name string, "
                   "path string")


def _of_runs(spark: SparkSession, base: str, kind: str, schema: str, fmt: str, run_id: str | None, version: int | None,
             max_listed_runs: int = 10_000, inside: str = "") -> DataFrame:
    """Rows of one kind of file of the committed runs, with ``run_id``; ``inside``: a folder of each run's.

    The folders come from the log: those of one run, or of all runs if they
    are at most ``max_listed_runs``; beyond that all folders are listed and
    joined with the log.
    """
    log = L.read_log(spark, base)
    if run_id is not None:
        log = log.where(F.col("run_id") == checked_run_id(run_id))
    runs = L.runs_at(log, version).where("n_shards > 0" if kind == "shards" else "true").select("run_id", "folder")
    listed = runs.limit(max_listed_runs + 1).collect()
    if not listed:
        return spark.createDataFrame([], f"{schema}, run_id string")
    root = f"{base.rstrip('/')}/{kind}"
    reader = spark.read.format(fmt).schema(f"{schema}, run_id string").option("basePath", root)
    if len(listed) > max_listed_runs:
        df = reader.load(root).withColumnRenamed("run_id", "_folder")
        return df.join(runs, df["_folder"] == runs["folder"]).drop("_folder", "folder")
    df = reader.load([f"{root}/run_id={r['folder']}{inside}" for r in listed])
    renamed = {r["folder"]: r["run_id"] for r in listed if r["folder"] != r["run_id"]}
    if renamed:  # redone runs: the folder's name gives way to the run's
        names = F.create_map(*[F.lit(x) for kv in renamed.items() for x in kv])
        df = df.withColumn("run_id", F.coalesce(F.try_element_at(names, F.col("run_id")), F.col("run_id")))
    return df


def read_params(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """Parameters and observed counts of every committed run."""
    runs = L.runs_at(L.read_log(spark, base), version)
    if runs.isEmpty():
        return spark.createDataFrame([], PARAMS_SCHEMA)
    rows = spark.read.schema(PARAMS_SCHEMA).option("recursiveFileLookup", "true").json(f"{base.rstrip('/')}/params")
    return rows.join(runs.select("folder"), "folder", "left_semi")


def read_manifest(spark: SparkSession, base: str, run_id: str | None = None, version: int | None = None) -> DataFrame:
    """Manifest rows (all committed runs, or one run) with ``run_id``."""
    return _of_runs(spark, base, "manifests", MANIFEST_SCHEMA, "json", run_id, version)


def read_zones(spark: SparkSession, base: str, run_id: str | None = None, version: int | None = None) -> DataFrame:
    """Coordinate range of each contig in each shard (see ``plans/zones.py``) with ``run_id``."""
    return _of_runs(spark, base, "zones", ZONE_SCHEMA, "parquet", run_id, version)


def read_shards(spark: SparkSession, base: str, run_id: str | None = None, shard_id: int | None = None,
                version: int | None = None, max_listed_runs: int = 10_000) -> DataFrame:
    """Shard records (S6) of committed runs; ``run_id``/``shard_id`` prune folders.

    ``version`` reads the state of an earlier commit (a snapshot): a redo in
    between changes nothing for this reader.
    """
    df = _of_runs(spark, base, "shards", SHARD_FILE_SCHEMA, "parquet", run_id, version, max_listed_runs)
    return df if shard_id is None else df.where(F.col("shard_id") == int(shard_id))


def read_header_table(spark: SparkSession, base: str, run_id: str) -> DataFrame:
    return _of_runs(spark, base, "headers", "line_no int, line string", "json", run_id, None).select("line_no", "line")


def shard_as_vcf_text(spark: SparkSession, base: str, run_id: str, shard_id: int) -> DataFrame:
    """One shard as VCF lines: the run's header, then its records (K3)."""
    h = read_header_table(spark, base, run_id).select(
        F.lit(0).alias("_part"), F.col("line_no").cast("long").alias("_k"), F.col("line").alias("value"))
    b = read_shards(spark, base, run_id, shard_id).select(
        F.lit(1).alias("_part"), F.col("ordinal").alias("_k"), F.col("line").alias("value"))
    return h.unionByName(b).orderBy("_part", "_k").select("value")
