"""Follow the commit log: committed runs -> allele table (S7).

The stream reads the log's commits (``plans/commits.py``), each once.  A run's
rows go to a folder of their own, ``run_id=<id>/commit=<version>``, and the
table has a log of the same kind: a commit that leaves no records, or a
tombstone, is entered there like any other, so a run that is redone to nothing
disappears from the table, and a run that was never committed never shows.
A batch repeated after a failure finds its commits entered and does nothing.

``read_loaded`` gives the table at its last entry, or at an earlier one.  Once
a run's new rows are entered, the folder they replace is deleted, so that a
plain Parquet read shows the same rows; ``keep_replaced=True`` leaves it for
readers of earlier entries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.alleles import split_multiallelic
from ..operators.flatten import flatten
from ..plans import commits as L
from ..plans.shard import read_shards
from ..sources.vcf_text import VcfHeader


ALLELE_COLUMNS = ("run_id", "shard_id", "ordinal", "chrom", "contig_idx", "pos", "ref", "alt", "allele_idx",
                  "af", "qual", "filters")
LOADED_SCHEMA = ("shard_id int, ordinal long, chrom string, contig_idx int, pos long, ref string, alt string, "
                 "allele_idx int, af double, qual double, filters array<string>, run_id string")


def alleles_of_shards(records: DataFrame, header: VcfHeader | None = None) -> DataFrame:
    """Shard records -> allele rows (T1-T4), stateless, so valid on a stream."""
    v = flatten(records.select(F.col("line").alias("value"), "run_id", "shard_id", "ordinal"), header)
    return split_multiallelic(v, keep=("run_id", "shard_id", "ordinal", "chrom", "contig_idx", "pos", "ref",
                                       "qual", "filters")).select(*ALLELE_COLUMNS)


def _table_log(out_path: str) -> str:
    return f"{out_path.rstrip('/')}/_loaded"


def load_commits(spark: SparkSession, base: str, commits: list[dict], out_path: str, header: VcfHeader | None,
                 keep_replaced: bool = False) -> None:
    """Bring the table up to these commits: per run its last one, entered once."""
    last: dict[str, dict] = {}
    for c in sorted(commits, key=lambda c: c["version"]):
        last[c["run_id"]] = c
    log = _table_log(out_path)
    entered = {r["run_id"]: r for r in L.runs_at(L.read_log(spark, log)).collect()} if last else {}
    done = {r["follows"] for r in L.read_log(spark, log).where(
        F.col("follows").isin([c["version"] for c in last.values()])).collect()}
    for run, c in last.items():
        if c["version"] in done:
            continue
        folder, old = f"{run}/commit={c['version']}", entered.get(run)
        if c["action"] == "remove" or not c["n_records"]:
            L.commit(spark, log, run, "remove", follows=c["version"])
        else:
            rows = alleles_of_shards(read_shards(spark, base, run, version=c["version"]), header).drop("run_id")
            rows.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/run_id={folder}")
            L.commit(spark, log, run, "replace" if old else "add", folder, c["n_shards"], c["n_records"], c["version"])
        if old and not keep_replaced:
            L.delete_folder(spark, f"{out_path.rstrip('/')}/run_id={old['folder']}")


def read_loaded(spark: SparkSession, out_path: str, version: int | None = None, max_listed_runs: int = 10_000) -> DataFrame:
    """The allele table at an entry of its log (default: the last)."""
    runs = L.runs_at(L.read_log(spark, _table_log(out_path)), version).select("run_id", "folder")
    root = out_path.rstrip("/")
    listed = runs.limit(max_listed_runs + 1).collect()
    if not listed:
        return spark.createDataFrame([], LOADED_SCHEMA)
    reader = spark.read.schema(f"{LOADED_SCHEMA}, commit long").option("basePath", root)
    if len(listed) <= max_listed_runs:
        return reader.parquet(*[f"{root}/run_id={r['folder']}" for r in listed]).drop("commit")
    current = runs.select("run_id", F.substring_index("folder", "=", -1).cast("long").alias("commit"))
    return reader.parquet(root).join(current, ["run_id", "commit"], "left_semi").drop("commit")


def start_incremental_load(spark: SparkSession, base: str, out_path: str, checkpoint: str | None = None,
                           header: VcfHeader | None = None, available_now: bool = True,
                           keep_replaced: bool = False) -> StreamingQuery:
    """Start the stream commit log -> allele table; returns the running query.

    With ``available_now`` (default) it processes what exists and stops
    (``query.awaitTermination()``); otherwise it keeps polling.  The default
    checkpoint is a hidden folder of ``out_path``, so every later call goes on
    where the last one ended.
    """
    checkpoint = checkpoint or f"{out_path.rstrip('/')}/_checkpoint"

    def load(batch: DataFrame, _: int) -> None:
        commits = [r.asDict() for r in batch.collect()]  # one small row a commit of this batch
        load_commits(batch.sparkSession, base, commits, out_path, header, keep_replaced)

    w = (L.log_stream(spark, base).writeStream.foreachBatch(load).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
