"""File-order record numbers without a one-task window (K1, L1, L2).

A VCF's record order is its file order.  Spark packs input splits into
partitions by size, so partition order is not file order; instead every
line keeps the split it came from (file path, byte offset of the split).

* the records are written once to the scratch folder with their split and
  their place in it (``monotonically_increasing_id`` is consecutive inside a
  split, because a split is read by one task in order);
* per split, a count and the smallest id are taken from the written records;
* a distributed prefix sum over the splits, ordered by (path, offset), gives
  each split's first ordinal: ``ordinal = offset + id - min_id``;
* the offsets, one row per split, are counted and broadcast, so the records are
  not shuffled; beyond ``BROADCAST_SPLITS`` (128 TB in splits of 128 MB) the
  join is left to Spark.

Everything after the first step reads the written records, so no later change
of settings, cores or executors can cut the input differently: no record can
be lost or numbered twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path, stored

SPLIT_COLS = ("_split_file", "_split_start")
BROADCAST_SPLITS = 1_000_000


def prefix_sum(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Adds the sum of ``value`` over all rows before each row in key order.

    Range-partitioned and written once; running sums inside each partition,
    plus the total of the partitions before it.  Only one row per written
    partition comes to the driver.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "prefix-sum")
    (df.repartitionByRange(*keys).withColumn("_pid", F.spark_partition_id()).write.parquet(path))
    placed = spark.read.schema(f"{_ddl(df)}, _pid int").parquet(path)
    totals = sorted((r["_pid"], r["_n"]) for r in placed.groupBy("_pid").agg(F.sum(value).alias("_n")).collect())
    rows, off = [], 0
    for pid, n in totals:
        rows.append((pid, off))
        off += n
    bases = spark.createDataFrame(rows, "_pid int, _base long")
    w = Window.partitionBy("_pid").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    inside = placed.withColumn("_run", F.coalesce(F.sum(value).over(w), F.lit(0)))
    return inside.join(bases, "_pid").withColumn(out, F.col("_base") + F.col("_run")).drop("_pid", "_base", "_run")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def with_ordinal(df: DataFrame, name: str = "ordinal", broadcast_splits: int = BROADCAST_SPLITS,
                 path: str | None = None) -> DataFrame:
    """Add a dense 0-based ``ordinal`` in file order; drops the split columns.

    ``df`` must carry ``_split_file`` and ``_split_start`` (see
    ``VcfScan.body(with_split=True)``); filter it *before* calling this so
    ordinals are dense over the kept records.  ``df`` is computed and written
    once, here; a caller that names the scratch folder (``path``) may discard
    it when the result has been used.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "ordinals")
    tagged = df.withColumn("_mid", F.monotonically_increasing_id())
    tagged.write.option("compression", "zstd").parquet(path)
    placed = spark.read.schema(tagged.schema).parquet(path)
    splits = placed.groupBy(*SPLIT_COLS).agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_min_mid"))
    offsets = prefix_sum(splits, list(SPLIT_COLS), "_n", "_off").drop("_n")
    if offsets.count() <= broadcast_splits:
        offsets = F.broadcast(offsets)
    out = placed.join(offsets, list(SPLIT_COLS), "left")
    first = F.when(F.col("_off").isNull(), F.raise_error(F.lit("a split of the input has no ordinal")).cast("long")) \
        .otherwise(F.col("_off"))
    return (out.withColumn(name, first + F.col("_mid") - F.col("_min_mid"))
            .drop("_off", "_mid", "_min_mid", *SPLIT_COLS))


def with_sorted_ordinal(df: DataFrame, keys: list, name: str = "ordinal") -> DataFrame:
    """Sort ``df`` by ``keys`` and add each row's dense place in that order.

    Range partitions, sorted and written once; a row's place is its place in
    its partition plus the rows of the partitions before it (one row each,
    broadcast).
    """
    placed = stored(df.repartitionByRange(*keys).sortWithinPartitions(*keys)
                    .withColumn("_mid", F.monotonically_increasing_id()), "sorted-places")
    placed = placed.withColumn("_pid", F.shiftright("_mid", 33))
    w = Window.partitionBy().orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    parts = (placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_min_mid"))
             .withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n"))
    return (placed.join(F.broadcast(parts), "_pid").withColumn(name, F.col("_off") + F.col("_mid") - F.col("_min_mid"))
            .drop("_pid", "_mid", "_min_mid", "_off"))


def with_shard_id(df: DataFrame, records_per_shard: int, ordinal: str = "ordinal") -> DataFrame:
    """``shard_id = ordinal div n``: consecutive records, last shard short."""
    if records_per_shard is None or int(records_per_shard) <= 0:
        raise ValueError(f"records_per_shard must be a positive integer, got {records_per_shard!r}")
    return df.withColumn("shard_id", F.expr(f"cast({ordinal} div {int(records_per_shard)} as int)"))


def limit_records(df: DataFrame, limit: int | None, ordinal: str = "ordinal") -> DataFrame:
    """The first ``limit`` records in file order; 0 or None means no limit
    (the reference tests the limit's truthiness)."""
    if not limit:
        return df
    return df.where(F.col(ordinal) < F.lit(int(limit)))
