"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genolake.session import scratch_path

MARK_BITS = 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back (``compression``: not the session's own).

    Cuts lineage with files every executor can read; a lost executor costs a
    re-read, never a recomputation with other row placement.
    """
    path = scratch_path(df.sparkSession, name)
    (df.write.option("compression", compression) if compression else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_text(docs: DataFrame) -> DataFrame:
    """Only ``doc_id`` and ``text`` (null text: empty); other columns never meet the operator's own."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))


def with_tag(rows: DataFrame) -> DataFrame:
    """``tag`` tells apart different texts of one id, or of null ids."""
    return rows.withColumn("tag", F.xxhash64("text"))


def unused(docs: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of ``docs`` has it (in any case)."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def without_rows(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` less the rows of ``gone(doc_id, tag)``, null ids included."""
    i, t, own, own_tag = unused(docs, "_id", "_tag", "_own", "_own_tag")
    gone = gone.select(F.col("doc_id").alias(i), F.col("tag").alias(t)).distinct()
    rows = docs.withColumn(own, docs["doc_id"].cast("long")) \
        .withColumn(own_tag, F.xxhash64(F.coalesce(docs["text"], F.lit(""))))
    return rows.join(gone, F.col(own).eqNullSafe(F.col(i)) & (F.col(own_tag) == F.col(t)), "left_anti").select(*docs.columns)


def may_match(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` less most of those whose ``keys`` are not among ``wanted``'s, so that a join after it shuffles few of them.

    ``2**MARK_BITS`` marks (4 MB, whatever the size of the tables) are set from hashes of the wanted keys, null or not; no
    wanted row is ever left out, and another passes only under a mark that is set by chance.
    """
    def place(df: DataFrame):
        return F.pmod(F.xxhash64(*[df[k] for k in keys]), F.lit(1 << MARK_BITS)).cast("int")

    at = wanted.select(place(wanted).alias("_p"))
    words = at.groupBy(F.shiftright("_p", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, _p & 63))").alias("bits")).toArrow()
    marks = np.zeros(1 << MARK_BITS - 6, np.int64)
    marks[words.column("w").to_numpy()] = words.column("bits").to_numpy()
    shared, n = rows.sparkSession.sparkContext.broadcast(marks), len(rows.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = b.column(n).to_numpy()
            set_ = (shared.value[p >> 6] >> (p & 63).astype(np.int64)) & 1
            yield b.select(list(range(n))).filter(pa.array(set_.astype(bool)))

    return rows.withColumn("_p", place(rows)).mapInArrow(run, rows.schema)


def spread_salt(n: int):
    """A deterministic salt: equal rows from one scan spread over ``n`` keys."""
    return F.pmod(F.monotonically_increasing_id(), F.lit(n)).cast("int")


def numbered(df: DataFrame, keys: list, name: str, out: str = "row_no") -> tuple[DataFrame, int]:
    """Rows of ``df`` with a dense global number in ``keys`` order, and the row count.

    Range shuffle on the keys (plus a salt, so equal rows split over tasks),
    sort inside each partition, store, then add each partition's offset: the
    only single-task step is a running sum over one row per partition.
    """
    placed = (df.withColumn("_salt", spread_salt(1024))
              .repartitionByRange(*keys, "_salt").sortWithinPartitions(*keys, "_salt").drop("_salt")
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    placed = stored(placed, name)
    offsets, total = partition_offsets(placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")))
    out_df = (placed.join(F.broadcast(offsets), "_pid")
              .withColumn(out, F.col("_off") + F.col("_at")).drop("_pid", "_at", "_off"))
    return out_df, total


def partition_offsets(counts: DataFrame) -> tuple[DataFrame, int]:
    """``(_pid, _off)`` from ``(_pid, _n)``: one row per partition of a written table."""
    rows = sorted((r["_pid"], r["_n"]) for r in counts.collect())  # bounded by the number of partitions
    out, total = [], 0
    for pid, n in rows:
        out.append((pid, total))
        total += n
    return counts.sparkSession.createDataFrame(out, "_pid int, _off long"), total
