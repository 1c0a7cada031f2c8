"""Counts kept per coordinate bucket of a loaded table (A5).

The load writes, beside the table, one row per (contig, bucket): how many rows
it holds.  A range count adds up the whole buckets inside the range from there
and scans only the two buckets that the range cuts, whatever its width.
A load or append through ``load_with_rollup`` counts again afterwards, from folder
names and the row counts of the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .table import load_table, read_table, stored_schema, stored_width

ROLLUP_SCHEMA = "chrom string, pos_bucket long, n long"


def _path(path: str) -> str:
    return f"{path.rstrip('/')}/_rollup"


def load_with_rollup(df: DataFrame, path: str, width: int, mode: str = "errorifexists", **kw) -> str:
    """``load_table``, then the bucket counts of the table as it lies on disk."""
    load_table(df, path, width=width, mode=mode, **kw)
    refresh(df.sparkSession, path)
    return path


def refresh(spark: SparkSession, path: str) -> None:
    """Recount every bucket: only folder names and row counts of files are read, no column."""
    counts = read_table(spark, path).groupBy("chrom", "pos_bucket").agg(F.count(F.lit(1)).alias("n"))
    counts.write.mode("overwrite").parquet(_path(path))


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    """``chrom, pos_bucket, n``."""
    return spark.read.schema(ROLLUP_SCHEMA).parquet(_path(path))


def edge_rows(spark: SparkSession, path: str, start: int, end: int, width: int) -> DataFrame:
    """Rows of the range that lie in the buckets it cuts (at most two a contig)."""
    first, last = start - start % width, end - end % width
    cut = sorted({b for b in (first, last) if b < start or b + width - 1 > end})
    if not cut:
        return read_table(spark, path).where("false")
    return read_table(spark, path).where(F.col("pos_bucket").isin(cut) & F.col("pos").between(start, end))


def count_in_range(spark: SparkSession, path: str, start: int, end: int) -> DataFrame:
    """``chrom, variants`` with ``pos`` in the range, as ``aggregate.count_in_range`` gives them."""
    start, end = int(start), int(end)
    width = stored_width(stored_schema(spark, path))
    whole = read_rollup(spark, path).where(F.col("pos_bucket").between(start, end - width + 1)).select("chrom", "n")
    edges = edge_rows(spark, path, start, end, width).groupBy("chrom").agg(F.count(F.lit(1)).alias("n"))
    return whole.unionByName(edges).groupBy("chrom").agg(F.sum("n").alias("variants")).where("variants > 0")
