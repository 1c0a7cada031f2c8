"""Load the analytical table (K8) and query it with partition pruning.

Rows are partitioned on disk by ``chrom`` and a coordinate bucket
``pos_bucket = pos - pos % w`` and, inside each file, sorted by
``(chrom, pos_bucket, ref, alt, pos)`` - the design's "partition by coordinate,
cluster by chrom, ref, alt".  The range shuffle is on ``(chrom, pos)``, so a
contig with a third of all rows is spread over many tasks.

A range query must name the bucket range as well as ``pos`` so the scan
prunes folders; ``range_filter`` adds both predicates.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import check_schema, schema_json

DEFAULT_BUCKET = 1_000_000


def with_bucket(df: DataFrame, width: int = DEFAULT_BUCKET) -> DataFrame:
    return df.withColumn("pos_bucket", (F.col("pos") - F.col("pos") % F.lit(int(width))).cast("long"))


def load_table(df: DataFrame, path: str, width: int = DEFAULT_BUCKET, partitions: int | None = None,
               mode: str = "errorifexists", fmt: str = "parquet", cluster: list | None = None,
               options: dict[str, str] | None = None) -> str:
    """Write ``df`` (needs chrom, pos; ref/alt used for clustering if present).

    ``cluster`` gives another order inside a bucket than (ref, alt, pos),
    ``options`` go to the writer.

    The schema and the bucket width are stored with the table.  An append must
    fit both (fields may be added, not removed or retyped); ``ValueError``
    says what does not.
    """
    spark = df.sparkSession
    if mode == "append" and (stored := _stored(spark, path)):
        problems = check_schema(df, stored)
        if stored_width(stored) != int(width):
            problems.append(f"bucket width {width}, stored {stored_width(stored)}")
        if problems:
            raise ValueError(f"load into {path}: {'; '.join(problems)}")
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if cluster is None:
        cluster = [c for c in ("ref", "alt") if c in df.columns]
    out = (with_bucket(df, width)
           .repartitionByRange(n, "chrom", "pos")
           .sortWithinPartitions("chrom", "pos_bucket", *cluster, "pos"))
    out.write.mode(mode).format(fmt).options(**(options or {})).partitionBy("chrom", "pos_bucket").save(path)
    # The schema is stored beside the data (a "_" folder, skipped by readers)
    # so later loads can be checked with ``schema.check_schema`` (Q4).
    meta = json.loads(schema_json(df)) | {"bucket": int(width)}
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(f"{path.rstrip('/')}/_schema")
    return path


def stored_schema(spark: SparkSession, path: str) -> str:
    return spark.read.text(f"{path.rstrip('/')}/_schema").first()[0]


def _stored(spark: SparkSession, path: str) -> str | None:
    try:
        return stored_schema(spark, path)
    except AnalysisException:
        return None


def stored_width(stored: str) -> int:
    return int(json.loads(stored).get("bucket", DEFAULT_BUCKET))


def range_filter(start: int, end: int, chrom: str | None = None, *, width: int) -> Column:
    """``pos BETWEEN start AND end`` plus the bucket predicate that prunes folders.

    ``width`` must be the table's own (``read_range`` looks it up).
    """
    lo, hi = int(start) - int(start) % width, int(end) - int(end) % width
    cond = F.col("pos").between(int(start), int(end)) & F.col("pos_bucket").between(lo, hi)
    if chrom is not None:
        cond = cond & (F.col("chrom") == chrom)
    return cond


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The table with its stored schema; folder names are not guessed into numbers (contig ``02`` stays text)."""
    stored = _stored(spark, path)
    if stored is None:
        return spark.read.format(fmt).load(path)
    fields = [f for f in T.StructType.fromJson(json.loads(stored)["schema"]).fields if f.name not in ("chrom", "pos_bucket")]
    schema = T.StructType([*fields, T.StructField("chrom", T.StringType()), T.StructField("pos_bucket", T.LongType())])
    return spark.read.schema(schema).format(fmt).load(path)


def read_range(spark: SparkSession, path: str, start: int, end: int, chrom: str | None = None,
               fmt: str = "parquet") -> DataFrame:
    """Rows with ``pos`` in the range; the bucket width comes from the table."""
    return read_table(spark, path, fmt).where(
        range_filter(start, end, chrom, width=stored_width(stored_schema(spark, path))))
