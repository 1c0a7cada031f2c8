"""A bucketed allele table (J2): joins by allele without a shuffle.

``write_bucketed`` hashes rows by the allele key into a fixed number of
buckets, one sorted file each; two tables written with the same number of
buckets are joined, and a table is grouped, on that key with no Exchange, at
any size.  ``files_per_bucket`` deals each bucket over several files when a
bucket (or one key with a large share of the rows) is more than one writer
should hold; the join still needs no shuffle, only a sort.

The bucket layout is kept beside the files, so ``open_bucketed`` can declare
the table again in any later session; nothing depends on a metastore.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.alleles import VARIANT_KEY
from ..session import session_key


BUCKET_ROWS = 250_000


def buckets_for(rows: int, least: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """Number of buckets for about ``rows`` rows: they grow in number, so that what one task sorts does not."""
    return max(least, -(-rows // bucket_rows))


def write_bucketed(df: DataFrame, path: str, buckets: int, key: tuple[str, ...] = VARIANT_KEY, files_per_bucket: int = 1) -> str:
    """Write ``df`` as ``buckets`` sorted buckets of ``key`` under ``path`` (which must not exist)."""
    if buckets < 1 or files_per_bucket < 1:
        raise ValueError("buckets and files_per_bucket must be positive")
    spark, name = df.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    if files_per_bucket == 1:
        placed = df.repartition(buckets, *key)  # the writer's own hash: every task holds whole buckets
    else:
        salt = F.pmod(F.monotonically_increasing_id(), F.lit(files_per_bucket))
        placed = (df.withColumn("_salt", salt).withColumn("_bucket", F.pmod(F.hash(*key), F.lit(buckets)))
                  .repartition(buckets * files_per_bucket, "_bucket", "_salt").drop("_bucket", "_salt"))
    (placed.write.mode("errorifexists").format("parquet").bucketBy(buckets, *key).sortBy(*key)
     .option("path", path).saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")  # the files stay: the table is external
    spec = {"buckets": buckets, "key": list(key), "schema": json.loads(df.schema.json())}
    spark.createDataFrame([(json.dumps(spec),)], "value string").coalesce(1).write.text(f"{path.rstrip('/')}/_buckets")
    return path


_OPEN: dict[tuple[str, str], str] = {}


def open_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The table with its bucket layout declared (once per session)."""
    known = (session_key(spark), path)
    if known not in _OPEN:
        spec = json.loads(spark.read.text(f"{path.rstrip('/')}/_buckets").first()[0])
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(spec["schema"]).fields)
        key = ", ".join(f"`{k}`" for k in spec["key"])
        name = f"bucketed_{uuid.uuid4().hex}"
        quoted = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
                  f"INTO {int(spec['buckets'])} BUCKETS LOCATION '{quoted}'")
        _OPEN[known] = name
    return spark.table(_OPEN[known])
