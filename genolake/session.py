"""Session defaults and the shared scratch location.

Jobs that must cut lineage or hand data between steps write to a folder
under the session's checkpoint directory (``spark.checkpoint.dir``), which a
cluster points at shared storage.  Only when nothing is configured (local
tests) is a private temporary folder set as the checkpoint directory.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "genolake", driver_memory: str = "16g",
                  extra: dict | None = None) -> SparkSession:
    """A session with the settings the library assumes (AQE, UTC, zstd)."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", driver_memory))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The session's checkpoint directory; set a private one only if unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # e.g. a Spark Connect session: no SparkContext
        sc = None
    if sc is not None:
        d = sc.getCheckpointDir()
        if d:
            return d
        conf = sc.getConf().get("spark.checkpoint.dir", None)
        if not conf and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(conf or tempfile.mkdtemp(prefix="genolake-ck-"))
        return sc.getCheckpointDir()
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:  # where the executors are is not known here
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return conf


def session_key(spark: SparkSession) -> str:
    """Identifies the running application (for per-session caches)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:
        return f"session-{id(spark)}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unused path under the shared checkpoint directory."""
    return f"{checkpoint_root(spark).rstrip('/')}/genolake/{name}-{uuid.uuid4().hex[:12]}"


def stored(df, name: str):
    """``df`` written once to the shared scratch folder and read back with its schema."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder made at ``scratch_path`` once nothing reads it any more; without a JVM at hand it stays."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:  # e.g. a Spark Connect session
        return
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
