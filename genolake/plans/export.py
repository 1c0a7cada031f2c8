"""Tabular exports (K6 TSV, K7 columnar per shard) and their read-back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _flat(df: DataFrame, list_sep: str = ",") -> DataFrame:
    """Arrays become ``sep``-joined text (a missing item is ``.``, so places hold), maps ``k=v;..``
    text; a struct gives a column per field, ``name_field``, and an array of structs the same with
    its items joined by ``;`` (a genotype column gives ``genotypes_gt`` and so on, in sample order)."""
    cols = []

    def text(c, t):
        if isinstance(t, T.ArrayType):
            return F.when(c.isNull(), None).otherwise(F.array_join(c.cast("array<string>"), list_sep, "."))
        return c.cast("string")

    def items(name, g):
        return F.array_join(F.transform(F.col(name), lambda x: F.coalesce(text(x[g.name], g.dataType), F.lit("."))), ";")

    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType):
            cols += [items(f.name, g).alias(f"{f.name}_{g.name}") for g in f.dataType.elementType.fields]
        elif isinstance(f.dataType, T.ArrayType):
            cols.append(text(F.col(f.name), f.dataType).alias(f.name))
        elif isinstance(f.dataType, T.StructType):
            for g in f.dataType.fields:
                cols.append(text(F.col(f.name)[g.name], g.dataType).alias(f"{f.name}_{g.name}"))
        elif isinstance(f.dataType, T.MapType):
            cols.append(F.array_join(F.transform(F.map_entries(f.name), lambda e: F.concat_ws(
                "=", e["key"], e["value"])), ";").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# A lone point, after any number of backslashes, gets one backslash more: ``.`` alone means null.
_POINT = r"^\\*\.$"


def _texts(df: DataFrame, change) -> DataFrame:
    """``df`` with its lone points changed."""
    return df.select(*[F.when(F.col(f.name).rlike(_POINT), change(F.col(f.name))).otherwise(F.col(f.name)).alias(f.name)
                       if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in df.schema.fields])


def write_tsv(df: DataFrame, path: str, mode: str = "errorifexists", partition_by=()) -> DataFrame:
    """Tab-separated text with a header line, in a folder for each value of ``partition_by`` if given;
    returns the flattened frame written.

    Null is ``.``, as in a VCF; a text that is itself a point is written ``\\.``
    and an empty text ``""``, so ``read_tsv`` gives all three back.
    """
    flat = _flat(df)
    w = (_texts(flat, lambda c: F.concat(F.lit("\\"), c)).write.mode(mode).option("sep", "\t").option("header", True)
         .option("nullValue", ".").option("emptyValue", '""')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    (w.partitionBy(*partition_by) if partition_by else w).csv(path)
    return flat


def read_tsv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    rows = (spark.read.option("sep", "\t").option("header", True).option("nullValue", ".").option("emptyValue", "")
            .option("mode", "FAILFAST").schema(schema).csv(path))
    return _texts(rows, lambda c: F.substr(c, F.lit(2)))


def write_columnar(df: DataFrame, path: str, fmt: str = "parquet", partition_by=("shard_id",),
                   mode: str = "errorifexists") -> str:
    """Parquet (default) or ORC; one folder per shard when ``shard_id`` is present."""
    if fmt not in ("parquet", "orc"):
        raise ValueError(f"Unsupported columnar format: {fmt}; use parquet or orc")
    parts = [c for c in partition_by if c in df.columns]
    w = df.write.mode(mode).format(fmt)
    if parts:
        w = w.partitionBy(*parts)
    w.save(path)
    return path
