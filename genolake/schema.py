"""Fixed, versioned output schemas (section 1.2/1.3 of the blueprint, Q4).

The VCF header declares its INFO/FORMAT fields per file, but the tables
written by this library have one explicit schema.  ``schema_json`` is saved
beside every loaded table; ``check_schema`` compares a frame against a
stored schema and allows only additions (nested ones included).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import types as T

SCHEMA_VERSION = 1

GENOTYPE = T.StructType([
    T.StructField("sample_idx", T.IntegerType()),
    T.StructField("gt", T.StringType()),
    T.StructField("gq", T.IntegerType()),
    T.StructField("pl", T.ArrayType(T.IntegerType())),
    T.StructField("bad", T.BooleanType()),
])

VARIANTS = T.StructType([
    T.StructField("chrom", T.StringType()),
    T.StructField("contig_idx", T.IntegerType()),
    T.StructField("pos", T.LongType()),
    T.StructField("id", T.StringType()),
    T.StructField("ref", T.StringType()),
    T.StructField("alts", T.ArrayType(T.StringType())),
    T.StructField("qual", T.DoubleType()),
    T.StructField("filters", T.ArrayType(T.StringType())),
    T.StructField("info_text", T.StringType()),
    T.StructField("info", T.MapType(T.StringType(), T.StringType())),
    T.StructField("af", T.ArrayType(T.DoubleType())),
    T.StructField("ac", T.ArrayType(T.IntegerType())),
    T.StructField("an", T.IntegerType()),
    T.StructField("format", T.StringType()),
    T.StructField("genotypes", T.ArrayType(GENOTYPE)),
    T.StructField("_bad", T.ArrayType(T.StringType())),
])

ALLELES = T.StructType([
    T.StructField("chrom", T.StringType()),
    T.StructField("pos", T.LongType()),
    T.StructField("ref", T.StringType()),
    T.StructField("alt", T.StringType()),
    T.StructField("allele_idx", T.IntegerType()),
    T.StructField("af", T.DoubleType()),
    T.StructField("qual", T.DoubleType()),
])


def schema_json(df_or_schema) -> str:
    s = df_or_schema.schema if isinstance(df_or_schema, DataFrame) else df_or_schema
    return json.dumps({"version": SCHEMA_VERSION, "schema": json.loads(s.json())})


def _fields(t: T.DataType, prefix: str = "") -> dict[str, str]:
    out = {}
    if isinstance(t, T.StructType):
        for f in t.fields:
            out.update(_fields(f.dataType, f"{prefix}{f.name}."))
    elif isinstance(t, T.ArrayType):
        out.update(_fields(t.elementType, prefix + "[]."))
    else:
        out[prefix.rstrip(".")] = t.simpleString()
    return out


def check_schema(df: DataFrame, stored: str) -> list[str]:
    """Differences that break the stored schema: removed or retyped fields
    (leaf paths, nested included).  Added fields are allowed; an empty list
    means compatible."""
    old = _fields(T.StructType.fromJson(json.loads(stored)["schema"]))
    new = _fields(df.schema)
    problems = []
    for path, typ in old.items():
        if path not in new:
            problems.append(f"removed: {path}")
        elif new[path] != typ:
            problems.append(f"type changed: {path} {typ} -> {new[path]}")
    return problems
