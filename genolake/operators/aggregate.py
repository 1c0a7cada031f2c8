"""Counts and sizes over the wide table (A1-A5, A8, A9 building blocks, P6).

All of these are one ``groupBy`` with map-side partial aggregation; the
shuffled data is one row per group per task, so a contig holding a third of
all records costs nothing extra.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import sample_count
from .flatten import alt_text


def stream_summary(v: DataFrame) -> DataFrame:
    """One row: ``total_variants``, ``total_bytes`` (record text incl.
    newline), ``avg_bytes`` (null when there are no records)."""
    return v.agg(F.count(F.lit(1)).alias("total_variants"),
                 F.coalesce(F.sum("raw_len"), F.lit(0)).cast("long").alias("total_bytes")) \
        .withColumn("avg_bytes", F.col("total_bytes") / F.nullif(F.col("total_variants"), F.lit(0)))


def count_by_chrom(v: DataFrame) -> DataFrame:
    """Records per chromosome and how many lack QUAL (A2)."""
    return v.groupBy("chrom").agg(F.count(F.lit(1)).alias("variants"),
                                  F.count_if(F.col("qual").isNull()).alias("null_qual"))


def count_in_range(v: DataFrame, start: int, end: int) -> DataFrame:
    """``SELECT chrom, COUNT(*) AS variants ... WHERE pos BETWEEN a AND b
    GROUP BY chrom`` (A5) - position only, not overlap."""
    return (v.where(F.col("pos").between(F.lit(int(start)), F.lit(int(end))))
            .groupBy("chrom").agg(F.count(F.lit(1)).alias("variants")))


def python_float_text(c: Column) -> Column:
    """Text of a double as Python's ``str(float)`` gives it; null gives ``None`` (what the reference prints).

    Spark's own text has the same digits; it differs in writing an exponent
    from 1e7 and below 1e-3, where Python does from 1e16 and below 1e-4, and in
    the exponent's form (``1.0E-5``, ``1e-05``).
    """
    text = c.cast("string")
    sign = F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    mantissa = F.regexp_replace(F.regexp_replace(F.substring_index(text, "E", 1), r"^-|\.0$", ""), r"\.", "")
    exponent = F.regexp_extract(text, r"E(-?[0-9]+)$", 1).try_cast("int")
    size = F.length(mantissa)
    whole = F.rpad(F.substr(mantissa, F.lit(1), F.least(size, exponent + 1)), exponent + 1, F.lit("0"))
    rest = F.when(size > exponent + 1, F.substr(mantissa, exponent + 2)).otherwise(F.lit("0"))
    large = F.concat(sign, whole, F.lit("."), rest)
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), mantissa)
    point = F.when(size > 1, F.concat(F.substr(mantissa, F.lit(1), F.lit(1)), F.lit("."), F.substr(mantissa, F.lit(2)))) \
        .otherwise(mantissa)
    digits = F.abs(exponent).cast("string")
    far = F.concat(sign, point, F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")),
                   F.when(F.length(digits) < 2, F.lit("0")).otherwise(F.lit("")), digits)
    return (F.when(c.isNull(), F.lit("None")).when(F.isnan(c), F.lit("nan"))
            .when(text == "Infinity", F.lit("inf")).when(text == "-Infinity", F.lit("-inf"))
            .when(exponent.isNull(), text).when(exponent.between(0, 15), large)
            .when(exponent.between(-4, -1), small).otherwise(far))


def preview_text(v: DataFrame, ordinal: str = "ordinal") -> Column:
    """``Variant n: chrom:pos ref>alts (QUAL=q)`` (P6), n = ordinal + 1."""
    return F.concat(F.lit("Variant "), (F.col(ordinal) + 1).cast("string"), F.lit(": "),
                    F.col("chrom"), F.lit(":"), F.col("pos").cast("string"), F.lit(" "),
                    F.col("ref"), F.lit(">"), alt_text("alts"),
                    F.lit(" (QUAL="), python_float_text(F.col("qual")), F.lit(")"))


def stage_counts(lines: DataFrame, header=None) -> DataFrame:
    """Row counts of every stage from one pass over the lines (A8): lines,
    header lines, records, alleles (records x ALT), genotypes (records x
    samples), records with a parse problem.  One aggregate, then unpivot."""
    from .flatten import flatten

    v = F.col("value")
    is_rec = ~v.startswith("#") & (F.length(v) > 0)
    parsed = flatten(lines.select("value", F.lit(0).alias("raw_len")), header)
    rec = F.col("_rec")
    agg = parsed.withColumn("_rec", is_rec).agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(v.startswith("#")).alias("header_lines"),
        F.count_if(rec).alias("records"),
        F.coalesce(F.sum(F.when(rec, F.size("alts"))), F.lit(0)).cast("long").alias("alleles"),
        F.coalesce(F.sum(F.when(rec, sample_count("value"))), F.lit(0)).cast("long").alias("genotypes"),
        F.count_if(rec & (F.size("_bad") > 0)).alias("records_with_bad_fields"))
    names = ["lines", "header_lines", "records", "alleles", "genotypes", "records_with_bad_fields"]
    return agg.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("step"), F.lit(n).alias("stage"), F.col(n).cast("long").alias("n_rows"))
        for i, n in enumerate(names)])))
