"""Allele table, normalisation, genotype table and class counts (T4, T5, T7, A6, A7).

The genotype table multiplies rows by the number of samples (3,202 in the
reference's target file).  ``genotype_class_counts`` therefore explodes and
partially aggregates inside the same stage (whole-stage codegen), so only
``(sample, class, count)`` per task crosses the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.alleles import allele_class, genotype_class, normalize
from .flatten import sample_rows

VARIANT_KEY = ("chrom", "pos", "ref", "alt")


def split_multiallelic(v: DataFrame, keep: tuple[str, ...] | list[str] | None = None) -> DataFrame:
    """One row per (record, ALT allele): ``alt``, ``allele_idx`` (1-based),
    ``af`` (the Number=A value for that allele).  Records without ALT drop out.
    """
    base = list(keep) if keep is not None else [c for c in v.columns if c not in ("af",)]
    # posexplode_outer + null filter: same rows as posexplode, but Spark does
    # not infer a size(alts) > 0 filter that it would push below the parse
    # projection (re-splitting every line).
    return (v.select(*base, F.col("af").alias("_af"), F.posexplode_outer("alts").alias("_i", "alt"))
            .where(F.col("alt").isNotNull())
            .select(*base, "alt", (F.col("_i") + 1).alias("allele_idx"),
                    F.get(F.col("_af"), F.col("_i")).alias("af")))


def normalize_alleles(alleles: DataFrame) -> DataFrame:
    """Trim shared suffix/prefix of (ref, alt); keeps the input position as ``orig_pos``."""
    n = normalize("pos", "ref", "alt")
    return (alleles.withColumn("_n", n)
            .withColumn("orig_pos", F.col("pos"))
            .withColumn("pos", F.col("_n.pos"))
            .withColumn("ref", F.col("_n.ref"))
            .withColumn("alt", F.col("_n.alt"))
            .drop("_n"))


def allele_class_counts(alleles: DataFrame) -> DataFrame:
    return (alleles.groupBy(allele_class("ref", "alt").alias("allele_class"))
            .agg(F.count(F.lit(1)).alias("n_alleles")))


def genotypes_long(v: DataFrame, samples: list[str] | None = None,
                   keep: tuple[str, ...] = ("chrom", "pos", "ref"), with_pl: bool = False) -> DataFrame:
    """One row per (record, sample): ``sample_idx, sample, gt, gq`` (T7).

    Built from the record line by ``posexplode`` (see ``flatten.sample_rows``)
    rather than from the nested ``genotypes`` array, so it stays in
    whole-stage codegen."""
    out = sample_rows(v, keep, with_pl)
    if samples is not None:
        out = out.withColumn("sample", F.get(F.lit(list(samples)), F.col("sample_idx")))
    return out


def genotype_class_counts(v: DataFrame, samples: list[str] | None = None) -> DataFrame:
    """Count of genotype classes per sample (A7): explode + map-side partial
    aggregate in one code-generated stage; one row per (sample, class) per
    task crosses the shuffle."""
    g = sample_rows(v, keep=())
    out = (g.groupBy("sample_idx", genotype_class("gt").alias("gt_class"))
           .agg(F.count(F.lit(1)).alias("n_genotypes")))
    if samples is not None:
        out = out.withColumn("sample", F.get(F.lit(list(samples)), F.col("sample_idx")))
    return out
