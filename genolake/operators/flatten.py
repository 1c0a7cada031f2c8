"""Lines -> wide variant table (operators T1, T2, T3, T6).

One output row per VCF record.  Everything is a projection over the line,
so Catalyst prunes what a query does not use:

* ``chrom`` and ``pos`` are cut with ``substring_index`` (no array), so a
  count by chromosome in a position range never splits the line;
* the other fixed fields come from a split of the first eight fields only;
* the per-sample split runs only when ``genotypes`` is selected.  Its
  per-record inputs (all fields, FORMAT key positions, ``:``-split samples)
  are separate projections referenced several times, which keeps Catalyst
  from inlining them into the per-sample lambda.

Per-sample queries should use ``sample_rows``: ``posexplode`` of the sample
fields with plain, code-generated column expressions instead of a lambda.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import parse as P
from ..sources.vcf_text import VcfHeader


def contig_index_expr(chrom: Column, header: VcfHeader | None) -> Column:
    """Header order of the contig (null if undeclared).

    The contig list comes from the header (bounded by the header, not the
    data) and is inlined as a literal map: no join, no shuffle.
    """
    if header is None or not header.contigs:
        return F.lit(None).cast("int")
    m = F.map_from_arrays(F.lit(list(header.contigs)), F.lit(list(range(len(header.contigs)))))
    return F.try_element_at(m, chrom).cast("int")


def flatten(body: DataFrame, header: VcfHeader | None = None) -> DataFrame:
    """Parse record lines (column ``value``) into the wide schema.

    Keeps every input column (``raw_len``, ``ordinal``, ... pass through).
    """
    keep = list(body.columns)
    f8 = P.fixed_fields("value")
    fields = P.all_fields("value")
    chrom = P.field_at("value", 0)
    pos_t = P.field_at("value", 1)
    df = body.select("*", f8.alias("_f8"), fields.alias("_fields"))
    g = lambda i: F.get(F.col("_f8"), i)
    qual_t, info_t = P.missing_to_null(g(5)), g(7)
    df = df.select(
        *keep, "_fields",
        chrom.alias("chrom"),
        contig_index_expr(chrom, header).alias("contig_idx"),
        pos_t.try_cast("bigint").alias("pos"),
        P.missing_to_null(g(2)).alias("id"),
        g(3).alias("ref"),
        P.list_field(g(4)).alias("alts"),
        P.number(qual_t, "double").alias("qual"),
        P.list_field(g(6), ";").alias("filters"),
        info_t.alias("info_text"),
        P.info_map(info_t).alias("info"),
        F.when(F.size(F.col("_f8")) < 8, F.lit("fields")).alias("_short"),
        (pos_t.try_cast("bigint").isNull()).alias("_bad_pos"),
        (qual_t.isNotNull() & P.number(qual_t, "double").isNull()).alias("_bad_qual"),
        P.missing_to_null(F.get(F.col("_fields"), 8)).alias("format"),
        F.split(F.get(F.col("_fields"), 8), ":").alias("_fk"),
        F.slice(F.col("_fields"), 10, F.greatest(F.size(F.col("_fields")) - 9, F.lit(0))).alias("_samples"),
    )
    info_txt = F.col("info_text")
    af_t = P.info_value(info_txt, "AF")
    ac_t = P.info_value(info_txt, "AC")
    an_t = P.info_value(info_txt, "AN")
    fk = F.col("_fk")
    df = df.select(
        *keep,
        "chrom", "contig_idx", "pos", "id", "ref", "alts", "qual", "filters", "info_text", "info",
        P.typed_list(af_t, "double").alias("af"),
        P.typed_list(ac_t, "int").alias("ac"),
        P.number(P.missing_to_null(an_t), "int").alias("an"),
        "format",
        P.format_index(fk, "GT").alias("_gt_i"), P.format_index(fk, "GQ").alias("_gq_i"),
        P.format_index(fk, "PL").alias("_pl_i"),
        F.transform("_samples", lambda s: F.split(s, ":")).alias("_parts"),
        F.array_compact(F.array(
            F.col("_short"),
            F.when(F.col("_bad_pos"), F.lit("pos")),
            F.when(F.col("_bad_qual"), F.lit("qual")),
            F.when(P.bad_list_items(af_t, "double"), F.lit("AF")),
            F.when(P.bad_list_items(ac_t, "int"), F.lit("AC")),
            F.when(an_t.isNotNull() & (an_t != ".") & P.number(an_t, "int").isNull(), F.lit("AN")),
            F.when(F.size(F.array_distinct(P.info_keys(info_txt))) < F.size(P.info_keys(info_txt)),
                   F.lit("INFO")),
        )).alias("_bad"),
    )
    return df.select(
        *keep, "chrom", "contig_idx", "pos", "id", "ref", "alts", "qual", "filters", "info_text", "info",
        "af", "ac", "an", "format",
        P.genotype_structs(F.col("_parts"), F.col("_gt_i"), F.col("_gq_i"), F.col("_pl_i")).alias("genotypes"),
        "_bad")


def sample_rows(v: DataFrame, keep=("chrom", "pos", "ref"), with_pl: bool = False, outer: bool = False) -> DataFrame:
    """One row per (record, sample) straight from the line: ``sample_idx,
    gt, gq`` (and ``pl``); with ``outer`` a record without samples keeps a row of nulls.  ``posexplode`` + plain expressions, all in
    whole-stage codegen; FORMAT positions are computed once per record."""
    fields = P.all_fields("value")
    fk = F.split(F.get(F.col("_fields"), 8), ":")
    base = v.select(*keep, fields.alias("_fields"))
    base = base.select(*keep, P.format_index(fk, "GT").alias("_gt_i"), P.format_index(fk, "GQ").alias("_gq_i"),
                       P.format_index(fk, "PL").alias("_pl_i"),
                       (F.posexplode_outer if outer else F.posexplode)(F.slice(F.col("_fields"), 10, F.greatest(F.size(F.col("_fields")) - 9,
                                                                              F.lit(0)))).alias("sample_idx", "_s"))
    parts = F.split(F.col("_s"), ":")
    cols = [*keep, "sample_idx", P.sample_value(parts, F.col("_gt_i")).alias("gt"),
            P.number(P.sample_value(parts, F.col("_gq_i")), "int").alias("gq")]
    if with_pl:
        cols.append(P.typed_list(P.sample_value(parts, F.col("_pl_i")), "int").alias("pl"))
    return base.select(*cols)


def with_typed_info(v: DataFrame, header: VcfHeader) -> DataFrame:
    """Adds ``info_typed``: every INFO key the header declares, typed by its
    Type and Number (T2)."""
    return v.withColumn("info_typed", P.typed_info(F.col("info_text"), header.info))


def alt_text(alts: Column | str = "alts") -> Column:
    """ALT as written: alleles joined by ``,``, ``.`` when there are none."""
    a = F.col(alts) if isinstance(alts, str) else alts
    return F.when(F.size(a) > 0, F.array_join(a, ",")).otherwise(F.lit("."))
