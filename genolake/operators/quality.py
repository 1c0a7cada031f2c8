"""Data-quality jobs on the variant table (Q1, Q2, Q3, J3).

Every check is an aggregate; none collects a group.  Checks against the
preceding record (sortedness, dense ordinals) write the few columns they need
once, then use windows over blocks of consecutive records, or over shards, plus
one row per block for the edges.  The only shuffle of records is the one on the
block; contig ranks, one row per contig, are counted and broadcast (beyond
``BROADCAST_CONTIGS`` contigs the join is left to Spark).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.parse import number
from ..session import stored
from .flatten import sample_rows
from ..sources.vcf_text import VcfHeader

BROADCAST_CONTIGS = 100_000


def info_definitions(spark: SparkSession, header: VcfHeader) -> DataFrame:
    rows = [(k, d.get("Number"), d.get("Type")) for k, d in header.info.items()]
    return spark.createDataFrame(rows, "key string, number string, type string")


def info_violations(v: DataFrame, header: VcfHeader) -> DataFrame:
    """INFO entries against the header: ``unknown_key``, ``wrong_number``,
    ``wrong_type``, counted per (key, issue); only issues that occur."""
    # Header definitions are header-sized: inlined as literal maps, no join.
    keys = list(header.info.keys())
    num = F.map_from_arrays(F.lit(keys), F.lit([header.info[k].get("Number") or "." for k in keys])) \
        if keys else F.create_map().cast("map<string,string>")
    typ = F.map_from_arrays(F.lit(keys), F.lit([header.info[k].get("Type") or "String" for k in keys])) \
        if keys else F.create_map().cast("map<string,string>")
    e = v.select(F.size("alts").alias("n_alts"), F.explode("info").alias("key", "val"))
    count, type_ = F.try_element_at(num, F.col("key")), F.try_element_at(typ, F.col("key"))
    items = F.split(F.col("val"), ",")
    n_items = F.when(F.col("val").isNull(), F.lit(0)).otherwise(F.size(items))
    expected = (F.when(count == "A", F.col("n_alts"))
                .when(count == "R", F.col("n_alts") + 1)
                .when(count.rlike("^[0-9]+$"), count.cast("int")))
    bad_type = (F.when(type_ == "Integer", F.exists(items, lambda x: (x != ".") & number(x, "int").isNull()))
                .when(type_ == "Float", F.exists(items, lambda x: (x != ".") & number(x, "double").isNull()))
                .when(type_ == "Flag", F.col("val").isNotNull())
                .otherwise(F.lit(False)))
    issues = F.filter(F.array(
        F.when(count.isNull(), F.lit("unknown_key")),
        F.when(count.isNotNull() & expected.isNotNull() & (type_ != "Flag") & (n_items != expected),
               F.lit("wrong_number")),
        F.when(count.isNotNull() & F.coalesce(bad_type, F.lit(False)), F.lit("wrong_type"))),
        lambda x: x.isNotNull())
    return (e.select("key", F.explode(issues).alias("issue"))
            .groupBy("key", "issue").agg(F.count(F.lit(1)).alias("n_records")))


def completeness(v: DataFrame) -> DataFrame:
    """One row of missing-value counts (record level and per genotype).

    One pass over exploded sample fields (``sample_rows``, code-generated): a
    record's own values are counted on its first row, which a record without
    samples has too.
    """
    flags = {"missing_id": F.col("id").isNull(), "missing_qual": F.col("qual").isNull(), "missing_alt": F.size("alts") == 0,
             "missing_filter": F.size("filters") == 0,
             "missing_info": F.col("info_text").isNull() | F.col("info_text").isin("", ".")}
    rows = sample_rows(v.select("value", *[c.alias(k) for k, c in flags.items()]), keep=tuple(flags), outer=True)
    first, sample = F.coalesce(F.col("sample_idx"), F.lit(0)) == 0, F.col("sample_idx").isNotNull()
    return rows.agg(
        F.count_if(first).alias("n_records"),
        *[F.count_if(first & F.col(k)).alias(k) for k in flags],
        F.count_if(sample & (F.col("gt").isNull() | F.col("gt").contains("."))).alias("missing_gt"),
        F.count_if(sample & F.col("gq").isNull()).alias("missing_gq"),
        F.count_if(sample).alias("n_genotypes"))


ORDER_BLOCK, PARTITION_ROWS = 100_000, 500_000


def contig_ranks(v: DataFrame) -> DataFrame:
    """``chrom, _rank``: declared contigs in header order, others after them by first appearance."""
    return v.groupBy("chrom").agg(F.min("contig_idx").alias("_i"), F.min("ordinal").alias("_o")).select(
        "chrom", F.coalesce(F.col("_i").cast("long"), F.lit(1 << 40) + F.col("_o")).alias("_rank"))


def _ranked(v: DataFrame, block: str) -> DataFrame:
    """``v``, written once, with its contigs' ranks, shuffled on ``block`` into partitions of about ``PARTITION_ROWS`` records.

    The partitions grow in number with the records, so what one task sorts does not.
    """
    v = stored(v, "order-check")
    ranks = stored(contig_ranks(v), "contig-ranks")
    x = v.join(F.broadcast(ranks) if ranks.count() <= BROADCAST_CONTIGS else ranks, "chrom")
    n = -(-v.count() // PARTITION_ROWS)  # from the files' footers
    return x.repartition(n, block) if n > int(v.sparkSession.conf.get("spark.sql.shuffle.partitions")) else x


def _with_previous(v: DataFrame, block: str) -> DataFrame:
    """Each record with its predecessor's ``chrom``, rank, position and block (``_p``; null for the first record).

    ``lag`` inside blocks of consecutive records, then one row per block for
    the records at the edges: the records are shuffled once.
    """
    here = F.struct("chrom", "_rank", "pos", F.col(block).alias("block"))
    w = Window.partitionBy(block).orderBy("ordinal")
    x = v.withColumn("_p", F.lag(here).over(w)).withColumn("_edge", F.row_number().over(w) == 1)
    ends = v.groupBy(block).agg(F.min("ordinal").alias("_first"), F.max_by(here, "ordinal").alias("_last"),
                                F.max("ordinal").alias("_end"))
    before = ends.select((F.col("_end") + 1).alias("_first"), F.col("_last").alias("_q"))
    edges = ends.join(before, "_first").select(F.col(block).alias("_eb"), "_q")
    return (x.join(edges, F.col("_edge") & (F.col(block) == F.col("_eb")), "left")
            .withColumn("_p", F.coalesce("_p", "_q")).drop("_eb", "_q"))


def _backward() -> Column:
    """The record sorts before its predecessor: a smaller position on one contig, or a contig left earlier."""
    p = F.col("_p")
    return F.coalesce(F.when(p["chrom"] == F.col("chrom"), F.col("pos") < p["pos"])
                      .otherwise(F.col("_rank") < p["_rank"]), F.lit(False))


def coordinate_order_report(v: DataFrame) -> DataFrame:
    """Per chromosome: records, min/max pos, and records out of coordinate order.

    Contigs that the header does not declare are ordered by their first
    record, so their positions, and returns to them, are checked too.
    """
    x = v.select("ordinal", "contig_idx", "chrom", "pos", F.floor(F.col("ordinal") / ORDER_BLOCK).alias("_b"))
    x = _with_previous(_ranked(x, "_b"), "_b")
    return x.groupBy("chrom").agg(F.count(F.lit(1)).alias("n_records"), F.min("pos").alias("min_pos"),
                                  F.max("pos").alias("max_pos"), F.count_if(_backward()).alias("n_unsorted"))


def shard_validation(records: DataFrame, records_per_shard: int, total: int | None = None) -> DataFrame:
    """Per shard: count vs. the expected count, dense ordinals, sortedness
    inside the shard, and order across the boundary to the previous record.
    ``total`` is the run's record count (from the manifest; counted if not given)."""
    n = int(records_per_shard)
    total = records.count() if total is None else int(total)
    x = records.select("ordinal", "contig_idx", "chrom", "pos", "shard_id")
    x = _with_previous(_ranked(x, "shard_id"), "shard_id")
    w = Window.partitionBy("shard_id").orderBy("ordinal")
    x = x.withColumn("_step", F.col("ordinal") - F.lag("ordinal").over(w))
    inside = F.col("_p.block") == F.col("shard_id")
    out = x.groupBy("shard_id").agg(
        F.count(F.lit(1)).alias("n_records"), F.min("ordinal").alias("_lo"), F.max("ordinal").alias("_hi"),
        F.coalesce(F.max(F.col("_step") != 1), F.lit(False)).alias("_gap"),
        F.count_if(_backward() & inside).alias("n_unsorted"),
        F.coalesce(F.max(_backward() & ~inside), F.lit(False)).alias("starts_before_previous"))
    expected = F.least(F.lit(n).cast("long"), F.lit(total).cast("long") - F.col("shard_id").cast("long") * n)
    return out.select(
        "shard_id", "n_records", expected.alias("expected_records"),
        (~F.col("_gap") & (F.col("_lo") == F.col("shard_id").cast("long") * n)).alias("ordinals_dense"),
        "n_unsorted", "starts_before_previous")


def orphan_rows(records: DataFrame, alleles: DataFrame, key=("ordinal",)) -> DataFrame:
    """Referential check between stages (J3): records with no allele row
    (records without ALT) and allele rows with no record, by one aggregation
    of both sides' tagged keys."""
    k = [key] if isinstance(key, str) else list(key)
    both = (records.select(*k, F.lit(1).alias("_r"), F.lit(0).cast("long").alias("_a"))
            .unionByName(alleles.select(*k, F.lit(0).alias("_r"), F.lit(1).cast("long").alias("_a"))))
    seen = both.groupBy(*k).agg(F.sum("_r").alias("_r"), F.sum("_a").alias("_a"))
    n = seen.agg(F.coalesce(F.sum(F.when(F.col("_a") == 0, F.col("_r"))), F.lit(0)).alias("lone_r"),
                 F.coalesce(F.sum(F.when(F.col("_r") == 0, F.col("_a"))), F.lit(0)).alias("lone_a"))
    return n.select(F.inline(F.array(
        F.struct(F.lit("records_without_alleles").alias("check"), F.col("lone_r").cast("long").alias("n_rows")),
        F.struct(F.lit("alleles_without_record").alias("check"), F.col("lone_a").cast("long").alias("n_rows")))))
