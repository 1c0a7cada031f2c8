"""Region-set operators (J1, U1): variants against many intervals.

Two plan shapes, chosen on the driver from the region count (an action on
the region set only):

* **few regions** (``<= small_max``): broadcast the regions and run a
  left-semi / inner hash join on ``chrom`` with the overlap test as join
  condition.  Each variant probes only its own contig's few regions.
* **many regions**: cut both sides into fixed-width position bins
  (``explode(sequence(start div w, end div w))``), equi-join on
  ``(chrom, bin)`` and re-check the overlap.  A (variant, region) pair is
  kept only in the bin of ``greatest(pos, region_start)``, so every pair
  appears exactly once with no ``distinct``.  The region side is broadcast
  only when its binned row count times a row-size estimate is below
  ``broadcast_max_bytes`` (default 64 MB); otherwise
  both sides are shuffled on (chrom, bin) and AQE splits skewed bins.
  A semi join needs no pairs: there the regions are merged first.

Regions are a DataFrame ``(region_id, chrom, start, end)``, 1-based inclusive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.region import Region, parse_region, record_end
from ..session import stored
from .intervals import merged_with_gaps

DEFAULT_BIN, MIN_BIN = 100_000, 100
# A region of this many bins is cut at the last base of its contig's records first.
WIDE_BINS, MAX_CONTIGS = 10_000, 1_000
# Estimated bytes of one binned region row in a broadcast hash relation
# (contig name, three longs, id, row overhead).
_REGION_ROW_BYTES = 96


def regions_frame(spark: SparkSession, regions: list[str | Region]) -> DataFrame:
    """Region strings -> ``(region_id, chrom, start, end)``; ids follow list order."""
    rows = []
    for i, r in enumerate(regions):
        r = parse_region(r) if isinstance(r, str) else r
        rows.append((i, r.chrom, r.start, r.end, str(r)))
    return spark.createDataFrame(rows, "region_id int, chrom string, start long, end long, region string")


def _small_join(variants: DataFrame, regions: DataFrame, how: str) -> DataFrame:
    r = regions.select(F.col("chrom").alias("_r_chrom"), F.col("start").alias("_r_start"),
                       F.col("end").alias("_r_end"),
                       *[F.col(c) for c in regions.columns if c not in ("chrom", "start", "end")])
    cond = ((variants["chrom"] == r["_r_chrom"]) & (variants["pos"] <= r["_r_end"])
            & (variants["_v_end"] >= r["_r_start"]))
    return variants.join(F.broadcast(r), cond, how)


def _binned_pairs(variants: DataFrame, regions: DataFrame, bin_width: int,
                  broadcast_max_bytes: int) -> DataFrame:
    w = int(bin_width)
    # Open-ended regions ("chr1:100-") are binned up to the last base any record of their contig
    # covers; only the contigs that have such regions are looked at, and mostly none has.
    wide = F.expr(f"(end - start) div {w} >= {WIDE_BINS}")
    rb = regions.select(
        F.col("chrom").alias("_r_chrom"), F.col("start").alias("_r_start"), F.col("end").alias("_r_end"),
        *[F.col(c) for c in regions.columns if c not in ("chrom", "start", "end")])
    last = F.col("_r_end")
    contigs = [r["chrom"] for r in regions.where(wide).select("chrom").distinct().limit(MAX_CONTIGS + 1).collect()]
    if contigs:
        some = variants.where(F.col("chrom").isin(contigs)) if len(contigs) <= MAX_CONTIGS else variants
        tops = stored(some.groupBy("chrom").agg(F.max("_v_end").alias("_top")).withColumnRenamed("chrom", "_t_chrom"), "contig-ends")
        rb = rb.join(tops, rb["_r_chrom"] == tops["_t_chrom"], "left")
        last = F.when(F.expr(f"(_r_end - _r_start) div {w} >= {WIDE_BINS}"), F.least("_r_end", F.coalesce("_top", F.lit(0)))) \
            .otherwise(last)
    rb = (rb.withColumn("_last", last).where("_r_start <= _last")
          .withColumn("_bin", F.explode(F.sequence(F.expr(f"_r_start div {w}"), F.expr(f"_last div {w}"))))
          .drop("_last", "_top", "_t_chrom"))
    n_binned = rb.count()  # size check before any broadcast
    vb = variants.withColumn("_bin", F.explode(F.sequence(
        F.expr(f"pos div {w}"), F.expr(f"_v_end div {w}"))))
    if n_binned * _REGION_ROW_BYTES <= broadcast_max_bytes:
        rb = F.broadcast(rb)
    cond = ((vb["chrom"] == rb["_r_chrom"]) & (vb["_bin"] == rb["_bin"])
            & (vb["pos"] <= rb["_r_end"]) & (vb["_v_end"] >= rb["_r_start"])
            & (F.expr(f"greatest(pos, _r_start) div {w}") == vb["_bin"]))
    return vb.join(rb, cond, "inner").drop(vb["_bin"]).drop(rb["_bin"])


def _prepare(variants: DataFrame, use_info_end: bool) -> DataFrame:
    info = "info" if use_info_end and "info" in variants.columns else None
    return variants.withColumn("_v_end", record_end("pos", "ref", info))


def overlap_pairs(variants: DataFrame, regions: DataFrame, small_max: int = 1000,
                  bin_width: int = DEFAULT_BIN, broadcast_max_bytes: int = 64 << 20,
                  use_info_end: bool = False, n_regions: int | None = None) -> DataFrame:
    """Every (variant, region) pair that overlaps, each exactly once."""
    v = _prepare(variants, use_info_end)
    n = regions.count() if n_regions is None else n_regions
    if n <= small_max:
        out = _small_join(v, regions, "inner")
    else:
        out = _binned_pairs(v, regions, bin_width, broadcast_max_bytes)
    return out.drop("_v_end", "_r_chrom").withColumnRenamed("_r_start", "region_start") \
        .withColumnRenamed("_r_end", "region_end")


def _in_cells(v: DataFrame, regions: DataFrame, bin_width: int, broadcast_max_bytes: int) -> DataFrame:
    """Records that overlap a region, each once, however deep the regions lie on each other.

    The regions are merged; an island's cell runs from the base after the
    island before it to its own last base.  Cells do not overlap, so a record's
    position lies in one cell at most, and the record overlaps a region exactly
    if it reaches the start of that cell's island: a left-semi join on (contig,
    bin of the position) without pairs.  Bins are as wide as an island on
    average (``bin_width`` at most): about two rows an island, and few cells a bin.
    """
    cells = stored(merged_with_gaps(regions.where("start <= end")).select(
        F.col("chrom").alias("_r_chrom"), F.col("start").alias("_r_start"), F.col("end").alias("_r_end"),
        F.coalesce(F.col("before") + 1, F.least("start", F.lit(0))).alias("_cell")), "region-cells")
    # a cell as far as records can lie in it: open ends and far gaps make no bins beyond the records
    span = cells.agg(F.count(F.lit(1)).alias("n"), F.max("_r_end").alias("last"),
                     F.sum((F.col("_r_end") - F.col("_cell")).cast("double")).alias("bases")).first()
    if not span["n"]:
        return v.where("false")
    last = F.col("_r_end")
    if span["last"] // bin_width >= WIDE_BINS:
        tops = stored(v.groupBy("chrom").agg(F.max("pos").alias("_top")).withColumnRenamed("chrom", "_t_chrom"), "contig-ends")
        cells = cells.join(tops, cells["_r_chrom"] == tops["_t_chrom"]).drop("_t_chrom")
        last = F.least("_r_end", "_top")
    cells = cells.withColumn("_last", last).where("_cell <= _last").drop("_top")
    w = int(min(bin_width, max(MIN_BIN, span["bases"] // span["n"])))
    binned = cells.withColumn("_bin", F.explode(F.sequence(F.expr(f"_cell div {w}"), F.expr(f"_last div {w}")))).drop("_last")
    if binned.count() * _REGION_ROW_BYTES <= broadcast_max_bytes:
        binned = F.broadcast(binned)
    cond = ((v["chrom"] == binned["_r_chrom"]) & (F.expr(f"pos div {w}") == binned["_bin"]) & (v["pos"] >= binned["_cell"])
            & (v["pos"] <= binned["_r_end"]) & (v["_v_end"] >= binned["_r_start"]))
    return v.join(binned, cond, "left_semi")


def overlapping_any(variants: DataFrame, regions: DataFrame, small_max: int = 1000,
                    bin_width: int = DEFAULT_BIN, broadcast_max_bytes: int = 64 << 20,
                    use_info_end: bool = False, key: str | None = None) -> DataFrame:
    """Variants overlapping at least one region, each once (semi join, U1).

    Few regions: a broadcast left-semi join (no duplicates by construction).
    Many regions: a left-semi join with the cells of the merged regions (see
    ``_in_cells``).  Only records whose INFO/END lies before POS, which no
    merged region can judge, are paired with the regions and then made one row
    by ``key`` (a unique record id such as ``ordinal``; a row id is added if absent).
    """
    v = _prepare(variants, use_info_end)
    n = regions.count()
    if n <= small_max:
        return _small_join(v, regions, "left_semi").drop("_v_end")
    out = _in_cells(v.where("_v_end >= pos"), regions.select("chrom", "start", "end"), bin_width, broadcast_max_bytes).drop("_v_end")
    if not (use_info_end and "info" in v.columns):
        return out
    k = key or "_vid"
    back = v.where("_v_end < pos")
    if key is None:
        back = back.withColumn(k, F.monotonically_increasing_id())
    pairs = _binned_pairs(back, regions.select("chrom", "start", "end"), bin_width, broadcast_max_bytes)
    return out.unionByName(pairs.dropDuplicates([k]).select(*out.columns))


def region_counts(variants: DataFrame, regions: DataFrame, **kw) -> DataFrame:
    """Number of overlapping variants per region (regions with none give 0)."""
    pairs = overlap_pairs(variants.select("chrom", "pos", "ref", *(["info"] if kw.get("use_info_end") else [])),
                          regions.select("region_id", "chrom", "start", "end"), **kw)
    counts = pairs.groupBy("region_id").agg(F.count(F.lit(1)).alias("n_variants"))
    return (regions.join(counts, "region_id", "left")
            .withColumn("n_variants", F.coalesce(F.col("n_variants"), F.lit(0).cast("long"))))


def coordinate_keys(tie: tuple[str, ...] = ()) -> list:
    """Sort keys of coordinate order; undeclared contigs (null ``contig_idx``) go last, by name."""
    return [F.col("contig_idx").asc_nulls_last(), F.col("chrom"), F.col("pos"), *[F.col(c) for c in tie]]


def sort_coordinates(df: DataFrame, partitions: int | None = None, tie: tuple[str, ...] = ()) -> DataFrame:
    """Coordinate order (L3): range-partition on ``(contig_idx, pos)`` and
    sort inside partitions, so partition ``k`` holds the ``k``-th coordinate
    range and files written in partition order are globally sorted.  The
    range bounds include ``pos``, so one contig is spread over many tasks."""
    keys = coordinate_keys(tie)
    out = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return out.sortWithinPartitions(*keys)
