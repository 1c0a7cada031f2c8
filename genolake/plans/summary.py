"""The summary job (A1-A4, A9, A10, L1, L2, P6): counts, bytes, preview.

Result has the reference's keys ``total_variants``, ``total_bytes``,
``chromosomes`` (count per chromosome).  Without a limit: one aggregate pass
over the source, and the head of it for the preview.  With a limit only the
head is read and counted (``VcfScan.head``).
"""

from __future__ import annotations

import logging

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators.aggregate import preview_text
from ..sources.scan import open_vcf
from ..sources.vcf_text import DEFAULT_REMOTE_SCHEMES, naming_source

log = logging.getLogger(__name__)


def summarize(spark: SparkSession, source, region=None, limit: int | None = None, preview: int = 10,
              use_info_end: bool = False, remote_schemes=DEFAULT_REMOTE_SCHEMES) -> dict:
    """Counts, bytes and preview of a VCF source, optionally of a region and of
    the first ``limit`` records in file order (0 or None = no limit).  One row
    per contig comes to the driver."""
    scan = open_vcf(spark, source, remote_schemes)
    h = scan.header
    log.info("%s: version %s, %d samples, %d contigs", source, h.version, len(h.samples), len(h.contigs))
    shown = min(preview, limit) if limit else preview  # the preview never passes the limit
    with naming_source(source, "stream"):
        v = scan.head(limit, region, use_info_end) if limit else scan.variants(region, use_info_end=use_info_end)
        per = v.groupBy("chrom").agg(F.count(F.lit(1)).alias("n"), F.sum("raw_len").alias("b")).collect()
        lines = []
        if shown > 0 and per:
            first = (v if limit else scan.head(shown, region, use_info_end)).where(F.col("ordinal") < shown)
            lines = [r["t"] for r in first.orderBy("ordinal").select(preview_text(first).alias("t")).collect()]
    for ln in lines:
        print(ln)
    chromosomes = {r["chrom"]: int(r["n"]) for r in sorted(per, key=lambda r: r["chrom"] or "")}
    total, total_bytes = sum(chromosomes.values()), sum(int(r["b"] or 0) for r in per)
    log.info("%s: %d records, %d bytes on %d contigs", source, total, total_bytes, len(chromosomes))
    return {"total_variants": total, "total_bytes": total_bytes, "chromosomes": chromosomes,
            "average_bytes": (total_bytes / total) if total else None, "preview": lines}
