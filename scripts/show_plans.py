"""Write docs/plans.md: Spark's formatted physical plans of the key plan shapes.

Usage: python scripts/show_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from genolake.operators import regions as R  # noqa: E402
from genolake.plans import shard as S  # noqa: E402
from genolake.plans import table as TB  # noqa: E402
from genolake.registry import QUERIES, fixture_scan, part_regions  # noqa: E402
from genolake.session import build_session, scratch_path  # noqa: E402

NOTES = {
    "count_in_range": "One stage: text scan -> filter on POS (substring_index, no split) -> partial count; "
                      "only one row per chromosome per task crosses the exchange.",
    "table_range_query": "Loaded table: PartitionFilters on pos_bucket prune folders, PushedFilters on pos "
                         "reach the Parquet reader, ReadSchema holds only pos (chrom is a folder value).",
    "region_join_parts": "Binned interval join: regions exploded into position bins, counted on the driver, "
                         "broadcast under the size limit; variants are not shuffled.",
    "genotype_class_counts": "Per-sample rows via posexplode and the regex classifier, partially aggregated "
                             "in the same stage.",
    "join_alleles_bucketed": "Allele join of two bucketed tables: no Exchange under the join or the aggregation of the known "
                             "side; only the count per contig is shuffled. (At this size the known side is broadcast; with broadcasts off "
                             "it is a sort-merge join without Exchange, tested in tests/test_runs_tables.py.)",
    "region_over_shards": "Region read: the scan lists only the shard folders whose zone meets the region; contig and position "
                          "are pushed to the row groups.",
    "shard_write": "Shard records: broadcast join of the per-split offsets (driver-counted), no exchange of "
                   "the records before the partitioned write.",
}


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = re.sub(r"file:/\S+?/genolake/", "file:<scratch>/genolake/", buf.getvalue())
    return re.sub(r"#\d+L?", "", text)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    scan = fixture_scan(spark, sf)
    path = scratch_path(spark, "plans-table")
    a = QUERIES["split_multiallelic"](spark, sf).select("chrom", "pos", "ref", "alt", "allele_idx", "af", "qual")
    TB.load_table(a, path, width=10_000_000)
    frames = {
        "count_in_range": QUERIES["count_in_range"](spark, sf),
        "table_range_query": TB.read_table(spark, path).where(TB.range_filter(10_000_000, 20_000_000, width=10_000_000))
        .groupBy("chrom").agg(F.count(F.lit(1)).alias("variants")),
        "region_join_parts": R.region_counts(scan.variants(), part_regions(spark, sf)),
        "genotype_class_counts": QUERIES["genotype_class_counts"](spark, sf),
        "join_alleles_bucketed": QUERIES["join_alleles_bucketed"](spark, sf),
        "region_over_shards": QUERIES["region_over_shards"](spark, sf),
        "shard_write": S.shard_records(scan, 5000).select("shard_id", "ordinal", "value"),
    }
    out = ["# Physical plans of the key plan shapes", "",
           f"Generated by `scripts/show_plans.py` on `{sf}` (PySpark {spark.version}, AQE on; the plans are "
           "the pre-execution AQE plans, so codegen stage ids are not shown). Expression ids and scratch "
           "paths are elided.", ""]
    for name, df in frames.items():
        out += [f"## {name}", "", NOTES[name], "", "```", plan(df).strip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "plans.md"),
              "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
