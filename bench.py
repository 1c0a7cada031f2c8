"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3; the median of the timed runs is reported, after one
untimed warm-up run of every query).

The fixture VCF text is rendered from ``lineitem`` and written once before
timing ("prepare_sec"); every timed query then scans that text with
``spark.read.text`` and parses it, as a query over a raw VCF would.  Each
query is forced to completion with a ``noop`` write (no collect).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from genolake.registry import QUERIES  # noqa: E402
from genolake.session import build_session  # noqa: E402
from genolake.sources.fixture import materialize_fixture_vcf  # noqa: E402

HEADLINE = [
    "count_in_range",      # the design document's validation query (A5)
    "region_scan",         # region-restricted scan (S4/P1)
    "count_by_chrom",      # per-chromosome counts (A2)
    "stream_summary",      # the reference's summary numbers (A1/A3/A4)
    "split_multiallelic",  # allele table (T4)
    "normalize_alleles",   # T5
    "allele_class_counts",  # A6
    "genotype_class_counts",  # A7 (explode + partial aggregate)
    "genotypes_long",      # T7
    "region_join_parts",   # binned interval join, large region set (J1)
    "join_alleles",        # allele join (J2)
    "snapshot_diff",       # U2
    "shard_manifest",      # ordinals + shards (K1/K4)
    "load_variants",       # partitioned table load + pruned range query (K8)
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = max(1, int(os.environ.get("BENCH_RUNS", "3")))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus))
    t0 = time.time()
    materialize_fixture_vcf(spark, sf_dir)
    prepare = time.time() - t0

    def run(name: str) -> float:
        t = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.time() - t

    for name in HEADLINE:  # JVM / JIT warm-up: every query once, untimed
        run(name)
    times = {}
    for name in HEADLINE:
        samples = [run(name) for _ in range(runs)]
        times[name] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus, "runs": runs, "prepare_sec": round(prepare, 3),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
