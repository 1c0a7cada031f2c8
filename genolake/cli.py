"""Launch the two jobs with spark-submit (or ``python -m genolake.cli``).

    spark-submit genolake/cli.py summary SOURCE [--region R] [--limit N]
    spark-submit genolake/cli.py shard SOURCE --base URI [--records-per-shard N]
                 [--region R] [--run-id ID] [--redo] [--compact]
"""

from __future__ import annotations

import argparse
import json
import logging
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from genolake.plans.shard import shard  # noqa: E402
from genolake.plans.summary import summarize  # noqa: E402
from genolake.sources.vcf_text import DEFAULT_REMOTE_SCHEMES  # noqa: E402


def main(argv=None) -> int:
    logging.basicConfig(level=logging.INFO, format="%(levelname)s %(asctime)s %(name)s: %(message)s")

    def common(parser: argparse.ArgumentParser) -> None:
        parser.add_argument("--info-end", action="store_true", help="judge a region by INFO/END where a record has it")
        parser.add_argument("--scheme", action="append", default=[], help="a further scheme that Spark can read")

    p = argparse.ArgumentParser(prog="genolake")
    sub = p.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("summary", help="count variants per chromosome, bytes, preview")
    a.add_argument("source")
    a.add_argument("--region")
    a.add_argument("--limit", type=int)
    common(a)
    b = sub.add_parser("shard", help="cut into fixed-size shards with a manifest")
    b.add_argument("source")
    b.add_argument("--base", required=True, help="output base URI (shared storage)")
    b.add_argument("--records-per-shard", type=int, default=10000)
    b.add_argument("--region")
    b.add_argument("--run-id")
    b.add_argument("--redo", action="store_true", help="replace a committed run of this id")
    b.add_argument("--storage-type", default="local", help="kind of sink: local or hadoop")
    b.add_argument("--compact", action="store_true", help="one file per shard (adds a shuffle)")
    common(b)
    args = p.parse_args(argv)
    schemes = (*DEFAULT_REMOTE_SCHEMES, *args.scheme)
    spark = SparkSession.builder.appName(f"genolake-{args.cmd}").getOrCreate()
    if args.cmd == "summary":
        out = summarize(spark, args.source, args.region, args.limit, use_info_end=args.info_end,
                        remote_schemes=schemes)
        print(json.dumps({k: out[k] for k in ("total_variants", "total_bytes", "chromosomes")}))
    else:
        m = shard(spark, args.source, args.base, args.records_per_shard, args.region, args.run_id, args.compact,
                  redo=args.redo, sink=args.storage_type, use_info_end=args.info_end, remote_schemes=schemes)
        for r in m.select("path").orderBy("shard_id").toLocalIterator():
            print(r["path"])
    return 0


if __name__ == "__main__":
    sys.exit(main())
