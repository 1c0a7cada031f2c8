"""Open a VCF source: header on the driver, records as lazy DataFrames (S1, S3, S4, S8)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.region import Region, overlaps, parse_region
from ..operators.flatten import flatten
from ..session import scratch_path
from .vcf_text import DEFAULT_REMOTE_SCHEMES, VcfHeader, body_lines, literal_path, naming_source, read_header, read_lines


# ``head`` takes this many records at most to the driver, from this many files; beyond, it counts splits.
TAKE_MAX, TAKE_FILES = 20_000, 8


@dataclass
class VcfScan:
    """A VCF source: its header and its line relation."""

    spark: SparkSession
    source: object
    header: VcfHeader
    lines: DataFrame  # the file relation, column ``value``

    def body(self, region: Region | str | None = None, with_split: bool = False) -> DataFrame:
        """Record lines (``value``, ``raw_len``), optionally region-prefiltered.

        ``with_split`` keeps the input split of each line (file path, byte
        offset), needed for file-order ordinals.
        """
        lines = self.lines
        if with_split:
            lines = lines.select("value", F.col("_metadata.file_path").alias("_split_file"),
                                 F.col("_metadata.file_block_start").alias("_split_start"))
        if region is not None:
            r = parse_region(region, self.header.contigs) if isinstance(region, str) else region
            # Cheap text prefilter on the CHROM field; the exact overlap test
            # runs after parsing.
            lines = lines.where(F.col("value").startswith(r.chrom + "\t"))
        keep = ("_split_file", "_split_start") if with_split else ()
        return body_lines(lines, keep)

    def variants(self, region: Region | str | None = None, with_split: bool = False,
                 use_info_end: bool = False) -> DataFrame:
        """Wide variant table (schema 1.2), restricted to ``region`` if given.

        A record's span is ``pos .. pos + len(ref) - 1``; with ``use_info_end``
        an ``INFO/END`` value (structural variants) takes precedence.
        """
        r = parse_region(region, self.header.contigs) if isinstance(region, str) else region
        v = flatten(self.body(r, with_split=with_split), self.header)
        if r is not None:
            v = v.where(overlaps(r, info="info" if use_info_end else None))
        return v


    def head(self, n: int | None, region: Region | str | None = None, use_info_end: bool = False) -> DataFrame:
        """The first ``n`` records in file order (``ordinal < n``); 0 or None: all of them.

        Files in path order are the VCF's order.  Up to ``TAKE_MAX`` records
        are taken from the leading files one after another: Spark's ``take``
        runs on a file's leading splits only, more of them as long as records
        are missing, so ten records of a file of any size cost its first split.

        What is still missing then (more records, or many files with few of
        them) lies in the shortest prefix of the remaining files that holds it.
        The prefix grows in doubling batches (records counted by input split);
        then only the splits that hold the first ``n`` are numbered.  If the
        input was cut differently meanwhile, the counts disagree and the call
        fails rather than answer wrongly.
        """
        with naming_source(self.source, "read"):
            return self._head(n, region, use_info_end)

    def _head(self, n: int | None, region: Region | str | None, use_info_end: bool) -> DataFrame:
        files = sorted(self.lines.inputFiles())
        if n and files and n <= TAKE_MAX:
            rows: list[tuple[str, int]] = []
            for at, file in enumerate(files[:TAKE_FILES]):
                more = self._on([file])._leading(n - len(rows), region, use_info_end)
                if more is None:
                    return self._counted_head(n, region, use_info_end)
                rows += more
                if len(rows) >= n or at + 1 == len(files):
                    return self._numbered(rows)
            rest = self._on(files[TAKE_FILES:])._counted_head(n - len(rows), region, use_info_end)
            return self._numbered(rows).unionByName(rest.withColumn("ordinal", F.col("ordinal") + len(rows)))
        return self._counted_head(n, region, use_info_end)

    def _leading(self, n: int, region: Region | str | None, use_info_end: bool) -> list[tuple[str, int]] | None:
        """Up to ``n`` first records of a source of one file, in its order (None: its splits did not come in order)."""
        wanted = self.variants(region, with_split=True, use_info_end=use_info_end)
        rows = wanted.select("value", "raw_len", "_split_start").take(n)
        if any(a["_split_start"] > b["_split_start"] for a, b in zip(rows, rows[1:])):
            return None
        return [(r["value"], r["raw_len"]) for r in rows]

    def _numbered(self, rows: list[tuple[str, int]]) -> DataFrame:
        """Wide rows of record lines at hand."""
        lines = self.spark.createDataFrame([(v, b, i) for i, (v, b) in enumerate(rows)], "value string, raw_len int, ordinal long")
        return flatten(lines, self.header)

    def _counted_head(self, n: int | None, region: Region | str | None, use_info_end: bool) -> DataFrame:
        from ..operators.ordinal import SPLIT_COLS, limit_records, prefix_sum, with_ordinal

        def records(files: list[str]) -> DataFrame:
            return self._on(files).variants(region, with_split=True, use_info_end=use_info_end)

        files = sorted(self.lines.inputFiles())
        if not n or not files:
            return with_ordinal(self.variants(region, with_split=True, use_info_end=use_info_end))
        chosen, seen, step, counts = [], 0, 1, None
        while len(chosen) < len(files) and seen < n:
            batch = files[len(chosen):len(chosen) + step]
            per = records(batch).groupBy(*SPLIT_COLS).agg(F.count(F.lit(1)).alias("_n"))
            path = scratch_path(self.spark, "split-counts")
            per.write.parquet(path)
            per = self.spark.read.schema(per.schema).parquet(path)
            seen += per.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
            counts = per if counts is None else counts.unionByName(per)
            chosen += batch
            step *= 2
        needed = prefix_sum(counts, list(SPLIT_COLS), "_n", "_off").where(F.col("_off") < n)
        out = with_ordinal(records(chosen).join(needed.select(*SPLIT_COLS), list(SPLIT_COLS), "left_semi"))
        want, got = needed.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0], out.count()
        if want != got:
            raise RuntimeError(f"the input was cut differently while it was read: {want} records, then {got}")
        return limit_records(out, n)

    def _on(self, files: list[str]) -> "VcfScan":
        """The same source restricted to some of its files (same header)."""
        return VcfScan(self.spark, self.source, self.header, self.spark.read.text([literal_path(f) for f in files]))


def open_vcf(spark: SparkSession, source, remote_schemes=DEFAULT_REMOTE_SCHEMES) -> VcfScan:
    """Resolve the source, read its header, return the scan handle."""
    lines = read_lines(spark, source, remote_schemes)
    try:
        header = read_header(spark, lines)
    except ValueError:
        raise
    except Exception as e:
        raise IOError(f"Failed to read VCF header from {source}: {e}") from e
    return VcfScan(spark, source, header, lines)
