"""Fixture VCF derived from ``lineitem`` (see FIXTURES.md section 3).

``fixture_relation`` is the relation ``fx``; ``write_sorted_vcf`` renders it
as VCF text (header + records in ``(contig_idx, pos, line)`` order), and
``materialize_fixture_vcf`` writes that text once under the shared scratch
folder so every query starts from a real VCF scan (``spark.read.text``).
The SQL twin of ``fx`` used by the DuckDB oracle lives in ``oracle.py``.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, session_key

# Fixed values of the fixture (FIXTURES.md): 22 contigs chr1..chr22, three
# samples, and the genotype code table 0 -> 0/0, 1 -> 0/1, 2 -> 1/1, 3 -> ./.
N_CONTIGS = 22
SAMPLES = ["S1", "S2", "S3"]
GT_CODES = ["0/0", "0/1", "1/1", "./."]
MAX_POS = 45000000

HEADER_LINES = (
    ["##fileformat=VCFv4.2"]
    + ['##FILTER=<ID=PASS,Description="All filters passed">',
       '##FILTER=<ID=LowQual,Description="Low quality">']
    + [f"##contig=<ID=chr{i}>" for i in range(1, N_CONTIGS + 1)]
    + ['##INFO=<ID=AF,Number=A,Type=Float,Description="Allele Frequency">',
       '##INFO=<ID=DB,Number=0,Type=Flag,Description="dbSNP membership">',
       '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">',
       '##FORMAT=<ID=GQ,Number=1,Type=Integer,Description="Genotype Quality">',
       "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT"] + SAMPLES)]
)


# The columns of ``lineitem`` that the fixtures are made of.
LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                 "l_returnflag", "l_linestatus"]


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(*LINEITEM_COLS)


def contig_of_row() -> Column:
    return F.col("l_suppkey") % N_CONTIGS


def pos_of_row() -> Column:
    return (F.col("l_orderkey") * 3001 + F.col("l_partkey") * 17 + F.col("l_linenumber")) % MAX_POS + 1


def fixture_relation(li: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The relation ``fx``: one variant per row of ``li`` (see ``lineitem``); columns in ``keep`` pass through."""
    rf, ln = F.col("l_returnflag"), F.col("l_linenumber")
    t = li.select(
        *keep,
        F.concat(F.lit("chr"), (contig_of_row() + 1).cast("string")).alias("chrom"),
        contig_of_row().alias("contig_idx"),
        pos_of_row().alias("pos"),
        F.concat(F.when(rf == "A", "A").when(rf == "N", "C").otherwise("G"),
                 F.when(ln == 7, "TT").otherwise("")).alias("ref"),
        F.when(F.col("l_tax") == 0, None).otherwise(F.col("l_extendedprice")).alias("qual"),
        F.when(F.col("l_discount") == 0, "LowQual").otherwise("PASS").alias("filter"),
        F.col("l_discount").alias("af1"),
        (F.col("l_discount") / 2).alias("af2"),
        ln.alias("linenumber"),
        F.col("l_linestatus").alias("linestatus"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (ln % 4).alias("g1"), (F.col("l_partkey") % 4).alias("g2"), (F.col("l_suppkey") % 4).alias("g3"),
    )
    q, ref = F.col("quantity"), F.col("ref")
    alt1 = (F.when(q == 1, None)
            .when(F.col("linenumber") == 7, F.substring(ref, 1, 1))
            .when(F.col("linenumber") == 6, F.concat(ref, F.lit("AC")))
            .when(F.col("linestatus") == "F", "T")
            .when(ref == "A", "G").otherwise("A"))
    alt2 = F.when(q > 45, F.concat(ref, F.lit("TG")))
    return t.withColumn("alt1", alt1).withColumn("alt2", alt2)


def _sample_field(code: Column, sep: str) -> Column:
    has_alt = F.col("alt1").isNotNull()
    code = F.when(has_alt, code).otherwise(F.lit(0))
    gt = F.get(F.array(*[F.lit(g.replace("/", sep)) for g in GT_CODES]), code.cast("int"))
    gq = F.when(code == 3, F.lit(".")).otherwise(F.col("quantity").cast("string"))
    return F.concat(gt, F.lit(":"), gq)


def render_line(fx: DataFrame) -> Column:
    """The tab-separated record line of a fixture row."""
    two = F.col("alt2").isNotNull()
    alts = (F.when(F.col("alt1").isNull(), F.lit("."))
            .when(two, F.concat_ws(",", "alt1", "alt2")).otherwise(F.col("alt1")))
    af = F.when(two, F.concat_ws(",", F.col("af1").cast("string"), F.col("af2").cast("string"))
                ).otherwise(F.col("af1").cast("string"))
    return F.concat_ws(
        "\t", F.col("chrom"), F.col("pos").cast("string"), F.lit("."), F.col("ref"), alts,
        F.coalesce(F.col("qual").cast("string"), F.lit(".")), F.col("filter"),
        F.concat(F.lit("AF="), af, F.lit(";DB")), F.lit("GT:GQ"),
        _sample_field(F.col("g1"), "/"), _sample_field(F.col("g2"), "/"), _sample_field(F.col("g3"), "|"))


# Rows of one sorted part of a rendered VCF: what a task sorts stays the same however many rows there are.
PART_ROWS = 1_000_000


def write_sorted_vcf(spark: SparkSession, sf_dir: str, header_lines: list[str], render: Callable[[DataFrame], tuple[DataFrame, Column]],
                     out: str, k2: Column | None = None, part_rows: int = PART_ROWS) -> str:
    """Write header and records as text part files in ``(contig_idx, k2, line)`` order (``k2``: POS unless given).

    ``lineitem``'s own columns travel by range of (contig, ``k2``), which
    samples and shuffles no rendered text; lines are rendered and sorted inside
    the ranges.  Beyond ``part_rows`` times the shuffle partitions the ranges
    grow in number, not in size, so no sort spills.
    """
    li = lineitem(spark, sf_dir)
    k2 = pos_of_row() if k2 is None else k2
    rows = li.select(contig_of_row().cast("long").alias("k1"), k2.cast("long").alias("k2"), *LINEITEM_COLS)
    header = spark.createDataFrame([(-1, i, ln) for i, ln in enumerate(header_lines)], "k1 long, k2 long, header string")
    rows = rows.unionByName(header.coalesce(1), allowMissingColumns=True)
    parts = -(-li.count() // part_rows)  # from the files' footers
    more = (parts,) if parts > int(spark.conf.get("spark.sql.shuffle.partitions")) else ()
    placed = rows.repartitionByRange(*more, "k1", "k2")
    fx, line = render(fixture_relation(placed, ("k1", "k2", "header")))
    (fx.select("k1", "k2", F.coalesce("header", line).alias("value")).sortWithinPartitions("k1", "k2", "value").select("value")
     .write.mode("errorifexists").text(out))
    return out


_CACHE: dict[tuple, str] = {}


def materialize_fixture_vcf(spark: SparkSession, sf_dir: str) -> str:
    """Write the fixture VCF as sorted text part files; return the folder.

    The global sort is a range-partitioned shuffle (``write_sorted_vcf``), so the part files in name
    order are the VCF in coordinate order, header first in part 0.  Written
    once per (session, input) and reused.
    """
    li = f"{sf_dir}/lineitem.parquet"
    try:
        st = os.stat(li)
        stamp = (st.st_size, int(st.st_mtime))
    except OSError:
        stamp = None
    key = (session_key(spark), os.path.abspath(sf_dir) if stamp else sf_dir, stamp)
    if key in _CACHE:
        return _CACHE[key]
    out = scratch_path(spark, "fixture-vcf")
    write_sorted_vcf(spark, sf_dir, HEADER_LINES, lambda fx: (fx, render_line(fx)), out)
    _CACHE[key] = out
    return out
