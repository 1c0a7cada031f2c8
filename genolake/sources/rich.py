"""A fuller twin of the fixture VCF: lists by allele, haploid calls, PL, substitutions of several bases.

Rendered from the same relation with the fixed rules below (mirrored by the SQL
twins in ``oracle_tables.py``).  A third of its records carry, beside AF, the
keys AC (Number=A), RD (Number=R) and GL (Number=G); FORMAT holds GT, GQ, PL
(Number=G) and AD (Number=R).  S2 is haploid where the line number is even.
Records with line number 3 become substitutions: REF gets ``CA`` appended, the
first ALT ``TA``, so the first two bases differ and the third is the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, session_key
from .fixture import GT_CODES, HEADER_LINES, write_sorted_vcf

RICH_HEADER = [ln for ln in HEADER_LINES if not ln.startswith("#CHROM")] + [
    '##INFO=<ID=AC,Number=A,Type=Integer,Description="Allele count">',
    '##INFO=<ID=AN,Number=1,Type=Integer,Description="Called alleles">',
    '##INFO=<ID=RD,Number=R,Type=Integer,Description="Reads of each allele">',
    '##INFO=<ID=GL,Number=G,Type=Float,Description="Likelihood of each genotype">',
    '##FORMAT=<ID=PL,Number=G,Type=Integer,Description="Phred likelihood of each genotype">',
    '##FORMAT=<ID=AD,Number=R,Type=Integer,Description="Reads of each allele">',
    HEADER_LINES[-1]]


def _list(n: Column, first: Column, step: int = 1) -> Column:
    """``n`` numbers ``first, first + step, ...`` joined by commas."""
    return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: (first + i * step).cast("string")), ",")


def rich_line(fx: DataFrame) -> tuple[DataFrame, Column]:
    """The fuller line of every record, and the columns it is made of."""
    sub = (F.col("linenumber") == 3) & F.col("alt1").isNotNull()
    fx = (fx.withColumn("ref2", F.when(sub, F.concat("ref", F.lit("CA"))).otherwise(F.col("ref")))
          .withColumn("a1", F.when(sub, F.concat("alt1", F.lit("TA"))).otherwise(F.col("alt1")))
          .withColumn("a2", F.when(F.col("alt2").isNotNull(), F.concat("ref2", F.lit("TG"))))
          .withColumn("n", F.when(F.col("a1").isNull(), 0).when(F.col("a2").isNull(), 1).otherwise(2))
          .withColumn("haploid", F.col("linenumber") % 2 == 0))
    n, q = F.col("n"), F.col("quantity")
    diploid = F.expr("(n + 1) * (n + 2) div 2").cast("int")

    def sample(code: str, sep: str, haploid: Column) -> Column:
        c = F.when(n > 0, F.col(code)).otherwise(F.lit(0)).cast("int")
        two = F.get(F.array(*[F.lit(g.replace("/", sep)) for g in GT_CODES]), c)
        two = F.when((n == 2) & (c == 1), F.lit(f"1{sep}2")).otherwise(two)
        one = F.get(F.array(*map(F.lit, ["0", "1", "1", "."])), c)
        gt = F.when(haploid, F.when((n == 2) & (c == 2), F.lit("2")).otherwise(one)).otherwise(two)
        pl = F.when(c == 3, F.lit(".")).otherwise(_list(F.when(haploid, n + 1).otherwise(diploid), q, 10))
        return F.concat_ws(":", gt, F.when(c == 3, F.lit(".")).otherwise(q.cast("string")), pl, _list(n + 1, q))

    alts = F.when(n == 0, F.lit(".")).otherwise(F.concat_ws(",", "a1", "a2"))
    af = F.when(n == 2, F.concat_ws(",", F.col("af1").cast("string"), F.col("af2").cast("string"))).otherwise(F.col("af1").cast("string"))
    extra = F.when(q % 3 == 0, F.concat(
        F.when(n > 0, F.concat(F.lit(";AC="), _list(n, F.col("linenumber")))).otherwise(F.lit("")),
        F.lit(";AN=6;RD="), _list(n + 1, q, 2), F.lit(";GL="), _list(diploid, q + 100))).otherwise(F.lit(""))
    line = F.concat_ws(
        "\t", "chrom", F.col("pos").cast("string"), F.lit("."), "ref2", alts, F.coalesce(F.col("qual").cast("string"), F.lit(".")),
        "filter", F.concat(F.lit("AF="), af, F.lit(";DB"), extra), F.lit("GT:GQ:PL:AD"), sample("g1", "/", F.lit(False)),
        sample("g2", "/", F.col("haploid")), sample("g3", "|", F.lit(False)))
    return fx, line


_CACHE: dict[tuple, str] = {}


def materialize_rich_vcf(spark: SparkSession, sf_dir: str) -> str:
    """The VCF as sorted text part files, written once per session and input."""
    key = (session_key(spark), sf_dir)
    if key not in _CACHE:
        _CACHE[key] = write_sorted_vcf(spark, sf_dir, RICH_HEADER, rich_line, scratch_path(spark, "rich-vcf"))
    return _CACHE[key]
