"""A faulty twin of the fixture VCF, for the checks to find something.

Rendered from the same relation; faults are set by remainders of the
position (fixed values, mirrored by the SQL twins in ``oracle.py``): unreadable
QUAL, POS, AF and GQ (also numbers with a Java suffix), very small QUAL, a repeated and an unknown INFO key, undeclared contigs,
records moved out of order, FORMAT with its keys swapped, samples without
their last key, haploid and ``1/2`` calls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, session_key
from .fixture import GT_CODES, HEADER_LINES, pos_of_row, write_sorted_vcf

# fault -> (modulus, remainder) of the position
FAULTS = {"qual": (50, 0), "pos": (97, 1), "af": (41, 2), "repeat": (37, 3), "unknown": (29, 4), "contig": (31, 5),
          "moved": (200, 6), "gq": (53, 7), "qual_suffix": (59, 8), "af_suffix": (61, 9), "tiny": (47, 10)}


def _fault(name: str) -> Column:
    m, r = FAULTS[name]
    return F.col("pos") % m == r


def moved_pos() -> Column:
    """Sort position of a ``lineitem`` row: moved records come first."""
    m, r = FAULTS["moved"]
    return F.when(pos_of_row() % m == r, F.lit(0)).otherwise(pos_of_row())


def dirty_line(fx: DataFrame) -> tuple[DataFrame, Column]:
    """The faulty line of every record."""
    has_alt, two = F.col("alt1").isNotNull(), F.col("alt2").isNotNull()

    def gt(code: str, sep: str) -> Column:
        c = F.when(has_alt, F.col(code)).otherwise(F.lit(0))
        return F.get(F.array(*[F.lit(g.replace("/", sep)) for g in GT_CODES]), c.cast("int")), c

    def sample(code: str, sep: str, swap_text=None, gq=None, drop=None) -> Column:
        text, c = gt(code, sep)
        text = text if swap_text is None else F.when(swap_text[0], F.lit(swap_text[1])).otherwise(text)
        q = F.when(c == 3, F.lit(".")).otherwise(F.col("quantity").cast("string"))
        q = q if gq is None else F.when(gq, F.lit("q")).otherwise(q)
        out = F.when(F.col("linenumber") == 5, F.concat_ws(":", q, text)).otherwise(F.concat_ws(":", text, q))
        return out if drop is None else F.when(drop, text).otherwise(out)

    af = F.when(_fault("af"), F.lit("abc")).when(_fault("af_suffix"), F.lit("0.1f")).when(two, F.concat_ws(",", F.col("af1").cast("string"),
                                                                  F.col("af2").cast("string"))) \
        .otherwise(F.col("af1").cast("string"))
    info = F.concat(F.lit("AF="), af, F.lit(";DB"), F.when(_fault("repeat"), ";AF=9").otherwise(""),
                    F.when(_fault("unknown"), ";ZZ=1").otherwise(""))
    alts = F.when(~has_alt, F.lit(".")).when(two, F.concat_ws(",", "alt1", "alt2")).otherwise(F.col("alt1"))
    line = F.concat_ws(
        "\t", F.when(_fault("contig"), F.concat(F.lit("scaf"), F.col("contig_idx").cast("string"))).otherwise(F.col("chrom")),
        F.when(_fault("pos"), F.concat(F.lit("x"), F.col("pos").cast("string"))).otherwise(F.col("pos").cast("string")),
        F.lit("."), F.col("ref"), alts,
        F.when(_fault("qual"), "high").when(_fault("qual_suffix"), F.concat(F.col("quantity").cast("string"), F.lit("d")))
        .when(_fault("tiny"), F.concat(F.lit("0.0"), F.repeat(F.lit("0"), F.col("linenumber")), F.lit("25"))).otherwise(F.coalesce(F.col("qual").cast("string"), F.lit("."))),
        F.col("filter"), info, F.when(F.col("linenumber") == 5, "GQ:GT").otherwise("GT:GQ"),
        sample("g1", "/", (two & (F.col("g1") == 1), "1/2"), _fault("gq")),
        sample("g2", "/", drop=F.col("linenumber") == 2),
        sample("g3", "|", (F.col("linenumber") == 4, "1")))
    return fx, line


_CACHE: dict[tuple, str] = {}


def materialize_dirty_vcf(spark: SparkSession, sf_dir: str) -> str:
    """The faulty VCF as text part files, written once per session and input."""
    key = (session_key(spark), sf_dir)
    if key not in _CACHE:
        _CACHE[key] = write_sorted_vcf(spark, sf_dir, HEADER_LINES, dirty_line, scratch_path(spark, "dirty-vcf"), moved_pos())
    return _CACHE[key]
