"""The analytical table clustered by position and allele together, with Bloom filters (K8).

``load_table`` sorts a bucket by (ref, alt, pos): a lookup of one allele reads
few row groups, one of a position all of them.  Here rows follow a Z-order
curve over both: the place in the bucket and a hash of (ref, alt), 16 bits
each, interleaved, so that row groups are small in both directions.  Parquet
Bloom filters on ``ref`` and ``alt`` let an allele lookup skip row groups whose
minimum and maximum cover it by chance (where a column's dictionary still
holds all values of a row group, Parquet skips by that and writes no filter).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .table import load_table, range_filter, read_table, stored_schema, stored_width

Z_BITS = 16
# Fixed masks that spread 16 bits over every second of 32.
_SPREAD = ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555))


def _spread(c: Column) -> Column:
    for shift, mask in _SPREAD:
        c = (c.bitwiseOR(F.shiftleft(c, shift))).bitwiseAND(F.lit(mask).cast("long"))
    return c


def z_value(a: Column, b: Column) -> Column:
    """Two 16-bit numbers with their bits interleaved, ``a``'s first."""
    return F.shiftleft(_spread(a.cast("long")), 1).bitwiseOR(_spread(b.cast("long")))


def z_order(width: int) -> Column:
    """Curve place of a row in its bucket, by position and allele."""
    top = F.lit((1 << Z_BITS) - 1)
    place = F.least(F.floor((F.col("pos") % width) * (1 << Z_BITS) / F.lit(width)).cast("long"), top)
    allele = F.pmod(F.xxhash64("ref", "alt"), F.lit(1 << Z_BITS))
    return z_value(place, allele)


def load_clustered(df: DataFrame, path: str, width: int, bloom: tuple[str, ...] = ("ref", "alt"), distinct: int = 100_000,
                   row_group_bytes: int | None = None, options: dict[str, str] | None = None, **kw) -> str:
    """Write ``df`` in Z-order with Bloom filters on the columns ``bloom`` (``distinct`` values expected in a row group)."""
    options = {**(options or {}), **{f"parquet.bloom.filter.enabled#{c}": "true" for c in bloom}}
    options |= {f"parquet.bloom.filter.expected.ndv#{c}": str(int(distinct)) for c in bloom}
    if row_group_bytes:
        options |= {"parquet.block.size": str(int(row_group_bytes)), "parquet.block.size.row.check.min": "100"}
    return load_table(df, path, width=width, cluster=[z_order(width)], options=options, **kw)


def find_allele(spark: SparkSession, path: str, ref: str, alt: str, chrom: str | None = None,
                start: int | None = None, end: int | None = None) -> DataFrame:
    """Rows of one allele, anywhere or in a range; all conditions reach the Parquet scan."""
    t = read_table(spark, path).where((F.col("ref") == ref) & (F.col("alt") == alt))
    if start is not None:
        t = t.where(range_filter(start, end, chrom, width=stored_width(stored_schema(spark, path))))
    elif chrom is not None:
        t = t.where(F.col("chrom") == chrom)
    return t
