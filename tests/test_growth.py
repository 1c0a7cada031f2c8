"""Steps whose cost must not grow faster than the input: sorted rendering, numbering, semi joins, checks by shard, buckets."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from genolake import registry as REG
from genolake.operators import quality as Q
from genolake.operators import regions as R
from genolake.plans.buckets import buckets_for
from genolake.sources import fixture as FX

from .conftest import SF_SMALL


def texts(path):
    files = sorted(glob.glob(f"{path.removeprefix('file:')}/part-*"))
    return len(files), "".join(open(f).read() for f in files)


def test_rendered_parts_grow_in_number(spark, tmp_path):
    def write(name, rows):
        return FX.write_sorted_vcf(spark, SF_SMALL, FX.HEADER_LINES, lambda fx: (fx, FX.render_line(fx)), str(tmp_path / name), part_rows=rows)

    few, text = texts(write("few", 1_000_000))
    many, same = texts(write("many", 200))
    assert few <= 8 < many and text == same
    lines = text.splitlines()[len(FX.HEADER_LINES):]
    keys = [(int(ln.split("\t")[0][3:]), int(ln.split("\t")[1]), ln) for ln in lines]
    assert text.splitlines()[:len(FX.HEADER_LINES)] == FX.HEADER_LINES and keys == sorted(keys)


def test_numbering_writes_the_named_columns_only(spark):
    scan = REG.fixture_scan(spark, SF_SMALL)
    v = REG._ordered(scan, "chrom", "pos")
    assert v.columns == ["chrom", "pos", "ordinal"]
    assert "genotypes" not in v._jdf.queryExecution().toString()
    want = REG._ordered(scan).select("chrom", "pos", "ordinal")
    assert sorted(v.collect()) == sorted(want.collect())


@pytest.mark.parametrize("bmax", [1 << 20, 0])
def test_semi_join_of_deep_regions_makes_no_pairs(spark, bmax):
    rnd = random.Random(3)
    vs = [(i, rnd.choice(["chr1", "chr2", "chr3", None]), rnd.choice([None, *[rnd.randint(1, 60_000) for _ in range(9)]]),
           "A" * rnd.choice([1, 1, 3, 700])) for i in range(1500)]
    rs = [(c, a, a + rnd.choice([-5, 0, 3, 900])) for c in ("chr1", "chr2") for a in [rnd.randint(1, 60_000) for _ in range(60)]]
    rs += [("chr2", 30_000, 30_900)] * 300 + [("chr2", 59_000, 1 << 62), (None, 1, 10), ("chr1", None, 10)]
    v = spark.createDataFrame(vs, "vid int, chrom string, pos long, ref string")
    r = spark.createDataFrame(rs, "chrom string, start long, end long")
    out = R.overlapping_any(v, r, small_max=0, broadcast_max_bytes=bmax, key="vid")
    want = [i for i, c, p, ref in vs if c and p and any(
        c == rc and a is not None and a <= b and p <= b and p + len(ref) - 1 >= a for rc, a, b in rs)]
    assert out.columns == v.columns and sorted(x["vid"] for x in out.collect()) == want
    text = out._jdf.queryExecution().toString()
    assert "LeftSemi" in text and "Deduplicate" not in text


def test_semi_join_of_records_that_end_before_they_start(spark):
    v = spark.createDataFrame([(1, "chr1", 15, "A", {"END": "5"}), (2, "chr1", 8, "A", {"END": "5"}), (3, "chr1", 15, "A", {"END": "40"}),
                               (4, "chr1", 25, "A", {})], "vid int, chrom string, pos long, ref string, info map<string,string>")
    r = spark.createDataFrame([("chr1", 1, 10), ("chr1", 10, 20)], "chrom string, start long, end long")
    for key in ("vid", None):
        out = R.overlapping_any(v, r, small_max=0, use_info_end=True, key=key)
        assert sorted(x["vid"] for x in out.collect()) == [2, 3]


def test_order_checks_get_more_partitions(spark, monkeypatch):
    v = spark.range(1000).select(F.col("id").alias("ordinal"), F.lit(0).alias("contig_idx"), F.lit("chr1").alias("chrom"),
                                 (F.col("id") * 3 % 101).alias("pos"), (F.col("id") / 50).cast("int").alias("shard_id"))
    want = sorted(Q.shard_validation(v, 50).collect())
    monkeypatch.setattr(Q, "PARTITION_ROWS", 50)
    out = Q.shard_validation(v, 50)
    assert "hashpartitioning(shard_id" in (text := out._jdf.queryExecution().toString()) and ", 20)" in text
    assert sorted(out.collect()) == want


def test_buckets_grow_in_number():
    assert [buckets_for(n, 16, 100) for n in (0, 1600, 1601, 100_000)] == [16, 16, 17, 1000]
