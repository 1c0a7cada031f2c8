"""Inputs that are cut, named, ordered or spelled unusually."""

import os

import pytest
from pyspark.sql import functions as F

from genolake.functions.alleles import normalize
from genolake.functions.region import parse_region
from genolake.operators import compare as C, quality as Q, regions as R
from genolake.operators.aggregate import python_float_text
from genolake.operators.alleles import split_multiallelic
from genolake.operators.ordinal import prefix_sum, with_ordinal
from genolake.plans import export as E, shard as S, table as TB
from genolake.sources.scan import open_vcf
from genolake.streaming.incremental import start_incremental_load

from .conftest import HEADER, tsv

ROW = ("chr1", 100, ".", "A", "G", 10, "PASS", "AF=0.5", "GT:GQ", "0/1:5", "1/1:6", "0/0:7")


@pytest.mark.parametrize("name", ["a b.vcf", "p%20q.vcf", "x[1].vcf", "y{z}.vcf"])
def test_file_names(spark, tmp_path, name):
    d = tmp_path / "odd names"
    d.mkdir()
    (d / name).write_text(HEADER + "\n" + tsv(ROW, ROW) + "\n")
    s = open_vcf(spark, str(d))
    assert s.header.samples == ["NA1", "NA2", "NA3"] and s.head(1).count() == 1
    assert s.variants().count() == 2


def test_headers_of_all_files(spark, tmp_path):
    head = HEADER.replace("##contig=<ID=chr10,length=1000000>\n", "")
    (tmp_path / "a.vcf").write_text(head + "\n" + tsv(ROW) + "\n")
    (tmp_path / "b.vcf").write_text(HEADER + "\n" + tsv(("chr10",) + ROW[1:]) + "\n")
    s = open_vcf(spark, str(tmp_path))
    assert s.header.contigs == ["chr1", "chr2", "chr10"]
    assert s.variants().where("contig_idx IS NULL").count() == 0
    (tmp_path / "c.vcf").write_text(HEADER.replace("NA1\tNA2", "NA2\tNA1") + "\n" + tsv(ROW) + "\n")
    with pytest.raises(ValueError, match="sample columns"):
        open_vcf(spark, str(tmp_path))


def test_long_header(spark, tmp_path):
    many = "\n".join(f"##note={i}" for i in range(9000))
    (tmp_path / "a.vcf").write_text(HEADER.replace("##contig=<ID=chr1,", many + "\n##contig=<ID=chr1,") + "\n" + tsv(ROW) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000b")
    try:
        s = open_vcf(spark, str(tmp_path / "a.vcf"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(s.header.samples) == 3 and len(s.header.contigs) == 3


def test_prefix_sum(spark):
    rows = [(f"f{i % 7}", i, (i * 37) % 11) for i in range(500)]
    got = prefix_sum(spark.createDataFrame(rows, "f string, s long, n long").repartition(5), ["f", "s"], "n", "off").collect()
    want, total = {}, 0
    for f, s, n in sorted(rows):
        want[(f, s)] = total
        total += n
    assert {(r["f"], r["s"]): r["off"] for r in got} == want


def test_regions_past_32_bits(spark):
    v = spark.createDataFrame([("chr1", 3_000_000_000, "A"), ("chr1", 5, "ACGT"), ("chr2", 9, "A")], "chrom string, pos long, ref string")
    r = R.regions_frame(spark, ["chr1:2999999999-", "chr1:4000000000-", "chr2", "chr9", "chr1:8-8"])
    for small in (0, 1000):
        got = {x["region_id"]: x["n_variants"] for x in R.region_counts(v, r, small_max=small).collect()}
        assert got == {0: 1, 1: 0, 2: 1, 3: 0, 4: 1}


def test_region_names():
    assert parse_region("HLA-A*01:01:01:01:1-100", ["HLA-A*01:01:01:01", "HLA-A*01"]).chrom == "HLA-A*01:01:01:01"
    assert parse_region("HLA-A*01:01", ["HLA-A*01:01"]).end > 10**9
    r = parse_region("chr1:5-9", ["chr1"])
    assert (r.chrom, r.start, r.end) == ("chr1", 5, 9)
    for bad in ("", ":5", "chr1:x", "chr1:9-5"):
        with pytest.raises(ValueError):
            parse_region(bad)


def test_table_keeps_width_schema_and_contig_names(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("1", 5_000, "A"), ("02", 15_000_000, "C")], "chrom string, pos long, ref string")
    TB.load_table(df, path, width=10_000_000)
    assert {r["chrom"] for r in TB.read_table(spark, path).collect()} == {"1", "02"}
    assert TB.read_range(spark, path, 14_000_000, 16_000_000).count() == 1
    TB.load_table(df, path, width=10_000_000, mode="append")
    assert TB.read_table(spark, path).count() == 4
    with pytest.raises(ValueError, match="width"):
        TB.load_table(df, path, width=5, mode="append")
    with pytest.raises(ValueError, match="ref"):
        TB.load_table(df.drop("ref"), path, width=10_000_000, mode="append")


def test_tsv_keeps_null_items_and_genotypes(spark, vcf, tmp_path):
    v = open_vcf(spark, vcf(HEADER + "\n" + tsv(("chr1", 1, ".", "A", "C,G,T", 5, "PASS", "AF=0.1,.,0.3", "GT:GQ", "0/1:5",
                                                "1/1:.", "./.:7")))).variants()
    flat = E.write_tsv(v.select("pos", "af", "genotypes"), str(tmp_path / "t"))
    row = flat.first()
    assert row["af"] == "0.1,.,0.3" and row["genotypes_gt"] == "0/1;1/1;./." and row["genotypes_gq"] == "5;.;7"


def test_diff_sees_values_move_between_null_columns(spark):
    schema = "chrom string, pos long, ref string, alt string, qual double, af double"
    a = spark.createDataFrame([("c", 1, "A", "G", 0.5, None), ("c", 2, "A", "G", None, None)], schema)
    b = spark.createDataFrame([("c", 1, "A", "G", None, 0.5), ("c", 2, "A", "G", None, None)], schema)
    got = {r["pos"]: r["change"] for r in C.snapshot_diff(a, b, payload=("qual", "af")).collect()}
    assert got == {1: "changed", 2: "unchanged"}


def test_order_of_undeclared_contigs(spark):
    rows = [(0, None, "u1", 500), (1, None, "u1", 3), (2, None, "u2", 400), (3, None, "u1", 2), (4, 0, "chr1", 1)]
    v = spark.createDataFrame(rows, "ordinal long, contig_idx int, chrom string, pos long")
    got = {r["chrom"]: r["n_unsorted"] for r in Q.coordinate_order_report(v).collect()}
    assert got == {"u1": 2, "u2": 0, "chr1": 1}


def test_long_alleles_and_brute_force(spark):
    def brute(p, r, a):
        while len(r) > 1 and len(a) > 1 and r[-1] == a[-1]:
            r, a = r[:-1], a[:-1]
        while len(r) > 1 and len(a) > 1 and r[0] == a[0]:
            p, r, a = p + 1, r[1:], a[1:]
        return p, r, a

    import random
    import time

    rnd = random.Random(4)
    word = lambda n: "".join(rnd.choice("AC") for _ in range(n))
    rows = [(7, word(rnd.randint(1, 9)), word(rnd.randint(1, 9))) for _ in range(400)]
    big = word(20_000)
    rows += [(1, big, big[:9_000] + "G" + big[9_000:]), (1, big, big), (5, "AC" * 300 + "T", "AC" * 290 + "T")]
    df = spark.createDataFrame(rows, "pos long, ref string, alt string")
    df.limit(5).select(normalize().alias("n")).collect()
    t = time.time()
    got = df.select(normalize().alias("n")).collect()
    assert [tuple(r["n"]) for r in got] == [brute(*r) for r in rows]
    assert time.time() - t < 20


def test_repeated_info_key_is_reported(spark, vcf):
    v = open_vcf(spark, vcf(HEADER + "\n" + tsv(ROW[:7] + ("AF=0.1;AF=0.2",) + ROW[8:], ROW))).variants()
    assert sorted(tuple(r["_bad"]) for r in v.select("_bad").collect()) == [(), ("INFO",)]


def test_large_quality_text(spark):
    values = [12345678.0, 1e7, 123456789.5, 0.5, 10.0, None]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "q double").select(python_float_text(F.col("q"))).collect()]
    assert got == [str(v) for v in values]


@pytest.mark.parametrize("bad", ["../x", "a/b", "..", "", "a b"])
def test_run_ids_stay_inside(spark, vcf, tmp_path, bad):
    if not bad:
        assert S.checked_run_id(S.new_run_id())
        return
    with pytest.raises(ValueError, match="run id"):
        S.shard(spark, vcf(HEADER + "\n" + tsv(ROW)), str(tmp_path / "b"), run_id=bad)
    assert not os.path.exists(tmp_path / "x")


def test_incremental_load_with_default_settings(spark, vcf, tmp_path):
    base, out = str(tmp_path / "runs"), str(tmp_path / "alleles")
    src = vcf(HEADER + "\n" + tsv(*[ROW[:1] + (100 + i,) + ROW[2:] for i in range(10)]))
    counts = []
    for run, redo in (("r1", False), ("r2", False), ("r1", True)):
        S.shard(spark, src, base, 4, run_id=run, redo=redo)
        start_incremental_load(spark, base, out).awaitTermination()
        counts.append(spark.read.parquet(out).count())
    assert counts == [10, 20, 20]


def test_symbolic_records_by_their_end(spark, vcf, tmp_path):
    rows = [("chr1", 100, ".", "A", "<DEL>", 5, "PASS", "END=900", "GT", "0/1", "0/0", "0/0"), ROW]
    scan = open_vcf(spark, vcf(HEADER + "\n" + tsv(*rows)))
    assert S.shard_records(scan, 5, "chr1:500-600", use_info_end=True).count() == 1
    assert S.shard_records(scan, 5, "chr1:500-600").count() == 0
