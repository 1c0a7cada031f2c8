import random

import pytest
from pyspark.sql import functions as F

from genolake.functions.alleles import genotype_class
from genolake.functions.region import MAX_COORD, Region, overlaps, parse_region
from genolake.operators import regions as R
from genolake.operators.alleles import allele_class_counts, normalize_alleles
from genolake.sources.scan import open_vcf

from .conftest import HEADER, tsv


@pytest.mark.parametrize("text,expected", [
    ("chr21", Region("chr21", 1, MAX_COORD)),
    ("chr21:1000-2000", Region("chr21", 1000, 2000)),
    ("chr21:1,000-2,000", Region("chr21", 1000, 2000)),
    ("chr21:1000", Region("chr21", 1000, MAX_COORD)),
    ("chr21:1000-", Region("chr21", 1000, MAX_COORD)),
])
def test_parse_region(text, expected):
    assert parse_region(text) == expected


@pytest.mark.parametrize("bad", ["", "chr1:x-y", "chr1:5-2", "chr1:0-10"])
def test_parse_region_rejects(bad):
    with pytest.raises(ValueError):
        parse_region(bad)


def test_deletion_reaching_into_region_overlaps(spark, vcf):
    rows = [("chr1", 995, ".", "ACGTACGTAC", "A", 1, "PASS", "."),   # 995..1004 reaches 1000
            ("chr1", 990, ".", "ACG", "A", 1, "PASS", "."),          # 990..992 does not
            ("chr1", 1500, ".", "A", "G", 1, "PASS", "."),
            ("chr1", 2001, ".", "A", "G", 1, "PASS", "."),
            ("chr2", 1500, ".", "A", "G", 1, "PASS", ".")]
    s = open_vcf(spark, vcf(HEADER + "\n" + tsv(*rows)))
    got = sorted((r["chrom"], r["pos"]) for r in s.variants("chr1:1000-2000").collect())
    assert got == [("chr1", 995), ("chr1", 1500)]
    between = s.variants().where(F.col("pos").between(1000, 2000)).count()  # position only: 2 (chr1, chr2)
    assert between == 2


def _brute(vs, rs):
    pairs = set()
    for i, (c, p, ref) in enumerate(vs):
        end = p + len(ref) - 1
        for rid, rc, a, b in rs:
            if c == rc and p <= b and end >= a:
                pairs.add((i, rid))
    return pairs


@pytest.mark.parametrize("small_max,bmax", [(10_000, 1 << 20), (0, 1 << 20), (0, 0)])
def test_region_join_matches_brute_force(spark, small_max, bmax):
    rnd = random.Random(7)
    vs = [(rnd.choice(["chr1", "chr2"]), rnd.randint(1, 5000), "A" * rnd.choice([1, 1, 1, 40, 300]))
          for _ in range(400)]
    rs = []
    for rid in range(60):
        a = rnd.randint(1, 5000)
        rs.append((rid, rnd.choice(["chr1", "chr2"]), a, a + rnd.choice([0, 5, 50, 700])))
    v = spark.createDataFrame([(i, c, p, ref) for i, (c, p, ref) in enumerate(vs)], "vid int, chrom string, pos long, ref string")
    r = spark.createDataFrame(rs, "region_id int, chrom string, start long, end long")
    pairs = R.overlap_pairs(v, r, small_max=small_max, bin_width=100, broadcast_max_bytes=bmax)
    got = {(x["vid"], x["region_id"]) for x in pairs.collect()}
    want = _brute(vs, rs)
    assert got == want
    assert pairs.count() == len(want)  # every pair exactly once
    semi = R.overlapping_any(v, r, small_max=small_max, bin_width=100, broadcast_max_bytes=bmax)
    assert sorted(x["vid"] for x in semi.collect()) == sorted({i for i, _ in want})
    counts = {x["region_id"]: x["n_variants"] for x in R.region_counts(v, r, small_max=small_max, bin_width=100,
                                                                  broadcast_max_bytes=bmax).collect()}
    for rid, *_ in rs:
        assert counts[rid] == sum(1 for _, j in want if j == rid)


def _py_normalize(pos, ref, alt):
    while len(ref) > 1 and len(alt) > 1 and ref[-1] == alt[-1]:
        ref, alt = ref[:-1], alt[:-1]
    while len(ref) > 1 and len(alt) > 1 and ref[0] == alt[0]:
        ref, alt, pos = ref[1:], alt[1:], pos + 1
    return pos, ref, alt


CASES = [(10, "A", "G"), (10, "ATT", "A"), (10, "ATT", "ATTTG"), (10, "CAGT", "CGGT"), (10, "GCACA", "GCA"),
         (10, "AC", "AC"), (10, "TTTA", "TTA"), (10, "A", "<DEL>"), (10, "ACGT", "AGGA")]


def test_normalize_matches_python_loop(spark):
    df = spark.createDataFrame(CASES, "pos long, ref string, alt string")
    got = {(r["orig_pos"], r["pos"], r["ref"], r["alt"]) for r in normalize_alleles(df).collect()}
    want = set()
    for p, ref, alt in CASES:
        if alt.startswith("<"):
            want.add((p, p, ref, alt))
        else:
            want.add((p, *_py_normalize(p, ref, alt)))
    assert got == want


def test_allele_classes(spark):
    df = spark.createDataFrame([("A", "G"), ("AC", "GT"), ("A", "AT"), ("AT", "A"), ("A", "<DEL>"), ("A", "*")],
                               "ref string, alt string")
    got = {r["allele_class"]: r["n_alleles"] for r in allele_class_counts(df).collect()}
    assert got == {"SNV": 1, "MNV": 1, "INS": 1, "DEL": 1, "SYMBOLIC": 2}


@pytest.mark.parametrize("gt,cls", [("0/0", "hom_ref"), ("0|0", "hom_ref"), ("0/1", "het"), ("1|0", "het"),
                                    ("1/1", "hom_alt"), ("1/2", "het"), ("./.", "missing"), ("./1", "missing"),
                                    ("1", "hom_alt"), ("0", "hom_ref"), (None, "missing"), ("2|2", "hom_alt")])
def test_genotype_class(spark, gt, cls):
    df = spark.createDataFrame([(gt,)], "gt string")
    assert df.select(genotype_class("gt")).first()[0] == cls


def test_overlaps_expression_whole_contig(spark):
    df = spark.createDataFrame([("chr1", 5, "A"), ("chr2", 5, "A")], "chrom string, pos long, ref string")
    assert df.where(overlaps(parse_region("chr1"))).count() == 1
