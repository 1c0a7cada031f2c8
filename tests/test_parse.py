from pyspark.sql import functions as F

from genolake.functions import parse as P
from genolake.operators.alleles import genotypes_long, split_multiallelic
from genolake.sources.scan import open_vcf

from .conftest import HEADER, tsv

ROWS = [
    # chrom pos id ref alt qual filter info format samples...
    ("chr1", 100, "rs1", "A", "G,T", 50, "PASS", "AF=0.1,0.2;DP=10;DB", "GT:GQ:PL",
     "0/1:30:0,10,100,20,30,40", "1/2:20:5,5,5,5,5,5", "./.:.:."),
    ("chr1", 200, ".", "C", ".", ".", ".", ".", "GT:GQ", "0/0:10", "0|0:11", "0/0"),      # dots, trailing key absent
    ("chr2", 300, ".", "GT", "G", 20, "q10;s50", "DP=5;DP=7;AF=0.5", "GQ:GT", "99:1", "12:0|1", "7:."),  # dup key, order
    ("chr10", 400, ".", "T", "TA", "x", "PASS", "AF=abc;DP=1.5", "GT", "1", "0", "."),   # haploid, bad values
]


def _scan(spark, vcf):
    return open_vcf(spark, vcf(HEADER + "\n" + tsv(*ROWS)))


def test_fixed_fields_and_missing_dots(spark, vcf):
    rows = {r["pos"]: r for r in _scan(spark, vcf).variants().collect()}
    r = rows[100]
    assert (r["chrom"], r["id"], r["ref"], r["alts"], r["qual"], r["filters"]) == \
        ("chr1", "rs1", "A", ["G", "T"], 50.0, ["PASS"])
    r = rows[200]
    assert r["id"] is None and r["alts"] == [] and r["qual"] is None and r["filters"] == []
    assert r["info"] == {}
    assert rows[300]["filters"] == ["q10", "s50"]


def test_contig_index_follows_header_not_string_order(spark, vcf):
    rows = {r["chrom"]: r["contig_idx"] for r in _scan(spark, vcf).variants().collect()}
    assert rows == {"chr1": 0, "chr2": 1, "chr10": 2}


def test_info_map_flags_and_typed_values(spark, vcf):
    rows = {r["pos"]: r for r in _scan(spark, vcf).variants().collect()}
    r = rows[100]
    assert r["info"] == {"AF": "0.1,0.2", "DP": "10", "DB": None}
    assert r["af"] == [0.1, 0.2]


def test_duplicate_info_key_first_wins(spark, vcf):
    r = _scan(spark, vcf).variants().where("pos = 300").first()
    assert r["info"]["DP"] == "5"
    assert r["af"] == [0.5]


def test_format_order_and_absent_trailing_keys(spark, vcf):
    rows = {r["pos"]: r for r in _scan(spark, vcf).variants().collect()}
    g = rows[300]["genotypes"]
    assert [(x["gt"], x["gq"]) for x in g] == [("1", 99), ("0|1", 12), (None, 7)]
    g = rows[200]["genotypes"]
    assert [(x["gt"], x["gq"]) for x in g] == [("0/0", 10), ("0|0", 11), ("0/0", None)]


def test_pl_lists_and_missing_genotype(spark, vcf):
    g = _scan(spark, vcf).variants().where("pos = 100").first()["genotypes"]
    assert g[0]["pl"] == [0, 10, 100, 20, 30, 40]
    assert g[1]["gt"] == "1/2"
    assert g[2]["gt"] == "./." and g[2]["gq"] is None and g[2]["pl"] is None


def test_bad_values_are_null_and_listed(spark, vcf):
    r = _scan(spark, vcf).variants().where("pos = 400").first()
    assert r["qual"] is None and "qual" in r["_bad"] and "AF" in r["_bad"]
    assert r["af"] == [None]
    assert [x["gt"] for x in r["genotypes"]] == ["1", "0", None]


def test_split_multiallelic_number_a(spark, vcf):
    a = split_multiallelic(_scan(spark, vcf).variants(), keep=("pos", "ref"))
    got = sorted((r["pos"], r["alt"], r["allele_idx"], r["af"]) for r in a.collect())
    assert got == [(100, "G", 1, 0.1), (100, "T", 2, 0.2), (300, "G", 1, 0.5), (400, "TA", 1, None)]


def test_genotypes_long_matches_nested(spark, vcf):
    s = _scan(spark, vcf)
    v = s.variants()
    long_rows = sorted((r["pos"], r["sample_idx"], r["gt"], r["gq"])
                       for r in genotypes_long(v, s.header.samples).collect())
    nested = sorted((r["pos"], g["sample_idx"], g["gt"], g["gq"])
                    for r in v.select("pos", "genotypes").collect() for g in r["genotypes"])
    assert long_rows == nested
    assert genotypes_long(v, s.header.samples).where("sample_idx = 2").select("sample").distinct() \
        .first()[0] == "NA3"


def test_short_line_is_flagged(spark, vcf):
    s = open_vcf(spark, vcf(HEADER + "\nchr1\t5\t.\tA"))
    r = s.variants().first()
    assert "fields" in r["_bad"] and r["alts"] == []


def test_only_needed_fields_are_split(spark, vcf):
    v = _scan(spark, vcf).variants()
    plan = v.where(F.col("pos") > 150).groupBy("chrom").count()._jdf.queryExecution().optimizedPlan().toString()
    assert "substring_index" in plan and "split(value" not in plan.replace(" ", "")


def test_typed_info_from_header(spark, vcf):
    from genolake.operators.flatten import with_typed_info

    s = _scan(spark, vcf)
    rows = {r["pos"]: r["info_typed"] for r in with_typed_info(s.variants(), s.header).collect()}
    assert rows[100].asDict() == {"AF": [0.1, 0.2], "DP": 10, "DB": True}
    assert rows[200].asDict() == {"AF": None, "DP": None, "DB": False}
    assert rows[300]["DP"] == 5  # repeated key: first wins
    assert rows[400]["AF"] == [None] and rows[400]["DP"] is None  # bad values are null


def test_info_values_read_from_the_text(spark):
    rows = [("AF=1;XAF=2",), ("XAF=2;AF=3",), ("AF;AF=4",), ("AF=",), ("AF",), ("BAF=1",), ("A.F=1;AF=a=b",), (None,), (".",)]
    df = spark.createDataFrame(rows, "info string")
    got = df.select(P.info_value(F.col("info"), "AF").alias("v"), P.info_flag(F.col("info"), "AF").alias("f"),
                    P.info_value(F.col("info"), "A.F").alias("d")).collect()
    assert [r["v"] for r in got] == ["1", "3", "4", "", None, None, "a=b", None, None]
    assert [r["f"] for r in got] == [True, True, True, True, True, False, True, False, False]
    assert [r["d"] for r in got] == [None] * 6 + ["1", None, None]
