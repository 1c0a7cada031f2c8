import json

from pyspark.sql import functions as F

from genolake import cli
from genolake.operators.regions import sort_coordinates
from genolake.plans import shard as S
from genolake.plans import table as TB
from genolake.schema import ALLELES, check_schema, schema_json
from genolake.sources.scan import open_vcf

from .conftest import HEADER, tsv


def test_sort_coordinates_uses_contig_order(spark):
    df = spark.createDataFrame([("chr10", 2, 5), ("chr2", 1, 9), ("chr1", 0, 3), ("chr10", 2, 1),
                                ("chrUn", None, 1), ("chr2", 1, 7)], "chrom string, contig_idx int, pos long")
    out = [(r["chrom"], r["pos"]) for r in sort_coordinates(df, 3).collect()]
    assert out == [("chr1", 3), ("chr2", 7), ("chr2", 9), ("chr10", 1), ("chr10", 5), ("chrUn", 1)]


def test_schema_check_allows_additions_only(spark, vcf, tmp_path):
    df = spark.createDataFrame([], ALLELES)
    stored = schema_json(df)
    assert check_schema(df.withColumn("extra", F.lit(1)), stored) == []
    assert check_schema(df.drop("af"), stored) == ["removed: af"]
    assert check_schema(df.withColumn("pos", F.col("pos").cast("int")), stored) == ["type changed: pos bigint -> int"]
    s = open_vcf(spark, vcf(HEADER + "\n" + tsv(("chr1", 5, ".", "A", "G", 1, "PASS", "AF=0.5", "GT", "0/1",
                                                  "0/0", "0/0"))))
    path = str(tmp_path / "t")
    TB.load_table(s.variants().select("chrom", "pos", "ref", "qual"), path, width=10)
    assert json.loads(TB.stored_schema(spark, path))["version"] == 1
    assert TB.read_table(spark, path).count() == 1  # the schema folder is not read as data


def test_cli_summary_and_shard(spark, vcf, tmp_path, capsys):
    src = vcf(HEADER + "\n" + tsv(*[("chr2", 10 + i, ".", "A", "G", 1, "PASS", ".", "GT", "0/1", "0/0", "0/0")
                                    for i in range(30)]))
    assert cli.main(["summary", src, "--limit", "7"]) == 0
    out = capsys.readouterr().out.strip().splitlines()
    assert json.loads(out[-1])["total_variants"] == 7 and out[0].startswith("Variant 1: chr2:10 A>G")
    base = str(tmp_path / "b")
    assert cli.main(["shard", src, "--base", base, "--records-per-shard", "8", "--run-id", "x"]) == 0
    paths = capsys.readouterr().out.strip().splitlines()
    assert len(paths) == 4 and paths[0].endswith("run_id=x/shard_id=0")
    p = S.read_params(spark, base).first()
    assert p["records_written"] == 30 and p["records_per_shard"] == 8
