import os

import pytest
from pyspark.sql import functions as F

from genolake.operators import compare as C
from genolake.operators import quality as Q
from genolake.operators.alleles import split_multiallelic
from genolake.plans import export as E
from genolake.plans import inventory as I
from genolake.plans import shard as S
from genolake.plans import table as TB
from genolake.sources.scan import open_vcf
from genolake.streaming.incremental import start_incremental_load

from .conftest import HEADER, tsv

ROWS = [("chr1", 100 + 7 * i, ".", "A", "G,T" if i % 4 == 0 else "C", 10 + i, "PASS",
         "AF=0.1,0.2;DB" if i % 4 == 0 else "AF=0.3", "GT:GQ", "0/1:5", "1/1:.", "./.:9") for i in range(60)]


def _scan(spark, vcf):
    return open_vcf(spark, vcf(HEADER + "\n" + tsv(*ROWS)))


def test_tsv_roundtrip(spark, vcf, tmp_path):
    a = split_multiallelic(_scan(spark, vcf).variants(), keep=("chrom", "pos", "ref", "qual", "filters"))
    path = str(tmp_path / "tsv")
    flat = E.write_tsv(a.select("chrom", "pos", "ref", "alt", "af", "qual", "filters"), path)
    back = E.read_tsv(spark, path, "chrom string, pos long, ref string, alt string, af double, qual double, "
                                   "filters string")
    assert sorted(back.collect()) == sorted(flat.collect())
    first = open([os.path.join(path, f) for f in sorted(os.listdir(path)) if f.endswith(".csv")][0]).readline()
    assert first.rstrip("\n").split("\t") == ["chrom", "pos", "ref", "alt", "af", "qual", "filters"]


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_columnar_roundtrip(spark, vcf, tmp_path, fmt):
    v = _scan(spark, vcf).variants().select("chrom", "pos", "ref", "alts", "qual", "genotypes",
                                           (F.col("pos") % 2).cast("int").alias("shard_id"))
    path = E.write_columnar(v, str(tmp_path / fmt), fmt)
    back = spark.read.format(fmt).load(path)
    assert back.count() == 60
    assert back.where("pos = 100").first()["genotypes"][2]["gq"] == 9
    with pytest.raises(ValueError):
        E.write_columnar(v, str(tmp_path / "x"), "avro")


def test_table_load_prunes_partitions(spark, vcf, tmp_path):
    a = split_multiallelic(_scan(spark, vcf).variants(), keep=("chrom", "pos", "ref", "qual"))
    path = str(tmp_path / "table")
    TB.load_table(a, path, width=100)
    t = TB.read_table(spark, path)
    q = t.where(TB.range_filter(200, 300, chrom="chr1", width=100)).groupBy("chrom").count()
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "pos_bucket" in plan
    want = sum(2 if i % 4 == 0 else 1 for i in range(60) if 200 <= 100 + 7 * i <= 300)
    assert q.first()["count"] == want


def test_inventory_of_a_run(spark, vcf, tmp_path):
    base = str(tmp_path / "runs")
    assert I.list_files(spark, base).columns == ["relative_path", "uri", "length", "modified"] and I.list_files(spark, base).isEmpty()
    S.shard(spark, vcf(HEADER + "\n" + tsv(*ROWS)), base, records_per_shard=25, run_id="r1", compact=True)
    files = [r for r in I.list_files(spark, base).collect() if not r["relative_path"].rsplit("/", 1)[-1].startswith(("_", "."))]
    paths = [r["relative_path"] for r in files]
    assert paths == sorted(paths) and {p.split("/")[0] for p in paths} == {"commits", "headers", "manifests", "params", "shards", "zones"}
    assert [p.rsplit("/", 1)[0] for p in paths if p.startswith("shards/")] == [f"shards/run_id=r1/shard_id={k}" for k in range(3)]
    assert all(r["uri"].startswith("file:") and r["uri"].endswith(r["relative_path"]) and r["length"] > 0 for r in files)
    under = [r["relative_path"] for r in I.list_files(spark, base, "shards/run_id=r1/shard_id=2").collect()]
    assert under and all(p.startswith("shards/run_id=r1/shard_id=2/") for p in under)
    manifest = next(p for p in paths if p.startswith("manifests/"))
    assert I.exists(spark, base, manifest) and not I.exists(spark, base, manifest + ".gone")


@pytest.mark.parametrize("base,relative,joined", [
    ("/srv/runs", "shards/run_id=r1", "/srv/runs/shards/run_id=r1"), ("/srv/runs", "x/./y/../z", "/srv/runs/x/z"),
    ("hdfs://nn:9000/srv/runs", "x", "hdfs://nn:9000/srv/runs/x"), ("/srv/runs", "/srv/runs/x", "/srv/runs/x"),
    ("/srv/runs", "../runs-old/x", None),  # a text prefix of the base, but another folder
    ("/srv/runs", "x/../../other", None), ("/srv/runs", "/etc/passwd", None), ("hdfs://nn:9000/srv/runs", "../../x", None),
    ("/srv/runs", None, None)])
def test_paths_stay_in_their_base(base, relative, joined):
    if joined is None:
        with pytest.raises(ValueError):
            I.safe_join(base, relative)
    else:
        assert I.safe_join(base, relative) == joined


def test_sinks_by_name(spark, vcf, tmp_path):
    assert [I.resolve_sink(), I.resolve_sink("HADOOP"), I.resolve_sink(None)] == ["local", "hadoop", "local"]
    with pytest.raises(ValueError, match="Unsupported storage type: tape"):
        S.shard(spark, vcf(HEADER), str(tmp_path / "b"), sink="tape")
    assert not (tmp_path / "b").exists()


def test_quality_checks(spark, vcf):
    text = HEADER + "\n" + tsv(
        ("chr1", 1, ".", "A", "G", 5, "PASS", "AF=0.1;XX=1", "GT", "0/1", "0/0", "./."),   # unknown key
        ("chr1", 2, ".", "A", "G,T", 5, "PASS", "AF=0.1", "GT", "0/1", "0/0", "0/0"),      # wrong number
        ("chr1", 3, ".", "A", "G", 5, "PASS", "AF=abc;DP=x;DB", "GT", "0/1", "0/0", "0/0"),  # wrong types
        ("chr1", 4, ".", "A", ".", ".", ".", ".", "GT", ".", "0/0", "0/0"))
    s = open_vcf(spark, vcf(text))
    got = {(r["key"], r["issue"]): r["n_records"] for r in Q.info_violations(s.variants(), s.header).collect()}
    assert got == {("XX", "unknown_key"): 1, ("AF", "wrong_number"): 1, ("AF", "wrong_type"): 1,
                   ("DP", "wrong_type"): 1}
    c = Q.completeness(s.variants()).first()
    assert (c["n_records"], c["missing_qual"], c["missing_alt"], c["missing_filter"], c["missing_info"],
            c["missing_gt"]) == (4, 1, 1, 1, 1, 2)


def test_out_of_order_detected(spark):
    df = spark.createDataFrame([(0, 0, "chr1", 10, 0), (1, 0, "chr1", 5, 0), (2, 1, "chr2", 1, 0),
                                (3, 0, "chr1", 50, 1), (4, 0, "chr1", 60, 1)],
                               "ordinal long, contig_idx int, chrom string, pos long, shard_id int")
    rep = {r["chrom"]: r["n_unsorted"] for r in Q.coordinate_order_report(df).collect()}
    assert rep == {"chr1": 2, "chr2": 0}
    v = {r["shard_id"]: r for r in Q.shard_validation(df, 3, total=5).collect()}
    assert v[0]["n_unsorted"] == 1 and v[1]["starts_before_previous"] and v[1]["expected_records"] == 2


def test_snapshot_diff_and_annotate(spark):
    schema = "chrom string, pos long, ref string, alt string, qual double, af double, filters array<string>"
    before = spark.createDataFrame([("c", 1, "A", "G", 1.0, 0.1, ["PASS"]), ("c", 2, "A", "G", 1.0, 0.1, ["PASS"]),
                                    ("c", 3, "A", "G", 1.0, 0.1, ["PASS"]), ("c", 3, "A", "G", 2.0, 0.1, ["PASS"])],
                                   schema)
    after = spark.createDataFrame([("c", 1, "A", "G", 1.0, 0.1, ["PASS"]), ("c", 3, "A", "G", 2.0, 0.1, ["PASS"]),
                                   ("c", 3, "A", "G", 1.0, 0.1, ["PASS"]), ("c", 4, "A", "T", 1.0, 0.2, ["PASS"]),
                                   ("c", 2, "A", "G", 9.0, 0.1, ["PASS"])], schema)
    d = {r["pos"]: r["change"] for r in C.snapshot_diff(before, after).collect()}
    assert d == {1: "unchanged", 2: "changed", 3: "unchanged", 4: "added"}
    d2 = {r["pos"]: r["change"] for r in C.snapshot_diff(after, before).collect()}
    assert d2[4] == "removed"
    ann = {r["pos"]: r["n_known"] for r in C.annotate_by_allele(before, after).collect()}
    assert ann == {1: 1, 2: 1, 3: 2}


def test_streaming_picks_up_only_new_shards(spark, vcf, tmp_path):
    src = vcf(HEADER + "\n" + tsv(*ROWS))
    base, out, ck = str(tmp_path / "b"), str(tmp_path / "alleles"), str(tmp_path / "ck")
    S.shard(spark, src, base, records_per_shard=25, run_id="r1")
    q = start_incremental_load(spark, base, out, ck)
    q.awaitTermination()
    first = spark.read.parquet(out).count()
    assert first == 75  # 60 records, 15 of them with two ALTs
    S.shard(spark, src, base, records_per_shard=25, run_id="r2")
    q = start_incremental_load(spark, base, out, ck)
    q.awaitTermination()
    t = spark.read.parquet(out)
    assert t.count() == 150
    assert {r[0]: r[1] for r in t.groupBy("run_id").count().collect()} == {"r1": 75, "r2": 75}


def test_shard_hash_dedup(spark, vcf, tmp_path):
    src = vcf(HEADER + "\n" + tsv(*ROWS))
    base = str(tmp_path / "b")
    for rid, n in [("a", 20), ("b", 20), ("c", 30)]:
        S.shard(spark, src, base, records_per_shard=n, run_id=rid)
    h = C.dedup_shards(C.shard_hashes(S.read_shards(spark, base)))
    rows = {(r["run_id"], r["shard_id"]): r for r in h.collect()}
    assert rows[("a", 0)]["shard_hash"] == rows[("b", 0)]["shard_hash"]
    assert rows[("a", 0)]["keep"] and not rows[("b", 0)]["keep"] and rows[("b", 1)]["kept_run"] == "a"
    assert rows[("c", 0)]["keep"]
