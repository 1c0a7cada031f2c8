import os

import pytest

from genolake.operators.ordinal import limit_records, with_ordinal
from genolake.operators.quality import shard_validation
from genolake.plans import shard as S
from genolake.plans.summary import summarize
from genolake.sources.scan import open_vcf

from .conftest import HEADER, tsv

N = 2500


def _rows(n=N):
    # coordinate order: chr1 then chr2 then chr10, positions increasing
    rows = []
    for i in range(n):
        c = "chr1" if i < n // 2 else ("chr2" if i < 3 * n // 4 else "chr10")
        rows.append((c, 10 + 3 * i, ".", "A", "G" if i % 5 else ".", 30 + i % 7 if i % 9 else ".", "PASS",
                     "AF=0.5", "GT:GQ", "0/1:5", "1/1:6", "0/0:7"))
    return rows


def _write_split(tmp_path, n_files):
    """The same VCF as 1 file or cut into several files (header in the first)."""
    rows = _rows()
    d = tmp_path / f"split{n_files}"
    d.mkdir()
    step = (len(rows) + n_files - 1) // n_files
    for k in range(n_files):
        part = rows[k * step:(k + 1) * step]
        text = (HEADER + "\n" if k == 0 else "") + tsv(*part) + "\n"
        (d / f"part-{k:05d}.vcf").write_text(text)
    return str(d)


@pytest.mark.parametrize("n_files,max_bytes", [(1, None), (3, None), (8, 4096)])
def test_ordinals_dense_and_in_file_order(spark, tmp_path, n_files, max_bytes):
    if max_bytes:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(max_bytes))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        s = open_vcf(spark, _write_split(tmp_path, n_files))
        v = with_ordinal(s.variants(with_split=True).select("pos", "_split_file", "_split_start"))
        got = sorted((r["ordinal"], r["pos"]) for r in v.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [o for o, _ in got] == list(range(N))
    assert [p for _, p in got] == [r[1] for r in _rows()]


@pytest.mark.parametrize("key,before,after", [
    ("spark.sql.files.maxPartitionBytes", "400b", "64m"), ("spark.sql.files.maxPartitionBytes", "64m", "400b"),
    ("spark.sql.files.minPartitionNum", "4", "16")])
def test_ordinals_survive_other_splits(spark, tmp_path, key, before, after):
    """The input is cut differently between the call and the action: every record keeps its place."""
    s = open_vcf(spark, _write_split(tmp_path, 3))
    try:
        spark.conf.set(key, before)
        v = with_ordinal(s.variants(with_split=True).select("pos", "_split_file", "_split_start"))
        spark.conf.set(key, after)
        got = sorted((r["ordinal"], r["pos"]) for r in v.collect())
    finally:
        spark.conf.unset(key)
    assert got == [(i, r[1]) for i, r in enumerate(_rows())]


def test_ordinals_after_region_filter(spark, tmp_path):
    s = open_vcf(spark, _write_split(tmp_path, 3))
    v = with_ordinal(s.variants("chr2", with_split=True).select("pos", "_split_file", "_split_start"))
    got = sorted((r["ordinal"], r["pos"]) for r in v.collect())
    want = [r[1] for r in _rows() if r[0] == "chr2"]
    assert [p for _, p in got] == want and [o for o, _ in got] == list(range(len(want)))


def test_limit_zero_or_none_means_all(spark):
    df = spark.range(5).withColumnRenamed("id", "ordinal")
    assert limit_records(df, 0).count() == 5 and limit_records(df, None).count() == 5
    assert limit_records(df, 2).count() == 2


@pytest.mark.parametrize("compact", [False, True])
def test_shard_job(spark, tmp_path, compact):
    src = _write_split(tmp_path, 3)
    base = str(tmp_path / "out")
    m = S.shard(spark, src, base, records_per_shard=1000, run_id="r1", compact=compact)
    rows = sorted(m.collect(), key=lambda r: r["shard_id"])
    assert [r["n_records"] for r in rows] == [1000, 1000, 500]
    assert [r["shard_name"] for r in rows] == ["shard_0000", "shard_0001", "shard_0002"]
    assert rows[1]["first_ordinal"] == 1000 and rows[1]["last_ordinal"] == 1999
    assert rows[0]["first_pos"] == 10
    recs = S.read_shards(spark, base, "r1")
    assert recs.count() == N
    assert S.read_shards(spark, base, "r1", 2).count() == 500
    v = shard_validation(recs, 1000).collect()
    assert all(r["ordinals_dense"] and r["n_unsorted"] == 0 and not r["starts_before_previous"]
               and r["n_records"] == r["expected_records"] for r in v)
    if compact:
        for k in range(3):
            files = [f for f in os.listdir(f"{base}/shards/run_id=r1/shard_id={k}") if f.endswith(".parquet")]
            assert len(files) == 1
    # shard as VCF text: full header then its records in order
    text = [r[0] for r in S.shard_as_vcf_text(spark, base, "r1", 1).collect()]
    assert text[0] == "##fileformat=VCFv4.2" and text[len(HEADER.split("\n"))].startswith("chr1\t")
    assert len(text) == len(HEADER.split("\n")) + 1000
    # the same run id again fails instead of overwriting
    with pytest.raises(Exception):
        S.shard(spark, src, base, records_per_shard=1000, run_id="r1")


def test_shard_region_and_empty(spark, tmp_path):
    src = _write_split(tmp_path, 1)
    base = str(tmp_path / "out")
    m = S.shard(spark, src, base, records_per_shard=400, region="chr10", run_id="r2")
    assert sum(r["n_records"] for r in m.collect()) == N // 4
    m = S.shard(spark, src, base, records_per_shard=400, region="chr9", run_id="r3")
    assert m.count() == 0


def test_redo_rewrites_one_run(spark, tmp_path):
    src = _write_split(tmp_path, 1)
    base = str(tmp_path / "out")
    S.shard(spark, src, base, records_per_shard=1000, run_id="a")
    S.shard(spark, src, base, records_per_shard=1000, run_id="b")
    m = S.shard(spark, src, base, records_per_shard=600, run_id="a", redo=True)
    assert m.count() == 5
    counts = {r[0]: r[1] for r in S.read_shards(spark, base).groupBy("run_id").count().collect()}
    assert counts == {"a": N, "b": N}
    assert S.read_manifest(spark, base).where("run_id = 'b'").count() == 3


def test_records_per_shard_must_be_positive(spark, tmp_path):
    with pytest.raises(ValueError):
        S.shard(spark, _write_split(tmp_path, 1), str(tmp_path / "o"), records_per_shard=0, run_id="x")


def test_uncommitted_run_is_hidden(spark, tmp_path):
    src = _write_split(tmp_path, 1)
    base = str(tmp_path / "out")
    S.shard(spark, src, base, records_per_shard=1000, run_id="ok")
    # a run that wrote shards but died before its manifest
    spark.read.parquet(f"{base}/shards/run_id=ok").write.partitionBy("shard_id").parquet(f"{base}/shards/run_id=dead")
    runs = {r[0] for r in S.read_shards(spark, base).select("run_id").distinct().collect()}
    assert runs == {"ok"}


def test_summarize(spark, tmp_path, capsys):
    src = _write_split(tmp_path, 3)
    out = summarize(spark, src)
    assert out["total_variants"] == N
    assert out["chromosomes"] == {"chr1": N // 2, "chr10": N // 4, "chr2": N // 4}
    assert list(out["chromosomes"]) == ["chr1", "chr10", "chr2"]  # string order, as printed
    assert out["total_bytes"] == sum(len("\t".join(map(str, r))) + 1 for r in _rows())
    assert out["preview"][0] == "Variant 1: chr1:10 A>. (QUAL=None)"
    assert out["preview"][1] == "Variant 2: chr1:13 A>G (QUAL=31.0)"
    assert len(out["preview"]) == 10
    lim = summarize(spark, src, limit=1500)
    assert lim["total_variants"] == 1500 and lim["chromosomes"] == {"chr1": 1250, "chr2": 250}
    reg = summarize(spark, src, region="chr10", limit=0)
    assert reg["total_variants"] == N // 4
    empty = summarize(spark, src, region="chrX")
    assert empty["total_variants"] == 0 and empty["average_bytes"] is None and empty["preview"] == []


@pytest.mark.parametrize("limit", [1, 834, 835, 1667, 2100, 5000])
def test_summarize_limit_matches_python(spark, tmp_path, limit):
    src = _write_split(tmp_path, 3)  # files of 834, 834, 832 records
    out = summarize(spark, src, limit=limit, preview=3)
    head = _rows()[:limit]
    want = {}
    for r in head:
        want[r[0]] = want.get(r[0], 0) + 1
    assert out["chromosomes"] == dict(sorted(want.items()))
    assert out["total_bytes"] == sum(len("\t".join(map(str, r))) + 1 for r in head)
    assert len(out["preview"]) == min(3, limit)
    reg = summarize(spark, src, region="chr10", limit=limit, preview=2)
    chr10 = [r for r in _rows() if r[0] == "chr10"][:limit]
    assert reg["total_variants"] == len(chr10)
    assert reg["preview"][0].startswith(f"Variant 1: chr10:{chr10[0][1]} ")


def test_shards_concatenated_equal_the_input(spark, tmp_path):
    src = _write_split(tmp_path, 3)
    base = str(tmp_path / "out")
    S.shard(spark, src, base, records_per_shard=700, run_id="cat")
    got = [r["line"] for r in S.read_shards(spark, base, "cat").orderBy("shard_id", "ordinal").collect()]
    assert got == ["\t".join(map(str, r)) for r in _rows()]


@pytest.mark.parametrize("n", [0, 1, 10, 834, 835, 2000, 9999])
def test_head_reads_a_prefix_in_file_order(spark, tmp_path, n):
    src = _write_split(tmp_path, 5)
    s = open_vcf(spark, src)
    got = sorted((r["ordinal"], r["pos"]) for r in s.head(n).select("ordinal", "pos").collect())
    want = [r[1] for r in _rows()][:n or None]  # 0: no limit, as everywhere
    assert [p for _, p in got] == want and [o for o, _ in got] == list(range(len(want)))
    reg = sorted((r["ordinal"], r["pos"]) for r in s.head(n, "chr2").select("ordinal", "pos").collect())
    assert [p for _, p in reg] == [r[1] for r in _rows() if r[0] == "chr2"][:n or None]
