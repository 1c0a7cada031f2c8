"""Commit log, zone maps, bucketed, clustered and counted tables: small cases and plans."""

import hashlib
import os
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from genolake.functions import parse as P
from genolake.operators import compare as C, intervals as I, quality as Q, regions as R, split as SP
from genolake.operators.aggregate import python_float_text
from genolake.operators.alleles import split_multiallelic
from genolake.operators.ordinal import with_ordinal, with_sorted_ordinal
from genolake.plans import buckets as B, clustered as CL, commits as L, export as E, rollup as RU, shard as S, table as TB, zones as Z
from genolake.session import checkpoint_root
from genolake.sources.scan import open_vcf
from genolake.sources.vcf_text import file_header_lines
from genolake.streaming.incremental import read_loaded, start_incremental_load

from .conftest import HEADER, tsv

RECORD = (".", "A", "G", 10, "PASS", "AF=0.5", "GT:GQ", "0/1:5", "1/1:6", "0/0:7")


def records(n, chrom="chr1", step=10):
    return [(chrom, 100 + step * i, *RECORD) for i in range(n)]


def source(tmp_path, rows, name="in.vcf"):
    p = tmp_path / name
    p.write_text(HEADER + "\n" + tsv(*rows) + "\n")
    return str(p)


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture()
def no_broadcast(spark):
    """Only joins whose size the library has checked itself may broadcast."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k in keys:
        spark.conf.unset(k)


# -- commit log ------------------------------------------------------------

def test_commits_and_snapshots(spark, tmp_path):
    src, base, out = source(tmp_path, records(30) + records(20, "chr2")), str(tmp_path / "runs"), str(tmp_path / "alleles")
    assert S.read_shards(spark, base).count() == 0 and L.latest_version(spark, base) == 0
    S.shard(spark, src, base, 7, run_id="a")
    S.shard(spark, src, base, 7, region="chr10", run_id="b")  # no records: committed and empty
    assert L.run_state(spark, base, "b")["n_shards"] == 0 and L.run_state(spark, base, "c") is None
    start_incremental_load(spark, base, out).awaitTermination()
    assert read_loaded(spark, out).count() == 50
    S.shard(spark, src, base, 7, region="chr2", run_id="a", redo=True)
    S.shard(spark, src, base, 7, run_id="b", redo=True)
    assert {r["run_id"]: r["count"] for r in S.read_shards(spark, base).groupBy("run_id").count().collect()} == {"a": 20, "b": 50}
    old = S.read_shards(spark, base, version=2)
    assert old.groupBy("run_id").count().collect()[0]["count"] == 50 and old.count() == 50
    assert S.read_manifest(spark, base, "a").count() == 3 and S.read_manifest(spark, base, "a", version=2).count() == 8
    assert {(r["run_id"], r["region"]) for r in S.read_params(spark, base).collect()} == {("a", "chr2"), ("b", None)}
    start_incremental_load(spark, base, out).awaitTermination()
    assert {r["run_id"]: r["count"] for r in read_loaded(spark, out).groupBy("run_id").count().collect()} == {"a": 20, "b": 50}
    L.remove_run(spark, base, "b")
    S.shard(spark, src, base, 7, region="chr10", run_id="a", redo=True)  # to nothing
    start_incremental_load(spark, base, out).awaitTermination()
    assert read_loaded(spark, out).count() == 0 and S.read_shards(spark, base).count() == 0
    assert [f for f in os.listdir(out) if f.startswith("run_id=") and os.listdir(f"{out}/{f}")] == []
    with pytest.raises(ValueError, match="not committed"):
        L.remove_run(spark, base, "b")
    gone = L.vacuum(spark, base, ("shards", "manifests", "zones", "headers", "params"))
    assert "b" in gone and not os.path.exists(f"{base}/shards/run_id=b")
    S.shard(spark, src, base, 7, run_id="z")
    assert S.read_shards(spark, base).count() == 50


def test_versions_are_taken_once(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    assert [L.commit(spark, base, r, "add", r, 1, 1) for r in "ab"] == [1, 2]
    monkeypatch.setattr(L, "latest_version", lambda *_: 0)  # another writer came in between
    assert L.commit(spark, base, "c", "add", "c", 1, 1) == 3
    assert L.read_log(spark, base).count() == 3
    with pytest.raises(ValueError):
        L.commit(spark, base, "c", "drop")


def test_keep_replaced_versions(spark, tmp_path):
    src, base, out = source(tmp_path, records(9)), str(tmp_path / "runs"), str(tmp_path / "alleles")
    for size, redo in ((4, False), (5, True)):
        S.shard(spark, src, base, size, run_id="a", redo=redo)
        start_incremental_load(spark, base, out, keep_replaced=True).awaitTermination()
    assert [read_loaded(spark, out, v).select("shard_id").distinct().count() for v in (1, 2)] == [3, 2]
    many = read_loaded(spark, out, max_listed_runs=0)
    assert sorted(map(repr, many.collect())) == sorted(map(repr, read_loaded(spark, out).select(*many.columns).collect()))
    assert S.read_shards(spark, base, max_listed_runs=0).count() == 9


# -- zone maps -------------------------------------------------------------

def test_region_over_shards_opens_only_what_it_needs(spark, tmp_path):
    rows = records(40) + [("chr2", 50, ".", "A" * 900, "A", 5, "PASS", "AF=0.5", "GT", "0/1", "0/0", "0/0")] + records(30, "chr2", 100)
    rows.insert(3, ("chr1", 131, ".", "A", "<DEL>", 5, "PASS", "END=5000", "GT", "0/1", "0/0", "0/0"))
    src, base = source(tmp_path, rows), str(tmp_path / "runs")
    S.shard(spark, src, base, 5, run_id="a")
    S.shard(spark, src, base, 9, run_id="b")
    S.shard(spark, src, base, 8, run_id="b", redo=True)
    scan = open_vcf(spark, src)
    for region in ("chr1:200-260", "chr2:900-1000", "chr2", "chr10", "chr1:4000-4100", "chr1:1-1"):
        for info in (False, True):
            for run in ("a", "b"):
                got = Z.region_over_shards(spark, base, region, run, info, scan.header)
                want = scan.variants(region, use_info_end=info)
                key = lambda df: sorted(map(tuple, df.select("chrom", "pos", "ref").collect()))
                assert key(got) == key(want)
    hit = Z.region_over_shards(spark, base, "chr1:200-260", "a", header=scan.header)
    opened = {re.search(r"run_id=([^/]+)/shard_id=(\d+)", f).groups() for f in hit.inputFiles()}
    assert opened == {(r["run_id"], str(r["shard_id"])) for r in hit.select("run_id", "shard_id").distinct().collect()}
    assert 1 <= len(opened) <= 3
    joined = Z.region_over_shards(spark, base, "chr1:200-260", None, header=scan.header, max_listed_shards=0)
    assert joined.count() == 2 * hit.count()


# -- bucketed table ----------------------------------------------------------

@pytest.mark.parametrize("files", [1, 3])
def test_bucketed_join_has_no_exchange(spark, tmp_path, no_broadcast, files):
    rnd = random.Random(1)
    rows = [("chr1", rnd.randint(1, 300), "A", rnd.choice("CGT"), float(i)) for i in range(2000)] + [("chr1", 7, "A", "C", 1.0)] * 900
    df = spark.createDataFrame(rows, "chrom string, pos long, ref string, alt string, qual double")
    a = B.write_bucketed(df, str(tmp_path / "a"), 4, files_per_bucket=files)
    b = B.write_bucketed(df.where("qual > 500"), str(tmp_path / "b"), 4)
    B._OPEN.clear()  # as in a new session
    j = C.annotate_by_allele(B.open_bucketed(spark, a), B.open_bucketed(spark, b))
    text = plan(j).split("== Physical Plan ==")[1]
    assert "Exchange" not in text and "SortMergeJoin" in text
    want = C.annotate_by_allele(df, df.where("qual > 500"))
    cols = ["chrom", "pos", "ref", "alt", "qual", "n_known", "known_max_qual"]
    assert sorted(map(tuple, j.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


# -- per-allele values ---------------------------------------------------------

RICH_HEAD = HEADER.replace("##FORMAT=<ID=GT", '##INFO=<ID=AC,Number=A,Type=Integer,Description="c">\n'
                           '##INFO=<ID=RD,Number=R,Type=Integer,Description="r">\n##INFO=<ID=GL,Number=G,Type=Float,Description="g">\n'
                           '##INFO=<ID=TX,Number=.,Type=String,Description="t">\n##FORMAT=<ID=AD,Number=R,Type=Integer,Description="a">\n'
                           "##FORMAT=<ID=GT", 1)


def test_split_fields_by_number(spark, vcf):
    rows = [("chr1", 1, ".", "A", "C,G,T", 5, "PASS", "AC=1,2,3;RD=9,8,7,6;GL=0,1,2,3,4,5,6,7,8,9;TX=x,y;AF=.,0.2,0.3;DP=4;DB",
             "GT:PL:AD", "1/3:0,1,2,3,4,5,6,7,8,9:4,3,2,1", "2:10,11,12,13:1,2", "0|2"),
            ("chr1", 2, ".", "A", "C", 5, "PASS", "AC=1,2;RD=5,.;AF=0.1", "PL:GT", "1,2,3:./1", ".:.", "4,5:1/0/1"),
            ("chr1", 3, ".", "A", ".", 5, "PASS", "DP=4", "GT", "0/0", "0/0", "0/0")]
    scan = open_vcf(spark, vcf(RICH_HEAD + "\n" + tsv(*rows)))
    got = {(r["pos"], r["allele_idx"]): r.asDict() for r in SP.split_fields(scan.variants(), scan.header).collect()}
    assert sorted(got) == [(1, 1), (1, 2), (1, 3), (2, 1)]
    assert [got[(1, i)]["info_AC"] for i in (1, 2, 3)] == [1, 2, 3]
    assert [got[(1, i)]["info_RD"] for i in (1, 2, 3)] == [[9, 8], [9, 7], [9, 6]]
    assert [got[(1, i)]["info_GL"] for i in (1, 2, 3)] == [[0, 1, 2], [0, 3, 5], [0, 6, 9]]
    assert [got[(1, i)]["info_AF"] for i in (1, 2, 3)] == [None, 0.2, 0.3]
    assert got[(1, 2)]["info_TX"] == ["x", "y"] and got[(1, 2)]["info_DP"] == 4 and got[(1, 2)]["info_DB"]
    assert got[(2, 1)]["info_AC"] is None and got[(2, 1)]["info_RD"] == [5, None] and not got[(2, 1)]["info_DB"]
    s = {(r["pos"], r["allele_idx"], r["sample"]): r for r in SP.split_sample_fields(scan.variants(), scan.header).collect()}
    assert len(s) == 12
    assert [s[(1, i, "NA1")]["gt"] for i in (1, 2, 3)] == ["1/.", "./.", "./1"]
    assert [s[(1, i, "NA1")]["fmt_PL"] for i in (1, 2, 3)] == [[0, 1, 2], [0, 3, 5], [0, 6, 9]]
    assert [s[(1, i, "NA1")]["fmt_AD"] for i in (1, 2, 3)] == [[4, 3], [4, 2], [4, 1]]
    assert [s[(1, i, "NA2")]["gt"] for i in (1, 2, 3)] == [".", "1", "."]  # haploid
    assert [s[(1, i, "NA2")]["fmt_PL"] for i in (1, 2, 3)] == [[10, 11], [10, 12], [10, 13]]
    assert s[(1, 2, "NA2")]["fmt_AD"] is None  # two values for four alleles
    assert s[(1, 2, "NA3")]["gt"] == "0|1" and s[(1, 2, "NA3")]["fmt_PL"] is None
    assert (s[(2, 1, "NA1")]["gt"], s[(2, 1, "NA1")]["fmt_PL"]) == ("./1", [1, 2, 3])
    assert (s[(2, 1, "NA2")]["gt"], s[(2, 1, "NA2")]["fmt_PL"]) == (None, None)
    assert (s[(2, 1, "NA3")]["gt"], s[(2, 1, "NA3")]["fmt_PL"]) == ("1/0/1", [4, 5])


def test_split_fields_reads_texts_once_a_record(spark, vcf):
    """Below the explode: an allele's row holds no text to cut or cast."""
    scan = open_vcf(spark, vcf(RICH_HEAD + "\n" + tsv(("chr1", 1, *RECORD))))
    out = SP.split_fields(scan.variants(), scan.header)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Generate", 1)
    assert "split(" not in above and "split(" in below and "regexp_extract" not in plan and "RLIKE(info_text" not in plan


def test_genotype_index_against_enumeration(spark):
    for n in range(1, 7):
        order = [(j, k) for k in range(n + 1) for j in range(k + 1)]
        values = F.lit(list(range(len(order))))
        for i in range(1, n + 1):
            got = spark.range(1).select(SP.allele_values(values, "G", F.lit(i), F.lit(n)).alias("v")).first()["v"]
            assert got == [order.index((0, 0)), order.index((0, i)), order.index((i, i))]


def test_decompose_and_recompose(spark):
    rnd = random.Random(2)
    word = lambda n: "".join(rnd.choice("ACG") for _ in range(n))
    rows = [(i, 1, f"c:{i % 2}", 10 * i, r, a) for i in range(300) for n in [rnd.randint(1, 6)] for r, a in [(word(n), word(rnd.choice([n, n, 2])))]]
    rows += [(900, 1, "c", 5, "AC", "<DEL>"), (901, 2, "c", 5, "ACG", "ACG"), (902, 1, "c", 5, "AT", "CG"), (903, 1, "c", 5, "AT", "CG")]
    df = spark.createDataFrame(rows, "ordinal long, allele_idx int, chrom string, pos long, ref string, alt string")
    d = SP.decompose_substitutions(df)
    want = []
    for o, i, c, p, r, a in rows:
        if len(r) == len(a) > 1 and r != a and a != "<DEL>":
            want += [(o, c, p + k, x, y, f"{c}:{p}:{r}:{a}", k) for k, (x, y) in enumerate(zip(r, a)) if x != y]
        else:
            want.append((o, c, p, r, a, None, None))
    got = d.select("ordinal", "chrom", "pos", "ref", "alt", "event_id", "event_offset").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    back = SP.recompose_substitutions(d.repartition(5), ("ordinal", "allele_idx")).select(*df.columns).collect()
    assert sorted(map(tuple, back)) == sorted(rows)


# -- intervals -----------------------------------------------------------------

def test_merge_regions_against_scan(spark):
    rnd = random.Random(3)
    rows = [(f"c{rnd.randint(1, 3)}", s, s + rnd.choice([0, 5, 60, 2000])) for s in (rnd.randint(1, 40_000) for _ in range(900))]
    rows += [("c1", 7, 9)] * 50 + [("c9", 1, 1 << 40), ("c9", 5, 6), (None, 1, 2), ("c1", None, 3)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # islands across many partitions
    try:
        for touching in (False, True):
            want = {}
            for c in {r[0] for r in rows if r[0]}:
                out = []
                for s, e in sorted((s, e) for x, s, e in rows if x == c and s is not None):
                    if out and s <= out[-1][1] + touching:
                        out[-1] = [out[-1][0], max(out[-1][1], e), out[-1][2] + 1]
                    else:
                        out.append([s, e, 1])
                want |= {(c, *x) for x in map(tuple, out)} if isinstance(want, set) else {(c, *x): 0 for x in map(tuple, out)}
            got = I.merge_regions(spark.createDataFrame(rows, "chrom string, start long, end long").repartition(4), touching).collect()
            assert sorted(map(tuple, got)) == sorted(want)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_interval_tree_against_all_pairs():
    import numpy as np

    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 7, 64, 501):
        start = rng.integers(0, 1000, n)
        end = start + rng.choice([0, 3, 50, 5000], n)
        lo = rng.integers(-100, 1500, 200)
        hi = lo + rng.integers(0, 80, 200)
        q, i = I.IntervalTree(start, end).overlaps(lo, hi)
        got = sorted(zip(q.tolist(), i.tolist()))
        assert got == sorted((a, b) for a in range(200) for b in range(n) if start[b] <= hi[a] and end[b] >= lo[a])


def test_tree_join(spark, vcf):
    rnd = random.Random(5)
    rows = [(f"chr{rnd.choice([1, 2])}", rnd.randint(1, 200_000), "A" * rnd.choice([1, 1, 1, 40])) for _ in range(1500)]
    v = spark.createDataFrame([(i, *r, {}) for i, r in enumerate(rows)], "ordinal long, chrom string, pos long, ref string, info map<string,string>")
    v = v.unionByName(spark.createDataFrame([(5000, "chr1", 50, "A", {"END": "100000050"}), (5001, "chr2", 9, "A", {"END": "90000"}),
                                             (5002, None, 9, "A", {}), (5003, "chr1", None, "A", {}), (5004, "chr9", 7, "A", {"END": "3"})], v.schema))
    r = spark.createDataFrame([(i, f"chr{rnd.choice([1, 2, 3])}", s, s + rnd.choice([0, 100, 5000])) for i, s in
                               enumerate(rnd.randint(1, 220_000) for _ in range(300))] + [(900, "chr1", 99_999_000, 1 << 62), (901, "chr9", 7, 7)],
                              "region_id int, chrom string, start long, end long")
    for info in (False, True):
        end = F.coalesce(F.try_element_at("info", F.lit("END")).cast("long"), F.col("pos") + F.length("ref") - 1) if info \
            else F.col("pos") + F.length("ref") - 1
        x = v.withColumn("_e", F.greatest(end, F.col("pos")))
        want = x.join(r, (x["chrom"] == r["chrom"]) & (x["pos"] <= r["end"]) & (x["_e"] >= r["start"])).select("ordinal", "region_id")
        got = I.tree_pairs(v, r, use_info_end=info, partition_rows=100)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert I.tree_pairs(v.limit(0), r).count() == 0 and I.tree_pairs(v, r.limit(0)).count() == 0


def test_tree_gives_its_pairs_in_bounded_blocks():
    import numpy as np

    rng = np.random.default_rng(9)
    start = rng.integers(0, 500, 777)
    end = start + rng.choice([0, 0, 9, 700], 777)
    lo = rng.integers(-50, 600, 90)
    hi = lo + rng.choice([0, 5, 400, 1 << 40], 90)
    tree = I.IntervalTree(start, end)
    want = sorted((a, b) for a in range(90) for b in range(777) if start[b] <= hi[a] and end[b] >= lo[a])
    for at_once in (1, 3, 64, 1 << 20):
        blocks = list(tree.overlap_blocks(lo, hi, at_once))
        assert all(len(q) == len(p) < 2 * at_once for q, p in blocks)
        assert sorted((a, b) for q, p in blocks for a, b in zip(q.tolist(), tree.order[p].tolist())) == want


def test_tree_join_holds_neither_regions_nor_pairs(spark):
    # every region meets every record: far more pairs than one batch holds
    v = spark.range(1500).select(F.col("id").alias("ordinal"), F.lit("chr1").alias("chrom"), (F.col("id") % 7 + 100).alias("pos"), F.lit("A").alias("ref"))
    r = spark.range(600).select(F.when(F.col("id") > 0, F.col("id")).alias("region_id"), F.lit("chr1").alias("chrom"),
                                F.lit(1).cast("long").alias("start"), F.lit(5000).cast("long").alias("end"))
    got = I.tree_pairs(v, r, partition_rows=400)
    assert "MapInArrow" in plan(got) and "CoGroups" not in plan(got)
    n = got.groupBy("region_id").agg(F.count("*").alias("n"), F.count_distinct("key").alias("d")).collect()
    assert len(n) == 600 and {(x["n"], x["d"]) for x in n} == {(1500, 1500)} and None in {x["region_id"] for x in n}


# -- bounded reads ---------------------------------------------------------------

def tasks_of(spark, name, action):
    """Tasks that the jobs of an action ran."""
    sc = spark.sparkContext
    sc.setJobGroup(name, name)
    try:
        out = action()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    t = sc.statusTracker()
    stages = {s for j in t.getJobIdsForGroup(name) for s in t.getJobInfo(j).stageIds}
    return out, sum(i.numCompletedTasks for i in (t.getStageInfo(s) for s in stages) if i)


def test_head_of_one_file_reads_its_first_split(spark, tmp_path):
    src = source(tmp_path, records(30_000))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000b")
    try:
        head, n_open = tasks_of(spark, "open", lambda: file_header_lines(spark, src))
        scan = open_vcf(spark, src)
        assert scan.lines.rdd.getNumPartitions() > 40 and n_open == 1 and head == HEADER.split("\n")
        rows, n_head = tasks_of(spark, "head", lambda: scan._leading(10, None, False))
        assert n_head == 1 and len(rows) == 10
        assert [r["ordinal"] for r in scan.head(10).orderBy("ordinal").collect()] == list(range(10))
        far = scan.head(5, "chr1:299000-299100").select("ordinal", "pos").collect()
        assert sorted(map(tuple, far)) == [(i, 299_000 + 10 * i) for i in range(5)]
        assert [r["pos"] for r in scan.head(25_000).orderBy("ordinal").select("pos").collect()] == [100 + 10 * i for i in range(25_000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_headers_of_many_files_read_their_first_splits(spark, tmp_path):
    for i in range(6):
        source(tmp_path, records(3000, f"chr{1 + i % 2}"), f"{i}.vcf")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000b")
    try:
        scan = open_vcf(spark, str(tmp_path))
        assert scan.lines.rdd.getNumPartitions() > 30
        assert [len(x) for x in (scan.header.contigs, scan.header.samples)] == [3, 3]
        assert scan.variants().count() == 18_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


# -- plans -------------------------------------------------------------------------

def test_numbering_and_order_checks_do_not_shuffle_on_splits_or_contigs(spark, tmp_path, no_broadcast):
    scan = open_vcf(spark, source(tmp_path, records(500) + records(300, "chr2")))
    v = with_ordinal(scan.variants(with_split=True))
    text = plan(v).split("== Physical Plan ==")[1]
    assert re.search(r"BroadcastHashJoin \[_split_file#\d+, _split_start#\d+L\]", text)
    text = plan(Q.coordinate_order_report(v)).split("== Physical Plan ==")[1]
    assert re.search(r"BroadcastHashJoin \[chrom#\d+\]", text) and not re.search(r"SortMergeJoin \[chrom", text)
    assert sorted(r["n_records"] for r in Q.coordinate_order_report(v).collect()) == [300, 500]


def test_binned_join_looks_at_variants_only_for_open_regions(spark):
    v = spark.createDataFrame([("chr1", 10 * i, "A") for i in range(1, 500)], "chrom string, pos long, ref string")
    closed, opened = R.regions_frame(spark, ["chr1:100-200", "chr2:5-9"]), R.regions_frame(spark, ["chr1:4900-", "chr2:1-", "chr1:3-30"])
    _, n = tasks_of(spark, "closed", lambda: R.overlap_pairs(v, closed, small_max=0, bin_width=10))
    assert {r["region_id"]: r["n_variants"] for r in R.region_counts(v, closed, small_max=0, bin_width=10).collect()} == {0: 11, 1: 0}
    assert {r["region_id"]: r["n_variants"] for r in R.region_counts(v, opened, small_max=0, bin_width=10).collect()} == {0: 10, 1: 0, 2: 3}


def test_sorted_ordinal(spark):
    rnd = random.Random(6)
    rows = [(rnd.randint(0, 50), i) for i in range(3000)]
    got = with_sorted_ordinal(spark.createDataFrame(rows, "a long, b long").repartition(7), [F.col("a"), F.col("b")], "n").collect()
    assert [(r["a"], r["b"]) for r in sorted(got, key=lambda r: r["n"])] == sorted(rows)
    assert sorted(r["n"] for r in got) == list(range(3000))


# -- clustered and counted tables ------------------------------------------------------

def scan_rows(df):
    """Rows that the file scans of a collected plan gave out."""
    df = df.select("*")
    df.collect()
    total, nodes = 0, [df._jdf.queryExecution().executedPlan()]
    while nodes:
        p = nodes.pop()
        if p.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            nodes.append(p.executedPlan())
            continue
        if "FileSourceScan" in p.getClass().getSimpleName():
            total += p.metrics().apply("numOutputRows").value()
        children = p.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return total


def test_bloom_filters_skip_row_groups(spark, tmp_path):
    rnd = random.Random(7)
    rows = [("chr1", i, "A", "".join(rnd.choice("ACGT") for _ in range(8))) for i in range(20_000)] + [("chr1", 77, "A", "ACGTACGTT")]
    df = spark.createDataFrame(rows, "chrom string, pos long, ref string, alt string").repartition(1)
    plain, bloom = str(tmp_path / "plain"), str(tmp_path / "bloom")
    no_dictionary = {"parquet.enable.dictionary": "false"}
    CL.load_clustered(df, plain, 1_000_000, bloom=(), row_group_bytes=40_000, partitions=1, options=no_dictionary)
    CL.load_clustered(df, bloom, 1_000_000, bloom=("alt",), distinct=4000, row_group_bytes=40_000, partitions=1, options=no_dictionary)
    found = [CL.find_allele(spark, p, "A", "ACGTACGTT") for p in (plain, bloom)]
    assert [f.count() for f in found] == [1, 1]
    read = [scan_rows(f) for f in found]
    assert read[1] < read[0] / 3 and read[0] > 10_000
    assert CL.find_allele(spark, bloom, "A", "ACGTACGTT", "chr1", 70, 80).count() == 1
    assert CL.find_allele(spark, bloom, "A", "ACGTACGTT", start=80, end=90).count() == 0


def test_z_value_interleaves(spark):
    for a, b in ((0, 0), (1, 0), (0, 1), (0xFFFF, 0), (0x1234, 0xBEEF)):
        want = sum(((a >> i & 1) << (2 * i + 1)) | ((b >> i & 1) << (2 * i)) for i in range(16))
        assert spark.range(1).select(CL.z_value(F.lit(a), F.lit(b)).alias("z")).first()["z"] == want


@pytest.mark.parametrize("bounds", [(0, 99), (5, 5), (10, 19), (3, 47), (0, 9), (9, 10), (95, 300), (40, 20)])
def test_rollup(spark, tmp_path, bounds):
    path = str(tmp_path / "t")
    rows = [(f"c{i % 2}", i, "A") for i in range(100) for _ in range(1 + i % 3)]
    df = spark.createDataFrame(rows, "chrom string, pos long, ref string")
    RU.load_with_rollup(df.where("pos < 50"), path, 10)
    RU.load_with_rollup(df.where("pos >= 50"), path, 10, mode="append")
    got = {r["chrom"]: r["variants"] for r in RU.count_in_range(spark, path, *bounds).collect()}
    want = {}
    for c, p, _ in rows:
        if bounds[0] <= p <= bounds[1]:
            want[c] = want.get(c, 0) + 1
    assert got == want
    edges = RU.edge_rows(spark, path, *bounds, 10)
    read = edges.select("pos_bucket").distinct().collect()
    assert len(read) <= 2 and (not read or re.search(r"PartitionFilters: \[[^\]]*pos_bucket", plan(edges)))


# -- hash trees ---------------------------------------------------------------------------

def test_merkle_hashes(spark, tmp_path):
    src, base = source(tmp_path, records(1300)), str(tmp_path / "runs")
    for run, size in (("a", 400), ("b", 400), ("c", 300)):
        S.shard(spark, src, base, size, run_id=run)
    recs = S.read_shards(spark, base)
    for block, fanout in ((256, 256), (7, 3), (1, 2)):
        h = C.merkle_hashes(C.block_hashes(recs.repartition(5), block=block), fanout)
        old = {(r["run_id"], r["shard_id"]): (r["n_records"], r["keep"], r["kept_run"]) for r in C.dedup_shards(C.shard_hashes(recs)).collect()}
        got = {(r["run_id"], r["shard_id"]): (r["n_records"], r["keep"], r["kept_run"]) for r in C.dedup_shards(h).collect()}
        assert got == old
    a = C.block_hashes(recs.where("run_id = 'a'"), block=50)
    swapped = recs.where("run_id = 'a'").withColumn("ordinal", F.when(F.col("ordinal") == 3, 4).when(F.col("ordinal") == 4, 3)
                                                    .otherwise(F.col("ordinal")).cast("long"))
    b = C.block_hashes(swapped.where("ordinal <> 1299").unionByName(swapped.where("ordinal = 830")), block=50)
    assert sorted(map(tuple, C.differing_blocks(a, b).collect())) == [(0, 0, "changed"), (2, 0, "changed"), (3, 1, "changed")]
    assert "collect_list" not in plan(C.merkle_hashes(a))


def test_shard_hashes_of_whole_and_scattered_shards(spark):
    """Shards inside a task, dealt over tasks, larger than a task holds, with repeated and null ordinals, lines and ids."""
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    rows = [(r, i // 40, i, f"line {i}") for r in "ab" for i in range(130)]
    rows += [("c", 0, 7, "x"), ("c", 0, 7, "w"), ("c", 0, None, "v"), ("c", 0, 3, None), ("c", 1, 1, None), (None, None, 2, "y"), (None, None, 1, "z")]
    want = {}
    for run, shard in {x[:2] for x in rows}:
        own = sorted(((o is not None, o or 0, t is not None, sha(t) if t is not None else "") for r, s, o, t in rows if (r, s) == (run, shard)))
        want[run, shard] = (len(own), sha(",".join(x[3] for x in own if x[2])))
    recs = spark.createDataFrame(rows, "run_id string, shard_id int, ordinal long, line string")
    for held in (C.HELD_RECORDS, 50, 20):
        for dealt in (recs.coalesce(1), recs.repartition(1), recs.repartition(5), recs.repartition(4, "run_id", "shard_id")):
            got = {(x["run_id"], x["shard_id"]): (x["n_records"], x["shard_hash"]) for x in C.shard_hashes(dealt, held=held).collect()}
            assert got == want


def test_shard_hashes_shuffle_a_row_for_a_whole_shard():
    n = 10_000
    lines = [hashlib.sha256(b"%d" % i).digest() for i in range(n)]

    def batch(at, to):
        return pa.RecordBatch.from_pydict({"run_id": ["a"] * (to - at), "shard_id": [i // 4000 for i in range(at, to)], "ordinal": list(range(at, to)),
                                           "_h": lines[at:to], "_total": [min(n, (i // 4000 + 1) * 4000) - i // 4000 * 4000 for i in range(at, to)]})

    out = pa.Table.from_batches(C._held_hashes(batch(i, min(n - 5, i + 900)) for i in range(0, n - 5, 900))).to_pylist()
    whole, rest = [x for x in out if x["shard_hash"]], [x for x in out if not x["shard_hash"]]
    assert [(x["shard_id"], x["n_records"]) for x in whole] == [(0, 4000), (1, 4000)] and len(rest) == 1995
    assert whole[1]["shard_hash"] == hashlib.sha256(",".join(h.hex() for h in lines[4000:8000]).encode()).hexdigest()


def test_block_hashes_shuffle_no_lines(spark, no_broadcast):
    rows = [("a", i // 40, i, f"line {i}") for i in range(200)] + [("a", None, 7, "no shard")]
    recs = spark.createDataFrame(rows, "run_id string, shard_id int, ordinal long, line string")
    blocks = C.block_hashes(recs, block=16)
    assert "BroadcastHashJoin" in plan(blocks) and "SortMergeJoin" not in plan(blocks)
    got = {(r["shard_id"], r["block"]): r["n_records"] for r in blocks.collect()}
    assert got == {(s, b): n for s in range(5) for b, n in enumerate((16, 16, 8))}


def test_shard_job_leaves_no_numbered_copy(spark, tmp_path):
    scratch = checkpoint_root(spark).removeprefix("file:") + "/genolake"
    folders = lambda: {f for f in os.listdir(scratch) if f.startswith("ordinals-")} if os.path.isdir(scratch) else set()
    src, base, before = source(tmp_path, records(90)), str(tmp_path / "runs"), folders()
    S.shard(spark, src, base, 40, run_id="a")
    assert folders() == before
    rows = S.read_shards(spark, base, "a").select("shard_id", "ordinal").collect()
    assert sorted(map(tuple, rows)) == [(i // 40, i) for i in range(90)]


# -- texts and numbers -------------------------------------------------------------------

def test_number_grammar(spark):
    good = {"1": 1.0, "-1.5": -1.5, "+2": 2.0, ".5": 0.5, "3.": 3.0, "1e-3": 0.001, "2E5": 2e5, "inf": float("inf"), "NaN": None, "-Infinity": float("-inf")}
    bad = ["1d", "12F", "0.1f", "1D", " 1", "1 ", "0x1p3", "1e", "e5", "", "--1", "1_0", "1,0", "infx"]
    rows = spark.createDataFrame([(x,) for x in [*good, *bad]], "t string")
    got = {r["t"]: r["v"] for r in rows.select("t", P.number(F.col("t"), "double").alias("v")).collect()}
    assert all(got[x] is None for x in bad) and got["NaN"] != got["NaN"]
    assert all(got[k] == v for k, v in good.items() if v is not None)
    ints = rows.select("t", P.number(F.col("t"), "int").alias("v")).where("v IS NOT NULL").collect()
    assert {r["t"] for r in ints} == {"1", "+2"}
    lists = spark.createDataFrame([("0.1,0.1f,2d,.,3",), ("0.1,.",), (None,), ("1d",)], "t string")
    got = [tuple(r) for r in lists.select(P.typed_list(F.col("t"), "double"), P.bad_list_items(F.col("t"), "double")).collect()]
    assert got == [([0.1, None, None, None, 3.0], True), ([0.1, None], False), (None, False), ([None], True)]


def test_python_float_text(spark):
    rnd = random.Random(8)
    values = [0.0, -0.0, 1.0, 0.001, 0.0005, 0.0001, 0.00012345, 9.999e-05, 1e-05, 2.5e-07, 1e-300, 1e7, 12345678.0, 12345678.1234567, 1e15,
              123456789012345680.0, 1e16, 1e17, 1.5e22, 1e100, -4e-05, -123456789.5, 99.5, 100000.0, float("inf"), float("-inf")]
    values += [rnd.choice([-1, 1]) * rnd.randint(1, 10 ** 6) * 10.0 ** rnd.randint(-12, 14) for _ in range(300)]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", python_float_text(F.col("v")).alias("t"),
                                                                         F.col("v").cast("string").alias("s")).collect()
    for r in got:
        shortest = float(r["s"].replace("Infinity", "inf")) == r["v"] and len(re.sub(r"\D", "", r["s"].split("E")[0]).strip("0")) <= 17
        assert float(r["t"]) == r["v"] and shortest
        if len(repr(abs(r["v"]))) <= 16 or r["v"] in values[:26]:
            assert r["t"] == str(r["v"])
    assert spark.range(1).select(python_float_text(F.lit(None).cast("double")).alias("t")).first()["t"] == "None"


def test_tsv_tells_null_point_and_empty_apart(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate([None, ".", "", "\\.", "\\\\.", "..", "a.b", '"', '""', "x\ty", " ", "\\"])]
    df = spark.createDataFrame(rows, "i int, t string")
    E.write_tsv(df, str(tmp_path / "t"))
    assert sorted(map(tuple, E.read_tsv(spark, str(tmp_path / "t"), "i int, t string").collect())) == rows


def test_split_rows_agree_with_the_allele_table(spark, vcf):
    scan = open_vcf(spark, vcf(RICH_HEAD + "\n" + tsv(("chr1", 1, ".", "A", "C,G", 5, "PASS", "AF=0.1,0.2", "GT", "0/1", "1/2", "0/0"))))
    a = split_multiallelic(scan.variants(), keep=("chrom", "pos", "ref")).select("chrom", "pos", "ref", "alt", "allele_idx", "af")
    b = SP.split_fields(scan.variants(), scan.header, ["AF"])
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert TB.with_bucket(a, 10).columns[-1] == "pos_bucket"


def test_completeness_counts_records_without_samples(spark, vcf):
    head = HEADER.replace("\tFORMAT\tNA1\tNA2\tNA3", "")
    scan = open_vcf(spark, vcf(head + "\n" + tsv(("chr1", 1, ".", "A", "C", ".", "PASS", "."), ("chr1", 2, "x", "A", ".", 5, ".", "DP=1"))))
    got = Q.completeness(scan.variants()).first().asDict()
    assert got == {"n_records": 2, "missing_id": 1, "missing_qual": 1, "missing_alt": 1, "missing_filter": 1, "missing_info": 1,
                   "missing_gt": 0, "missing_gq": 0, "n_genotypes": 0}
    full = open_vcf(spark, vcf(HEADER + "\n" + tsv(("chr1", 1, ".", "A", "C", ".", "PASS", ".", "GQ:GT", "5:0/1", "x", "7:./1")), "b.vcf"))
    got = Q.completeness(full.variants()).first().asDict()
    assert [got[k] for k in ("n_records", "missing_gt", "missing_gq", "n_genotypes")] == [1, 2, 1, 3]


def test_read_failures_name_the_source(spark, vcf, monkeypatch, tmp_path):
    scan = open_vcf(spark, vcf(HEADER + "\n" + tsv(*records(3))))
    scan.source = "hdfs://nn/cohort.vcf"

    def fails(*_, **__):
        raise Exception("connection lost")

    monkeypatch.setattr(type(scan), "_leading", fails)
    with pytest.raises(IOError, match="hdfs://nn/cohort.vcf.*connection lost"):
        scan.head(2)
    monkeypatch.setattr(S, "shard_records", fails)
    with pytest.raises(IOError, match="hdfs://nn/other.vcf.*connection lost"):
        S.shard(spark, "hdfs://nn/other.vcf", str(tmp_path / "b"), scan=scan)
