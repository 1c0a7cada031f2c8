"""The mix against its laws, its permutations and its DuckDB twin."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

from genolake.llm import mixing as M
from genolake.llm.queries import QUERIES
from genolake.llm.sql import SQL
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, source string"


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for c in ("size", "source_no", "row", "block", "target", "_s"):
        df = df.withColumn(c, F.lit("x"))
    return df


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def water(sizes, weights=(5, 2, 1), most=3):
    """Targets by the rule as told: share, cut at the limit, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, full, left = dict.fromkeys(names, 0.0), set(), float(sum(sizes.values()))
    while True:
        open_w = sum(w[s] for s in names if s not in full)
        if not open_w:
            return target
        for s in names:
            if s not in full:
                target[s] = left * w[s] / open_w
        over = [s for s in names if s not in full and target[s] > most * sizes[s]]
        if not over:
            return target
        for s in over:
            full.add(s)
            target[s] = float(most * sizes[s])
            left -= target[s]


def odd_rows():
    rows = [(i, f"w{i} " * (i % 90), f"s{i % 5}") for i in range(1, 400)]
    rows += [(1000, "one doc " * 9, "tiny"), (1001, None, "tiny"), (1002, "", "none"), (1003, " \t\n\x0b\x0c\r", None),
             (1004, "é ü x y \n" * 50, None), (None, "no id " * 30, "s1"), (None, None, None), (1005, "big " * 20_000, "s2")]
    return rows + [(7, "copy of a row " * 11, "s3")] * 40


@pytest.mark.parametrize("block_words,shard_blocks", [(64, 1024), (8, 32), (1, 500)])
def test_laws(spark, block_words, shard_blocks):
    rows = odd_rows()
    m = M.mix(frame(spark, rows), block_words, shard_blocks)
    got = [r.asDict() for r in m.taken().collect()]
    assert sorted((r["doc_id"] or -1, r["size"]) for r in got) == sorted((i or -1, len(words(t))) for i, t, _ in rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(words(t))
    target = water(sizes)
    named = {r["source"]: r.asDict() for r in m.sources.collect()}
    for s, t in target.items():
        assert named[s]["target"] == pytest.approx(t) and named[s]["source_size"] == sizes[s]
    assert all(r["taken"] <= 3 * r["size"] for r in got)
    by_target = {}
    for r in got:
        by_target[(r["source_size"], round(r["target"], 6))] = by_target.get((r["source_size"], round(r["target"], 6)), 0) + r["taken"]
    for s, t in target.items():
        assert abs(by_target[(sizes[s], round(t, 6))] - t) <= block_words / 2 + 1e-6
    slots = m.slots.collect()
    assert sorted(r["slot"] for r in slots) == list(range(sum(n["quota"] for n in named.values())))
    assert all(r["shard"] == r["slot"] // shard_blocks for r in slots)
    for n in named.values():
        mine = sorted((r["nth"], r["block"]) for r in slots if r["source_no"] == n["source_no"])
        assert [x for x, _ in mine] == list(range(n["quota"]))
        for k in range(0, n["quota"], max(1, n["blocks"])):  # every round goes over its blocks once
            once = [b for _, b in mine[k:k + n["blocks"]]]
            assert len(set(once)) == len(once) and all(0 <= b < n["blocks"] for b in once)


def test_texts_are_the_blocks(spark):
    rows = [r for r in odd_rows() if r[0] is not None and r[0] != 7]
    m = M.mix(frame(spark, rows), 16, 64)
    stream = {}
    for i, t, s in sorted(rows, key=lambda r: r[0]):
        stream.setdefault(s, []).extend(words(t))
    names = {r["source_no"]: r["source"] for r in m.sources.collect()}
    want = {r["slot"]: stream[names[r["source_no"]]][16 * r["block"]:16 * r["block"] + 16] for r in m.slots.collect()}
    assert {r["slot"]: list(r["words"]) for r in m.texts().collect()} == want


def test_counts_are_drawn(spark):
    """Shard counts vary as a multinomial's do, not as shares dealt out evenly."""
    rows = [(i, "a b c d e f g h " * 8, "xyz"[i % 3]) for i in range(600)]
    m = M.mix(frame(spark, rows), 4, 100)
    n = m.sources.agg(F.sum("quota")).first()[0]
    q = {r["source_no"]: r["quota"] / n for r in m.sources.collect()}
    counts = m.slots.where(f"slot < {n - n % 100}").groupBy("shard", "source_no").count().collect()
    spread = sum((r["count"] - 100 * q[r["source_no"]]) ** 2 / (100 * q[r["source_no"]]) for r in counts)
    degrees = 2 * (n // 100)
    assert 0.7 * degrees < spread < 1.35 * degrees


def test_empty_and_no_words(spark):
    assert M.mix(frame(spark, [])).taken().count() == 0
    got = M.mix(frame(spark, [(1, None, "a"), (2, " ", None)])).taken().collect()
    assert sorted(tuple(r) for r in got) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_reruns_and_plan(spark):
    rows = odd_rows()
    one, two = M.mix(frame(spark, rows)), M.mix(frame(spark, rows[::-1]).repartition(7))
    assert sorted(map(repr, one.taken().collect())) == sorted(map(repr, two.taken().collect()))
    plan = one.taken()._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|ExistingRDD|Cartesian", plan)


def test_query_matches_duckdb(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF_SMALL}/documents.parquet'")
    cur = con.execute(SQL["op11_mixing"])
    names = [d[0] for d in cur.description]
    df = QUERIES["op11_mixing"](spark, SF_SMALL)
    assert sorted(df.columns) == sorted(names)
    assert sorted(tuple(r) for r in df.select(*names).collect()) == sorted(cur.fetchall())
