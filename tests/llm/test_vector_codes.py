"""Vector codes against a plain integer version; the tree against all distances."""

import hashlib
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from genolake.llm import vector_codes as V
from genolake.llm.queries import QUERIES
from genolake.llm.sql import SQL
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=16, entries=64, rounds=2):
    kept = [(i, [math.floor(256 * c) for c in v], lab) for i, v, lab in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    ids = {}
    for i, v, _ in kept:
        if i is not None:
            ids[i] = min(ids.get(i, v), v)
    if not ids:
        return [], None
    first = [ids[i] for i in sorted(ids)[:entries]]
    d = len(first[0])
    kept = [r for r in kept if len(r[1]) == d]
    w = d // parts
    books = [[v[p * w:(p + 1) * w] for v in first] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        groups = {}
        for _, v, _ in kept:
            for p in range(parts):
                x = v[p * w:(p + 1) * w]
                groups.setdefault((p, near(p, x)[1]), []).append(x)
        for (p, k), xs in groups.items():
            books[p][k] = [sum(c) // len(xs) for c in zip(*xs)]
    out, by_label = [], {}
    for i, v, lab in kept:
        found = [near(p, v[p * w:(p + 1) * w]) for p in range(parts)]
        err = sum(f[0] for f in found)
        by_label[lab] = by_label.get(lab, 0) + err
        out.append((i, lab, "".join(f"{f[1]:02x}" for f in found), err))
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((i, c, e, by_label[lab]) for i, lab, c, e in out), key=repr), digest


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("code", F.lit("x")).withColumn("_g", F.lit(1))
    got = V.vector_codes(df).collect()
    want, digest = brute([tuple(r) for r in spark.createDataFrame(rows, SCHEMA).collect()])
    assert sorted(((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got), key=repr) == want
    assert {r["codebooks_sha256"] for r in got} == ({digest} if want else set())


@pytest.mark.parametrize("width", [1, 3])
def test_codes(spark, width):
    rng = np.random.default_rng(width)
    rows = [(int(i), [float(c) for c in rng.normal(size=16 * width).astype(np.float32)], int(i) % 3 if i % 7 else None)
            for i in range(40, 340)]
    rows += [(5, None, 1), (6, [float("nan")] * (16 * width), 1), (7, [float("inf")] + [0.0] * (16 * width - 1), 1),
             (8, [None] + [0.0] * (16 * width - 1), 1), (None, [0.25] * (16 * width), None), (400, [0.5] * 16 * (width + 1), 2),
             (9, [], 4)]
    rows += rows[:30] + [(41, [-1.0] * (16 * width), 2)]  # repeated rows, two vectors of one id
    check(spark, [r for r in rows if r[0] != 9])


def test_few_and_none(spark):
    check(spark, [(3, [0.1] * 16, 1), (1, [-0.001] * 16, None), (2, [0.1] * 16, 1)])
    check(spark, [(1, None, 2)])
    check(spark, [])
    with pytest.raises(ValueError):
        V.vector_codes(spark.createDataFrame([(1, [0.5] * 17, 1)], SCHEMA))
    with pytest.raises(Exception, match="a vector component is beyond"):
        V.vector_codes(spark.createDataFrame([(1, [1e9] * 16, 1)], SCHEMA))


@pytest.mark.parametrize("spread", [2, 40, 10 ** 7])
def test_tree_against_all_distances(spread):
    rng = np.random.default_rng(spread)
    for width in (1, 2, 5):
        entries = rng.integers(-spread, spread, (200, width))
        entries[50:70] = entries[3]  # equal entries: the lower index
        x = np.concatenate([rng.integers(-spread, spread, (500, width)), entries])
        s = V.Search(entries)
        at, best = s.nearest(x)
        d2 = V.squared(x, entries)
        assert (at == d2.argmin(axis=1)).all() and (best == d2.min(axis=1)).all()
        if spread > 2:
            assert s.measured < d2.size  # whole subtrees were left out


def test_decode_and_salted_sums(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    books = V.train(df)
    coded = V.encode(df, books)
    back = {r["vec_id"]: r["embedding"] for r in V.decode(coded, books).collect()}
    for r in coded.join(df.select("vec_id", "embedding"), "vec_id").limit(50).collect():
        ints = [math.floor(256 * c) for c in r["embedding"]]
        assert sum((a - round(b * 256)) ** 2 for a, b in zip(ints, back[r["vec_id"]])) == r["error"]
    one = V.with_group_sum(coded, "label", "error", "s").collect()
    two = V.with_group_sum(coded, "label", "error", "s", broadcast_max=0).collect()
    assert sorted(one) == sorted(two)


def test_query_matches_duckdb(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF_SMALL}/embeddings.parquet'")
    cur = con.execute(SQL["op13_vector_codes"])
    names = [d[0] for d in cur.description]
    df = QUERIES["op13_vector_codes"](spark, SF_SMALL)
    assert sorted(df.columns) == sorted(names)
    assert sorted(tuple(r) for r in df.select(*names).collect()) == sorted(cur.fetchall())
