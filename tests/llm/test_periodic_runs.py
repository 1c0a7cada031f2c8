"""Periodic runs against a scan of every period."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from genolake.llm import periodic_runs as P
from genolake.llm.queries import QUERIES
from tests.conftest import SF_SMALL


def brute_runs(w):
    """Every maximal stretch of every period, the smallest period of each."""
    n, out = len(w), {}
    for p in range(1, n // 2 + 1):
        x = 0
        while x + p < n:
            y = x
            while y + p < n and w[y] == w[y + p]:
                y += 1
            if y > x and y + p - x >= max(12, 2 * p):
                out.setdefault((x, y + p), p)
            x = y + 1
    return sorted((s, e - s, p) for (s, e), p in out.items())


def brute_row(doc_id, text, plant=True):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if plant and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, ln, p in runs for i in range(s + p, s + ln)}
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    best = min(((-ln, s, p) for s, ln, p in runs), default=None)
    top = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *top, sha("".join(f"{s},{ln},{p}\n" for s, ln, p in runs)), sha(kept))


def group(texts):
    words = np.array([x for t in texts for x in [*t, -1]], np.int32)
    return words, np.array([len(t) for t in texts], np.int64)


def runs_by_text(texts, min_length=12):
    words, size = group(texts)
    start, stop, period = P.find_runs(words, size, min_length)
    begin = np.cumsum(size + 1) - size - 1
    out = [[] for _ in texts]
    for s, e, p in zip(start.tolist(), stop.tolist(), period.tolist()):
        d = int(np.searchsorted(begin, s, "right")) - 1
        out[d].append((s - int(begin[d]), e - s, p))
    return out


texts_of_few_words = st.lists(st.lists(st.integers(0, 2), max_size=90), min_size=1, max_size=6)


@settings(max_examples=150, deadline=None)
@given(texts_of_few_words)
def test_runs_of_few_words(texts):
    assert runs_by_text(texts) == [brute_runs(t) for t in texts]


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10 ** 9))
def test_long_repeats(seed):
    """Stretches longer than the cover's modulus, nested and shifted, so that the sorted suffixes decide."""
    r = random.Random(seed)
    texts = []
    for _ in range(3):
        unit = [r.randrange(r.choice([2, 5, 400])) for _ in range(r.randint(1, 130))]
        w = [r.randrange(400) for _ in range(r.randint(0, 20))] + unit * r.randint(1, 4) + unit[:r.randint(0, len(unit))]
        if r.random() < 0.6 and w:
            w[r.randrange(len(w))] = 999
        texts.append(w + w[:r.randint(0, len(w))])
    assert runs_by_text(texts) == [brute_runs(t) for t in texts]


def test_extensions_against_scan(monkeypatch):
    r = random.Random(5)
    texts = [[r.randrange(2) for _ in range(40)] * 6, [7] * 300, [r.randrange(3) for _ in range(500)], list(range(50))]
    words, size = group(texts)
    begin = np.cumsum(size + 1) - size - 1
    ext = P.Extensions(words, np.repeat(begin + size, size + 1), np.repeat(np.arange(len(size)), size + 1))
    x, y, want = [], [], []
    for d, t in enumerate(texts):
        for _ in range(3000):
            a, b = sorted(r.sample(range(len(t)), 2))
            n = 0
            while b + n < len(t) and t[a + n] == t[b + n]:
                n += 1
            x.append(begin[d] + a), y.append(begin[d] + b), want.append(n)
    assert ext.common(np.array(x), np.array(y)).tolist() == want
    monkeypatch.setattr(P, "CHUNK_PAIRS", 50)  # many pieces: the sorted suffixes grow with the documents that need them
    assert runs_by_text(texts) == [brute_runs(t) for t in texts]


def test_cover():
    assert all(P.IN_COVER[(a + P.SHIFT[a, b]) % P.MODULUS] and P.IN_COVER[(b + P.SHIFT[a, b]) % P.MODULUS]
               for a in range(P.MODULUS) for b in range(P.MODULUS))


def test_odd_rows(spark):
    r = random.Random(3)
    rows = [(1, None), (2, ""), (3, " \t\n\x0b"), (4, "a"), (5, "a " * 11), (6, "a " * 12), (7, "a b a b " * 20),
            (None, "x y " * 30), (None, None), (8, "p q r s t\n" * 9), (8, "p q r s t\n" * 9), (8, "other text"),
            (9, " ".join(str(r.randrange(4)) for _ in range(700))), (10, "one two " * 3000)]
    rows += [(100 + i, " ".join(f"w{r.randrange(60)}" for _ in range(r.randint(0, 300)))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for c in ("runs", "n_words", "_top", "start"):
        df = df.withColumn(c, F.lit("x"))
    got = sorted((tuple(x) for x in P.run_digests(df).collect()), key=repr)
    assert got == sorted((brute_row(*x) for x in rows), key=repr)
    assert P.run_digests(df.limit(0)).count() == 0
    plain = {x["doc_id"]: x for x in P.periodic_runs(df.where("doc_id = 8")).collect()}
    assert [tuple(x) for x in plain[8]["runs"]] in ([], [(0, 45, 5)])


def test_long_text(spark):
    text = ("lorem ipsum dolor " * 40_000) + " ".join(str(i) for i in range(50_000)) + " end" * 20_000
    out = P.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]
    assert [tuple(x) for x in out["runs"]] == [(0, 120_000, 3), (170_000, 20_000, 1)]
    assert out["collapsed"].split()[:4] == ["lorem", "ipsum", "dolor", "0"] and out["collapsed"].endswith("49999 end")


@pytest.mark.parametrize("limit", [400])
def test_query(spark, limit, monkeypatch):
    """Whole small table; brute force where it is quick enough."""
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op12_periodic_runs"](spark, SF_SMALL).collect()}
    assert got.keys() == docs.keys()
    checked = [i for i, t in docs.items() if len((t or "").split()) <= limit]
    assert len(checked) > 100
    for i in checked:
        assert got[i] == brute_row(i, docs[i])
