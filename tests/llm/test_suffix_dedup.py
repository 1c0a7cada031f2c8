import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from genolake.llm import suffix_dedup as S
from genolake.llm.suffix_array import permuted_lcp, suffix_array
from tests.conftest import SF_SMALL


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.binary(min_size=1, max_size=60), st.text("ab", min_size=1, max_size=80).map(str.encode),
                 st.text("abc", min_size=1, max_size=12).map(lambda s: s.encode() * 5)))
def test_suffix_array_and_prefixes(b):
    x = np.frombuffer(b, np.uint8)
    sa = suffix_array(x)
    want = sorted(range(len(b)), key=lambda i: b[i:])
    assert sa.tolist() == want
    common = permuted_lcp(x, sa)
    for j, i in zip(want, want[1:]):
        n = 0
        while max(i, j) + n < len(b) and b[i + n] == b[j + n]:
            n += 1
        assert common[i] == n


def brute(rows, length):
    """Digest rows by a table of all windows; rows of one id and text are one document."""
    docs = {}
    for d, t in rows:
        docs[(d is not None, d or 0, t or "")] = (t or "").encode()
    by_tag = sorted(docs, key=lambda k: k[:2])
    first = {}
    marks = {}
    for k in by_tag:
        raw = docs[k]
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            w = raw[i:i + length]
            if w in first:
                gone[i:i + length] = b"\1" * length
            else:
                first[w] = (k, i)
        marks[k] = gone
    out = []
    for d, t in rows:
        raw, gone = (t or "").encode(), marks[(d is not None, d or 0, t or "")]
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, length=100):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("x")).withColumn("raw", F.lit(1))
    return sorted((tuple(r) for r in S.dedup_digests(df.repartition(3), length).collect()), key=str)


def corpus(seed, n=70):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 7)))
    para = lambda k: " ".join(word() for _ in range(k))
    shared = [para(rnd.choice([8, 14, 25, 60])) for _ in range(6)]
    texts = []
    for _ in range(n):
        kind = rnd.random()
        if texts and kind < 0.2:
            t = rnd.choice(texts)
        elif texts and kind < 0.4:
            t = rnd.choice(texts)
            a = rnd.randrange(len(t) + 1)
            t = t[:a] + para(2) + t[a + rnd.randrange(20):]
        elif kind < 0.7:
            t = " ".join(para(rnd.randint(0, 12)) + " " + rnd.choice(shared) for _ in range(rnd.randint(1, 4)))
        elif kind < 0.8:
            t = para(rnd.randint(1, 3)) * rnd.choice([5, 30])
        else:
            t = para(rnd.choice([1, 10, 40, 200]))
        texts.append(t)
    rows = list(enumerate(texts))
    rnd.shuffle(rows)
    return rows + [(900, None), (901, ""), (rows[0][0], rows[0][1]), (902, "x" * 500), (903, "x" * 99)]


@pytest.mark.parametrize("seed,length", [(1, 100), (2, 24), (3, 40)])
def test_equals_brute_force(spark, seed, length):
    rows = corpus(seed)
    assert run(spark, rows, length) == brute(rows, length)


def test_frequent_anchors_small_blocks_and_shards(spark, monkeypatch):
    rows = corpus(4)
    monkeypatch.setattr(S, "frequency_levels", lambda d, h: (np.arange(1 << 21) % 2).astype("uint8"))
    monkeypatch.setattr(S, "BLOCK_BYTES", 700)
    monkeypatch.setattr(S, "SHARD_BYTES", 500)
    monkeypatch.setattr(S, "_POS_BITS", 11)
    assert run(spark, rows, 40) == brute(rows, 40)


def test_batches_carry_over(spark):
    rows = corpus(6, 40)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert run(spark, rows, 40) == brute(rows, 40)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in S.dedup_digests(docs).collect()), key=str)
    assert got == brute(rows, 100) and sum(r[2] for r in got) > 0


def test_empty_and_null_id(spark):
    assert run(spark, []) == []
    t = "abcdefghij" * 3 + "klmnopq" * 20
    assert run(spark, [(None, t), (5, t)]) == brute([(None, t), (5, t)], 100)


def test_a_passage_of_thousands_of_documents_does_not_meet_in_one_shard(spark, monkeypatch, tmp_path):
    """The edges of a shared passage are segments of one key; no suffix array may hold them all."""
    rnd = random.Random(8)
    around = lambda k: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(k))
    passage = around(300)
    rows = [(i, around(60) + passage + around(60)) for i in range(2000)]
    whole = S.repeated_windows

    def spy(pieces, *rest):
        import os
        import uuid

        with open(os.path.join(str(tmp_path), uuid.uuid4().hex), "w") as f:
            f.write(str(sum(map(len, pieces))))
        return whole(pieces, *rest)

    monkeypatch.setattr(S, "repeated_windows", spy)
    monkeypatch.setattr(S, "SHARD_BYTES", 10_000)
    assert run(spark, rows) == brute(rows, 100)
    sizes = [int(p.read_text()) for p in tmp_path.iterdir()]
    # A shard closes at the first part that reaches its size; parts are about that size themselves.
    assert sizes and max(sizes) < 3 * 10_000


def test_documents_are_cut_together_as_alone(monkeypatch):
    """Blocks and the chunks of their positions change no segment; many short documents make few blocks."""
    rnd, length = random.Random(17), 20
    texts = ["".join(rnd.choice("ab") for _ in range(rnd.choice([0, 3, 19, 20, 21, 90]))) for _ in range(300)]
    raws = [t.encode() for t in texts]
    width = length - S.GRAM + 1

    def plain(raw, level):
        """(key, start, bytes) of the runs of windows with one anchor, window by window."""
        h = S.gram_hashes(np.frombuffer(raw, np.uint8)).tolist()
        other = [(v ^ 0x5851F42D4C957F2D) * 0x2545F4914F6CDD1D % 2**64 for v in h]
        out, last = [], None
        for i in range(len(raw) - length + 1):
            least, second = (min(range(i, i + width), key=lambda j: (x[j] >> 24, j)) for x in (h, other))
            hot = level is not None and level[h[least] >> 64 - 21] > 0
            key = ((h[least] ^ h[second] >> 7) * 0xC2B2AE3D27D4EB4F + h[second]) % 2**64 if hot else h[least]
            mark = (least, second) if hot else least
            if mark == last:
                out[-1][2] += 1
            else:
                out.append([key, i, length])
            last = mark
        return [tuple(r) for r in out]

    some = (np.random.default_rng(3).random(1 << 21) < 0.5).astype(np.uint8)
    for level in (None, np.zeros(1 << 21, np.uint8), some):
        wanted = [(d, *row) for d, raw in enumerate(raws) for row in plain(raw, level)]
        for at_once in (1 << 15, 7):
            monkeypatch.setattr(S, "AT_ONCE", at_once)
            key, doc, first, size = S.cut(np.frombuffer(b"".join(raws), np.uint8), np.array([len(r) for r in raws]), length, level)
            begin = np.cumsum([0, *map(len, raws)])
            assert list(zip(doc.tolist(), key.tolist(), (first - begin[doc]).tolist(), size.tolist())) == wanted
    found = list(S.anchor_keys(texts, length))
    assert len(found) == 1
    assert found[0].tolist() == [k for raw in raws for k, _, _ in plain(raw, None)]
    monkeypatch.setattr(S, "ANCHOR_BYTES", 100)
    assert np.concatenate(list(S.anchor_keys(texts, length))).tolist() == found[0].tolist()
