import random
import unicodedata
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from genolake.llm import quality_classifier as QC, toxicity as TX
from genolake.llm.labelled import training_rows
from tests.conftest import SF_SMALL

MEDIUM = "/root/testdata/sf0.1"


def auc(rows):
    score, label = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(rows))
    rank[order] = np.arange(len(rows))
    good = label.sum()
    return (rank[label == 1].sum() - good * (good - 1) / 2) / (good * (len(label) - good))


@pytest.mark.parametrize("which,label,least", [(QC, "quality", 0.97), (TX, "toxic", 0.93)])
def test_held_out(spark, which, label, least):
    docs, labels = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "labels"))
    out = which.classify(docs, labels)
    known = {r["doc_id"]: r[label] for r in labels.collect()}
    rows = out.collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    held = [(r["score"], known[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in known]
    assert auc(held) > least


def test_training_rows_leave_the_fold_out(spark):
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    rows = training_rows(docs, labels, "quality", 1000).collect()
    assert rows and all(zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2 for r in rows)
    assert training_rows(docs, labels, "quality", 3).count() <= 6


ODD = [(1, None), (2, ""), (3, " \n"), (4, "x" * 100_000), (4, "x" * 100_000), (5, "plain words in a line " * 30)]


def test_odd_rows_and_empty_tables(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("label", F.lit(1))
    labels = spark.createDataFrame([(5, 1, 0), (4, 0, 1), (None, 1, 1), (3, None, None)],
                                   "doc_id long, quality int, toxic int")
    for which in (QC, TX):
        out = which.classify(df, labels).collect()
        assert sorted(r["doc_id"] for r in out) == sorted(d for d, _ in ODD)
        assert all(0 <= r["score"] <= 1 for r in out)
        assert which.classify(df.limit(0), labels).count() == 0
        none = which.classify(df, labels.limit(0)).collect()
        assert len(none) == len(ODD) and all(r["predicted"] == 0 for r in none)
    assert QC.keep_good(df, labels.limit(0)).count() == 0


def test_exact_cosines():
    rnd = np.random.default_rng(0)
    x = rnd.random((40, QC.TERMS)).astype(np.float32)
    m = QC.Model(np.ones(QC.TERMS, np.float32), rnd.standard_normal((QC.TERMS, 6)).astype(np.float32), None, None)
    m.vectors, m.labels = m.embed(x[:30]), np.arange(30) % 2.0
    got = m.score(x, neighbours=5)
    for i, row in enumerate(m.embed(x)):
        cos = m.vectors @ row
        near = np.argsort(-cos, kind="stable")[:5]
        w = np.clip(cos[near], 1e-6, 1).astype(float) ** QC.SHARPNESS
        assert abs(got[i] - (w * m.labels[near]).sum() / w.sum()) < 1e-5


def brute_hits(folded, lexicon):
    words, at = [], 0
    padded = folded
    found = {}
    for i, ch in enumerate(padded):
        if ch != " " and (i == 0 or padded[i - 1] == " "):
            w = [s for s in lexicon.stems if padded.startswith(s, i)]
            if w:
                found[i] = max(lexicon.stems[s] for s in w)
    for e in lexicon.exceptions:
        at = (" " + padded).find(" " + e)
        while at >= 0:
            for s in [s for s in found if at <= s < at + len(e)]:
                del found[s]
            at = (" " + padded).find(" " + e, at + 1)
    return found


def test_automaton_against_brute_force():
    rnd = random.Random(1)
    lex = TX.Lexicon({"ab": 1.0, "abc": 2.5, "b": 0.5, "caa": 1.5}, ["abc a", "b ca"])
    a = lex.automaton()
    for _ in range(500):
        text = "".join(rnd.choice("abc ") for _ in range(40))
        assert TX.hits(text, a) == brute_hits(text, lex)
    assert TX.hits("abc", TX.Lexicon({}).automaton()) == {}


def test_folding():
    assert len(TX.fold("Ünï 1d10t")) == 9
    assert TX.fold("1D10T") == TX.fold("idiot") == TX.fold("іdіоt") == TX.fold("ïdïöt") == TX.fold("!idiot")[1:]
    assert TX.fold("c1own") == TX.fold("clown")
    plain = TX.fold("you idiot there")
    evasions = ["you idio\u0301t there", "you idi\u200bot there", "you İdiot there", "you \U0001d422\U0001d41d\U0001d422\U0001d428\U0001d42d there",
                "you ｉｄｉｏｔ there", "you i\u00addi\u2060ot there", "you ïdïöt there", "you ⓘⓓⓘⓞⓣ there", "you idi\ufeffot there"]
    for e in evasions:
        assert TX.fold(e) == TX.fold(unicodedata.normalize("NFD", e)) == TX.fold(unicodedata.normalize("NFC", e)) == plain
        folded, places = TX.fold_places(e)
        assert folded == plain and len(places) == len(folded) and [e[i] for i in places[:4]] == list("you ")
        assert places[-5:] == list(range(len(e) - 5, len(e)))


def test_planted_words_are_learned(spark):
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("bcdegmnprtu") for _ in range(rnd.randint(2, 6)))
    rows, labels = [], []
    for i in range(500):
        words = [word() for _ in range(60)]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                words[rnd.randrange(60)] = rnd.choice(["wallyhead", "w4llyhe4d", "zozo" + rnd.choice("abc")])
        elif i % 3 == 0:
            words[10:12] = ["wallyhead", "fish"]
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tags = spark.createDataFrame(labels, "doc_id long, toxic int")
    lexicon = TX.learn(docs, tags)
    assert any(s.startswith("zozo") for s in lexicon.stems)
    out = {r["doc_id"]: r for r in TX.classify(docs, tags).collect()}
    held = [i for i in out if out[i]["held_out"]]
    assert np.mean([out[i]["predicted"] == labels[i][1] for i in held]) > 0.9


def test_full_sample_with_several_texts_of_one_id(spark):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    rows = [(i, f"{'loud' if i % 2 else 'calm'} words number {i} version {k} " * (5 + k)) for i in range(40) for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for label in ("quality", "toxic"):
        got = training_rows(docs, labels, label, 4).collect()
        assert len(got) == 8 == len({r["doc_id"] for r in got}) and {(r["doc_id"], r["text"]) for r in got} <= set(rows)
    assert len(QC.fit(docs, labels, per_class=4).labels) == 8
    TX.learn(docs, labels, per_class=4)


def test_fit_holds_term_rows_without_their_zeros(monkeypatch):
    """The driver's share of the quality model: term rows travel packed and are unpacked a block at a time."""
    import tracemalloc

    import pyarrow as pa

    rnd, n = random.Random(5), 2048
    texts = ["".join(rnd.choice("abcdefgh ,.\n") for _ in range(200)) for _ in range(n)] + [""]
    batch = pa.record_batch([pa.array(range(n + 1), pa.int64()), pa.array(texts), pa.array([i % 2 for i in range(n + 1)], pa.int32())],
                            names=["doc_id", "text", "label"])

    class Sample:
        def mapInArrow(self, run, schema):
            return pa.Table.from_batches(list(run([batch])))

    monkeypatch.setattr(QC, "training_rows", lambda *_: Sample())
    monkeypatch.setattr(QC, "collected", lambda rows, bound: rows.to_pandas())
    held = Sample().mapInArrow(QC._term_rows, "")["terms"].to_pylist()
    assert max(map(len, held)) < QC.TERMS  # half of a dense float16 row
    assert np.array_equal(QC._unpacked(held), np.stack([QC.terms(t) for t in texts]).astype(np.float16))

    # No dense array of the whole sample is made.
    monkeypatch.setattr(np.linalg, "eigh", lambda gram: (None, np.eye(QC.TERMS, dtype=np.float32)))
    tracemalloc.start()
    try:
        model = QC.fit(None, None)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    square = 4 * QC.TERMS ** 2
    assert isinstance(model.vectors, np.ndarray) and len(model.labels) == n + 1
    assert peak < 2 * square + 6 * 4 * QC.BLOCK * QC.TERMS + len(held) * 2000
