import random
import re

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from genolake.llm import sentencepiece_lattice as L
from tests.conftest import SF_SMALL

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def table():
    p = L.Pieces.read(MODEL)
    return {t: (i, s) for t, i, s in p.rows}, p


def best(table, text):
    """Plain dynamic programming, word by word."""
    pieces, p = table
    out = []
    for word in re.findall(L.WORD, " " + text) if text else []:
        w = word.replace(" ", L.MARK)
        state = [(0.0, 0, [])]
        for end in range(1, len(w) + 1):
            options = []
            for start in range(max(0, end - p.longest), end):
                if w[start:end] in pieces:
                    i, s = pieces[w[start:end]]
                    options.append((state[start][0] + s, -start, state[start][2] + [i]))
                elif end - start == 1:
                    options.append((state[start][0] + p.unknown_score, -start,
                                    state[start][2] + [p.byte_ids[b] for b in w[start].encode()]))
            state.append(max(options, key=lambda o: o[:2]))
        out += state[-1][2]
    return out


def encoded(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("block", F.lit("x")).withColumn("ids", F.lit(1))
    return {r["doc_id"]: list(r["ids"]) for r in L.encode(df.repartition(3), MODEL).collect()}


def test_equals_dynamic_programming(spark, table, monkeypatch):
    monkeypatch.setattr(L, "BLOCK_BYTES", 900)
    rnd = random.Random(2)
    texts = ["the quick brown\nfox", " é漢字 \t x", "a   b    c", "  lead", "trail  ", "ゼ벨😀😀\x00é", "", None, "e" * 300,
             "Übergrößenträger, l'été!", "x" * 40 + " " + "in" * 30]
    texts += [" ".join("".join(rnd.choice("abcdeéinthr ,.") for _ in range(rnd.randint(1, 20))) for _ in range(12))
              for _ in range(30)]
    rows = list(enumerate(texts))
    got = encoded(spark, rows)
    for i, t in rows:
        assert got[i] == best(table, t or ""), t


def test_round_trip_of_a_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = L.round_trip(docs, MODEL).collect()
    assert len(out) == docs.count() and all(r["round_trip"] for r in out)
    sample = L.decode(L.encode(docs.limit(20), MODEL), MODEL)
    want = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
    assert all(want[r["doc_id"]] == r["text"] for r in sample.collect())


def test_pieces_agree_with_the_library(spark):
    """Decoding is the library's; most words of a merge model get the library's pieces too."""
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    text = "the quick brown fox jumps over the lazy dog and runs through the wood, where nobody was waiting for it"
    got = encoded(spark, [(0, text)])[0]
    assert sp.decode(got) == text == sp.decode(sp.encode(" " + text))[1:]
    assert len(set(got) & set(sp.encode(" " + text))) > 0.7 * len(set(got))


def test_empty(spark):
    assert encoded(spark, []) == {}


def test_long_runs_without_blanks(spark, table):
    """Plain dynamic programming over the whole text: no place is cut that a piece could cross."""
    pieces, p = table
    rnd = random.Random(6)

    def whole(text):
        w, state, back = (" " + text).replace(" ", L.MARK), [0.0], [None]
        for end in range(1, len(w) + 1):
            options = []
            for start in range(max(0, end - p.longest), end):
                if w[start:end] in pieces:
                    i, s = pieces[w[start:end]]
                    options.append((state[start] + s, -start, [i]))
                elif end - start == 1:
                    options.append((state[start] + p.unknown_score, -start, [p.byte_ids[b] for b in w[start].encode()]))
            s, start, ids = max(options, key=lambda o: o[:2])
            state.append(s)
            back.append((-start, ids))
        out, at = [], len(w)
        while at:
            out.append(back[at][1])
            at = back[at][0]
        return [i for ids in reversed(out) for i in ids]

    texts = ["thequickbrownfoxjumpsoverthelazydog" * 60, "in" * 700, "a" + " " * 300 + "b", " " * 200, "ゼé漢字" * 200,
             "".join(rnd.choice("etaoinshrdlu") for _ in range(5000)) + " end", "the\nand\tof\n" * 90]
    got = encoded(spark, list(enumerate(texts)))
    for i, t in enumerate(texts):
        assert got[i] == whole(t), t[:40]


def test_ids_travel_back_without_the_parts(spark, table, monkeypatch):
    """One row a bucket and block, which names parts by place; no text beside the ids."""
    monkeypatch.setattr(L, "BLOCK_BYTES", 300)
    rows = [(i, f"word{i % 7}  two{i % 5} あい the{i}") for i in range(60)] + [(60, " a"), (61, "b "), (62, "c" * 300 + " d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2, "doc_id").localCheckpoint()
    out = L.encode(docs, MODEL)
    back = out._jdf.queryExecution().analyzed().children().apply(1)
    names = {back.output().apply(i).name() for i in range(back.output().size())}
    assert names == {"of_block", "bucket", "sum", "places", "ids"}
    got = {r["doc_id"]: list(r["ids"]) for r in out.collect()}
    assert len(got) == 63 and all(got[i] == best(table, t) for i, t in rows)


def test_words_are_cut_a_few_at_a_time_and_blocks_change_nothing(spark, table, monkeypatch):
    """No array is made over all characters of a block's words; block sizes change no row."""
    n = L.Neighbours({(t[i], t[i + 1]) for t, _, _ in table[1].rows for i in range(len(t) - 1)})
    rnd = random.Random(8)
    words = [" " + "".join(rnd.choice("aeinrst0日é") for _ in range(rnd.randrange(12))) for _ in range(100)]
    whole, begin = n.parts(words)
    sizes, cut = [], L.Neighbours._cut
    monkeypatch.setattr(L.Neighbours, "_cut", lambda self, some: sizes.append(len(some)) or cut(self, some), raising=False)
    monkeypatch.setattr(L, "CUT_WORDS", 7, raising=False)
    parts, at = n.parts(words)
    assert parts == whole and at.tolist() == begin.tolist() and max(sizes) == 7 and n.parts([])[0] == []
    assert ["".join(parts[a:z]) for a, z in zip(at, at[1:])] == [w.replace(" ", L.MARK) for w in words]
    docs = spark.createDataFrame([(i, " ".join(words[i:i + 9])) for i in range(60)] + [(None, None), (3, "")], "doc_id long, text string")
    one, two = (sorted(map(str, L.round_trip(docs, MODEL, *size).collect())) for size in ((), (64,)))
    assert one == two
