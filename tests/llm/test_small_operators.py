"""Rules, decontamination, sharding, token store and chats against brute force."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from genolake.llm import chat, decontamination as D, quality_rules as Q, sharding as S, token_store as T
from genolake.llm.sql import SQL
from tests.conftest import SF_SMALL

BPE = public_tokenizers.path("byte_bpe_50k.json")


def frame(spark, rows, schema="doc_id long, text string"):
    """Rows plus columns whose names clash with the operators' own."""
    df = spark.createDataFrame(rows, schema).repartition(3)
    for c in ("n_words", "segment", "_pid", "shard", "failures", "total"):
        df = df.withColumn(c, F.lit("x"))
    return df


def table(spark, name):
    return spark.read.parquet(f"{SF_SMALL}/{name}.parquet")


ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "a a a a a a"), (5, "a a a a a a"), (6, "é " * 60 + "\n" * 3),
       (7, "x y\nx y\n\n x y\n# $ %|"), (8, "one\x0btwo\x0cthree four five"), (9, "word " * 40_000)]


# -- quality rules ---------------------------------------------------------

def brute_measures(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    counts = {}
    for w in windows:
        counts[w] = counts.get(w, 0) + 1
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered), t.count("!"))


def test_rules(spark):
    rows = ODD + [(20, "a! b! c!"), (21, "p q r " * 30), (22, " ".join(f"w{i}" for i in range(60)))]
    got = sorted(tuple(r[c] for c in ["doc_id", *Q.MEASURES]) for r in Q.ledger(frame(spark, rows)).collect())
    assert got == sorted((d, *brute_measures(t)) for d, t in rows)
    out = {r["doc_id"]: r for r in Q.rule_verdicts(frame(spark, rows)).collect()}
    assert out[22]["kept"] and not out[22]["base_failed"]
    assert out[21]["base_failed"] and not out[21]["kept"] and out[1]["base_failed"]
    assert Q.ledger(frame(spark, [])).count() == 0


def test_ablations(spark):
    led = Q.ledger(table(spark, "documents"))
    bits = [r["failures"] & Q.STANDARD.mask for r in led.collect()]
    for r in Q.ablations(led, Q.STANDARD).collect():
        b = Q.bit(r["rule"])
        assert r["rejected"] == sum(1 for x in bits if x & b)
        assert r["rejected_alone"] == sum(1 for x in bits if x == b)
        assert r["kept_without"] == sum(1 for x in bits if not x & ~b)


# -- decontamination -------------------------------------------------------

def brute_hits(text, items, window=10):
    def words(t):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)

    w, hit, found = words(text), set(), set()
    for item, t in items:
        q = words(t)
        if not q:
            continue
        n = min(window, len(q))
        for i in range(len(q) - n + 1):
            for j in range(len(w) - n + 1):
                if w[j:j + n] == q[i:i + n]:
                    hit |= set(range(j, j + n))
                    found.add(str(item))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def test_decontamination(spark, monkeypatch):
    rnd = random.Random(4)
    vocab = ["ab", "Cd", "e1", "été", "f-g", "h", "ii", "J"]
    para = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(i, para(rnd.choice([0, 1, 3, 9, 10, 11, 25]))) for i in range(14)] + [(50, None), (3, "ab Cd"), (51, "zz top")]
    rows = ODD + [(100 + i, para(rnd.choice([0, 5, 40])) + ", " + rnd.choice(items)[1:][0].__str__().upper() + "! " + para(9))
                  for i in range(40)]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("term", F.lit(1))
    want = sorted((d, *brute_hits(t, items)) for d, t in rows)
    monkeypatch.setattr(D, "SEGMENT_WORDS", 200)
    assert sorted(tuple(r) for r in D.contamination(frame(spark, rows), bench).collect()) == want
    monkeypatch.setattr(D, "BLOCK_ITEMS", 4)
    assert sorted(tuple(r) for r in D.contamination(frame(spark, rows), bench).collect()) == want


def test_decontamination_of_a_table_and_empty_tables(spark):
    docs, bench = table(spark, "documents"), table(spark, "benchmark")
    items = [tuple(r) for r in bench.collect()]
    want = sorted((r["doc_id"], *brute_hits(r["text"], items)) for r in docs.limit(60).collect())
    assert sorted(tuple(r) for r in D.contamination(docs.limit(60), bench).collect()) == want
    assert D.contamination(docs.limit(0), bench).count() == 0
    clear = D.contamination(docs, bench.limit(0)).collect()
    assert len(clear) == docs.count() and not any(r["contaminated"] for r in clear)


def test_proximity(spark):
    docs = frame(spark, [(1, "alpha x beta gamma"), (2, "alpha beta gamma"), (3, "alpha x x x x beta gamma")])
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    found = lambda slop: sorted(r["doc_id"] for r in D.matches(docs, items, slop=slop).collect() if r["items"])
    assert found(0) == [2] and found(1) == [1, 2] and found(4) == [1, 2, 3]


# -- sharding --------------------------------------------------------------

@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 65, 1000, 4097])
def test_permutation(n):
    rows = np.arange(n)
    p = S.permute(rows, n, 17)
    assert sorted(p.tolist()) == list(range(n))
    assert (S.permute(p, n, 17, inverse=True) == rows).all()
    if n > 60:
        assert (p != rows).mean() > 0.9 and (S.permute(rows, n, 18) != p).any()


def test_shards(spark):
    rows = ODD + [(i, f"text {i}") for i in range(20, 300)]
    a = S.shard_rows(frame(spark, rows)).collect()
    b = S.shard_rows(frame(spark, list(reversed(rows))).repartition(5)).collect()
    key = lambda r: (r["doc_id"], r["row_no"], r["shard"], r["slot"], r["size"], r["text_crc32"])
    assert sorted(map(key, a)) == sorted(map(key, b))
    by = {}
    for r in a:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in a) == sorted(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    assert S.shard_rows(frame(spark, [])).count() == 0


# -- token store -----------------------------------------------------------

def test_planes_round_trip():
    rnd = np.random.default_rng(1)
    for n in (1, 7, 8, 1000):
        for top in (1, 300, 50_257, 2**32):
            ids = rnd.integers(0, top, n, dtype=np.uint64).astype("<u4")
            for planes in ("byte", "bit"):
                sizes, payload = T.pack(ids, planes)
                assert (T.unpack(payload, sizes, n, planes) == ids).all()


def test_crc_combine():
    a, b = b"hello " * 9, b"world" * 1000
    assert T.crc_combine(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
    assert T.crc_combine(5, 0, 0) == 5


def library_digests(rows):
    from tokenizers import Tokenizer

    tk, start, out = Tokenizer.from_file(BPE), 0, []
    for d, t in sorted(rows, key=lambda r: (r[0], zlib.crc32((r[1] or "").encode()), len((r[1] or "").encode()))):
        ids = tk.encode(t or "", add_special_tokens=False).ids + [0]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out)


def test_store_equals_library(spark, monkeypatch):
    rnd = random.Random(3)
    alphabet = ["a", "B", "é", " ", "  ", "\n", "\n ", " \n", "\t", "'s", "'S", "12", "!", "漢", "　", "\x1c", " ", "😀"]
    rows = ODD + [(30 + i, "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60)))) for i in range(150)]
    rows += [(400, "x <|endoftext|> y"), (401, " lead"), (402, "tail "), (403, "   ")]
    monkeypatch.setattr(T, "CHUNK_IDS", 64)
    path = f"{spark.sparkContext.getCheckpointDir()}/store-{rnd.random()}"
    for planes in ("byte", "bit"):
        T.write_store(frame(spark, rows), path + planes, BPE, planes=planes, chunk_ids=64)
        got = sorted(tuple(r) for r in T.read_digests(spark, path + planes).collect())
        assert got == library_digests(rows)
    ids = T.read_ids(spark, path + "bit").where("doc_id = 401").collect()
    assert [i for r in sorted(ids, key=lambda r: r["piece_no"]) for i in r["ids"]][-1] == 0


def test_store_of_a_table(spark):
    docs = table(spark, "documents")
    got = sorted(tuple(r) for r in T.stored_token_digests(docs, BPE).collect())
    assert got == library_digests([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert T.stored_token_digests(docs.limit(0), BPE).count() == 0


# -- chats -----------------------------------------------------------------

CHAT_SCHEMA = "conv_id long, turn long, role string, text string"


def brute_chats(rows):
    convs = {}
    for c, t, r, x in set(rows):
        if c is not None and t is not None:
            convs.setdefault(c, []).append((t, r is not None, r or "", x is not None, x or ""))
    convs = {c: sorted(v) for c, v in convs.items()}
    seen = {}
    for c in sorted(convs):
        seen.setdefault(tuple(convs[c]), []).append(c)
    prefixes = set()
    for v in seen:
        turns = sorted({r[0] for r in v})
        prefixes |= {tuple(r for r in v if r[0] <= t) for t in turns[:-1]}
    return sorted((ids[0], len(ids), len({r[0] for r in v}), len(v),
                   "".join(f"<|{r[2]}|>\n{r[4]}\n<|end|>\n" for r in v)) for v, ids in seen.items() if v not in prefixes)


def test_chats(spark, monkeypatch):
    rnd = random.Random(8)
    rows, logs = [], []
    for c in range(60):
        base = rnd.choice(logs) if logs and rnd.random() < 0.7 else []
        conv = base[:rnd.randint(0, len(base))] + [(rnd.choice(["user", "bot", None]), rnd.choice(["hi", "", None, "ok"]))
                                                   for _ in range(rnd.randint(0, 3))]
        logs.append(conv)
        rows += [(c, i, r, x) for i, (r, x) in enumerate(conv)]
    rows += rows[:7] + [(None, 0, "user", "x"), (99, None, "user", "x"), (98, 0, "a", "p"), (98, 0, "b", "q"), (97, 0, "a", "p")]
    df = spark.createDataFrame(rows, CHAT_SCHEMA).withColumn("n", F.lit(0)).withColumn("f1", F.lit(0)).repartition(3)
    for block in (1024, 2):
        monkeypatch.setattr(chat, "BLOCK_TURNS", block)
        got = sorted(tuple(r) for r in chat.format_chats(df).collect())
        assert got == brute_chats(rows)
    assert chat.format_chats(df.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_duckdb(spark, name):
    from genolake.llm.queries import QUERIES

    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    df = QUERIES[name](spark, SF_SMALL)
    cur = con.execute(SQL[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert sorted(cur.fetchall()) == sorted(tuple(r) for r in df.select(*cols).collect())


def test_a_large_test_set_is_matched_in_blocks(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60)
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    want = sorted(tuple(r) for r in D.contamination(docs, bench).collect())
    chars = [len(r["text"] or "") for r in bench.collect()]
    sizes, whole = [], D.Phrases

    def spy(items, window):
        sizes.append(sum(len(t) for _, t in items))
        return whole(items, window)

    monkeypatch.setattr(D, "Phrases", spy)
    monkeypatch.setattr(D, "MAX_BLOCK_CHARS", sum(chars) // 3)
    assert sorted(tuple(r) for r in D.contamination(docs, bench).collect()) == want
    assert len(sizes) > 2 and max(sizes) <= max(sum(chars) // 3, max(chars))


def test_blocks_agree_however_each_pass_cuts_its_input(spark, monkeypatch, tmp_path):
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    part = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60).select("doc_id", "text")
    item = bench.first()["text"]
    odd = spark.createDataFrame([(None, item), (None, item), (None, None), (5, item), (5, item), (5, "x"), (6, "")], part.schema)
    part.unionByName(odd).repartition(12).write.parquet(str(tmp_path / "docs"))
    read = lambda: spark.read.parquet(str(tmp_path / "docs"))
    want = sorted(map(tuple, D.matches(read(), bench).collect()), key=str)
    monkeypatch.setattr(D, "BLOCK_ITEMS", 12)
    build, passes = D.build_index, []

    def other_splits(docs, *args, **kw):
        passes.append(len(passes))
        spark.conf.set("spark.sql.files.minPartitionNum", str(1 + 5 * passes[-1]))
        return build(read(), *args, **kw)

    monkeypatch.setattr(D, "build_index", other_splits)
    try:
        got = sorted(map(tuple, D.matches(read(), bench).collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert len(passes) > 2 and got == want


def test_items_without_an_id(spark):
    words = " ".join(f"w{i}" for i in range(12))
    bench = spark.createDataFrame([(None, words), (None, words + " more"), ("b", "q " * 11)], "item_id string, text string")
    docs = spark.createDataFrame([(1, "a " + words), (2, words + " " + "q " * 11), (3, "clean")], "doc_id long, text string")
    got = {r["doc_id"]: (list(r["items"]), len(r["hits"])) for r in D.matches(docs, bench).collect()}
    assert got == {1: ([""], 12), 2: (["", "b"], 23), 3: ([], 0)}


def test_common_pieces_are_cut_as_the_library_does():
    pieces = T.Encoder(public_tokenizers.path("byte_bpe_50k.json")).pieces
    library, calls = pieces.pre, []
    pieces.pre = lambda piece: calls.append(piece) or library(piece)
    rnd = random.Random(11)
    common = "abzZé ÿÀɏ'''sdmtlvre019.,!-_ \n\t\r "
    for alphabet, own in ((common, True), (common + "×Ġ\x00\x0b  漢½👍", False)):
        for _ in range(3000):
            piece = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 14)))
            words = [w[1:] if w[0] == "\0" else w.encode().decode("latin-1").translate(T._BYTE_LETTERS)
                     for w in pieces.pre_tokens(piece)]
            assert words == [w for w, _ in library(piece)], piece
        assert bool(calls) != own  # the library is not called for common characters


def test_encoder_keeps_texts_and_byte_letters_apart():
    encoder = T.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ("the Ġthe \x00Ġthe Ġthe× the", "\x00 \x00a é é Ã© Ã©\x00", "it's don't 'll  \n x'S \t", "ɏ½ Ȁ12 ÿ"):
        assert encoder.ids(text).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_a_space_after_a_blank_is_found():
    rnd, blanks = random.Random(13), re.compile(r"\s ")
    assert all(bool(re.fullmatch(r"\s", chr(c))) == (chr(c) in T._SPACES) for c in range(0x110000))
    for _ in range(5000):
        text = "".join(rnd.choice("aé漢" + " " * 3 + "\n\t\x1f\x85\u2003") for _ in range(rnd.randint(0, 6)))
        assert T.blanks_meet(text) == bool(blanks.search(text)), text
