"""SentencePiece encoding as a relational lattice, and decoding.

The model file gives the piece table: text, id and score of every piece
(about 32,000 rows, always broadcast; its size is checked).  Encoding is the
best path through the lattice of pieces: the sum of log probabilities is
maximal, ties go to the longer last piece.  A unigram model's scores are log
probabilities already; a merge model's are negative ranks, from which Zipf's
law gives ``-log(2 + rank)``.  (For a merge model the library merges pairs
greedily and may choose other pieces of the same text.)

1. A word is a run of blanks with the characters up to the next blank.  It falls
   apart into parts wherever no piece holds the two neighbouring characters:
   no path can join there, so parts are encoded on their own (and far fewer
   of them are distinct).
2. Each map task lists the distinct parts of its documents, in blocks of about
   ``BLOCK_BYTES`` of text, dealt to buckets by checksum (a block's parts of
   one bucket travel as one text, joined by blanks, which no part holds); one
   shuffle, over as many partitions as the texts' size asks for, brings every
   part together once (once for every ``GROUP_TASKS`` map tasks, which bounds
   the list of blocks that hold it).
   Parts over ``MAX_PART`` characters (long runs without blanks) stay: step 5
   folds them over their ends in one pass, with the last ends as state.
3. Every substring of a part, up to the longest piece, is exploded and
   equi-joined to the piece table; a character without a piece of its own
   becomes an unknown edge.
4. Edges are grouped by part, named by 128 bits of its hash (already together,
   so without a shuffle), and
   folded with ``aggregate`` over the ends: the state holds the best score,
   start and piece of every end so far; a second fold walks back.  Unknown
   characters become byte pieces.
5. The parts' ids go back to the blocks that hold them, in one row a bucket
   and block without the parts themselves (the block lists its parts again, in
   the same order; checksums prove it), and meet the blocks' texts (shuffled compressed) in a co-group, which writes each whole text as
   ids; checksums and decoding proofs are taken there, beside the ids.

Both passes over the documents cut them alike only if they read the same rows
in the same order, as they do from files; hand in a written table, not the
result of a shuffle (lists of parts that differ raise ``KeyError``).

Defined cases: a null or empty text has no ids; words have any length; a text that already holds the blank mark U+2581 reads back with a blank
there; repeated rows are encoded each; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_text

MARK = "▁"
BLOCK_BYTES = 6_000_000
CUT_WORDS = 16_384  # words cut into parts at a time
GROUP_TASKS = 1 << 10
# text bytes for each partition of parts, and the most partitions asked for
PARTITION_TEXT, MAX_PARTITIONS = 2_000_000, 20_000
MAX_PART = 256
PLACE = 2 * MAX_PART  # a part's place in its list and its number of ids travel as one number
MAX_PIECES = 500_000
WORD = " *[^ ]+| +"


@dataclass
class Pieces:
    """The piece table of a model, read once on the driver."""

    rows: list[tuple[str, int, float]]
    byte_ids: list[int]
    texts: list[bytes]
    unknown_score: float
    longest: int

    @classmethod
    def read(cls, path: str, ranks: bool = True) -> Pieces:
        """``ranks``: the model's scores are negative merge ranks."""
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        if n > MAX_PIECES:
            raise ValueError(f"a piece table of {n} rows is too large to broadcast")
        rows, texts, byte_of = [], [], {}
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                byte_of[int(piece[3:5], 16)] = i
                texts.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                texts.append(b"")
            else:
                if MARK in piece.lstrip(MARK):
                    raise ValueError(f"piece {piece!r} spans two words")
                score = sp.get_score(i)
                rows.append((piece, i, -math.log(2 - score) if ranks else score))
                texts.append(piece.replace(MARK, " ").encode())
        if len(byte_of) != 256:
            raise ValueError("the model has no byte pieces")
        return cls(rows, [byte_of[b] for b in range(256)], texts, min(s for _, _, s in rows) - 10.0,
                   max(len(p) for p, _, _ in rows))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, "sub string, id int, score double")


def lattice_edges(words: DataFrame, pieces: Pieces, key: list[str], keep: list[str]) -> DataFrame:
    """``key.., keep.., start, end, id, score``: every piece of every ``word``; id < 0 marks an unknown character.

    Only the edge over the first character carries ``keep`` (null on the others): there is one for every word.
    """
    w = words.select(*dict.fromkeys([*key, "word", *keep]), F.length("word").alias("_n"))
    w = w.withColumn("start", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    w = w.withColumn("_l", F.explode(F.sequence(F.lit(1), F.least(F.lit(pieces.longest), F.col("_n") - F.col("start")))))
    w = w.withColumn("sub", F.substring("word", F.col("start") + 1, F.col("_l")))
    table = F.broadcast(pieces.frame(words.sparkSession))
    hit = w.join(table, "sub", "left").where("id IS NOT NULL OR _l = 1")
    first = (F.col("start") == 0) & (F.col("_l") == 1)
    return hit.select(*key, *[F.when(first, F.col(c)).alias(c) for c in keep], "start", (F.col("start") + F.col("_l")).alias("end"),
                      F.coalesce("id", -1 - F.col("start")).alias("id"),
                      F.coalesce("score", F.lit(pieces.unknown_score)).alias("score"))


def best_path(edges: Column, n: Column) -> Column:
    """Ids of the best path to end ``n``; ``edges``: one part's array of (end, start, id, score)."""
    first = F.array(F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("back"), F.lit(0).alias("id")))

    def step(best: Column, end: Column) -> Column:
        # The greatest by score, then by the lesser start (kept negative), of the edges that end here.
        at = F.filter(edges, lambda e: e["end"] == end)
        return F.concat(best, F.array(F.array_max(F.transform(at, lambda e: F.struct(
            (best[e["start"]]["s"] + e["score"]).alias("s"), (-e["start"]).alias("back"), e["id"].alias("id"))))))

    def back(best: Column) -> Column:
        state = F.struct((F.size(best) - 1).alias("at"), F.array().cast("array<int>").alias("ids"))

        def walk(s: Column, _: Column) -> Column:
            return F.when(s["at"] > 0, F.struct((-best[s["at"]]["back"]).alias("at"),
                                                F.concat(F.array(best[s["at"]]["id"]), s["ids"]).alias("ids"))).otherwise(s)

        return F.aggregate(best, state, walk, lambda s: s["ids"])

    return F.aggregate(F.sequence(F.lit(1), n), first, step, back)


def encode_words(words: DataFrame, pieces: Pieces, key: list[str], keep: list[str]) -> DataFrame:
    """``word, keep.., ids`` for words that differ in ``key``; no shuffle if they are already dealt by it."""
    edges = lattice_edges(words, pieces, key, ["word", *keep])
    grouped = edges.groupBy(*key).agg(F.collect_list(F.struct("end", "start", "id", "score")).alias("edges"),
                                      *[F.first(c, ignorenulls=True).alias(c) for c in ("word", *keep)])
    return grouped.select(*key, "word", *keep, best_path(F.col("edges"), F.length("word")).alias("ids"))


def long_path(part: str, table: dict[str, tuple[int, float]], unknown_score: float, longest: int) -> array:
    """Ids of the best path of a long part, as ``best_path`` finds them: ties go to the lesser start."""
    n = len(part)
    backs, ids = array("i", bytes(4 * (n + 1))), array("i", bytes(4 * (n + 1)))
    scores = [0.0] * (longest + 1)  # of the last ends, in a ring
    get, ring = table.get, longest + 1
    for end in range(1, n + 1):
        best = None
        for start in range(max(0, end - longest), end):
            hit = get(part[start:end])
            if hit is None:
                if start < end - 1:
                    continue
                hit = (-1 - start, unknown_score)
            s = scores[start % ring] + hit[1]
            if best is None or s > best:
                best, backs[end], ids[end] = s, start, hit[0]
        scores[end % ring] = best
    out, at = array("i"), n
    while at:
        out.append(ids[at])
        at = backs[at]
    out.reverse()
    return out


class Neighbours:
    """The pairs of neighbouring characters that some piece holds; cuts words wherever none does."""

    def __init__(self, pairs: set[tuple[str, str]]):
        self.chars = np.array(sorted({ord(c) for p in pairs for c in p}), np.uint32)
        a, b = (np.searchsorted(self.chars, [ord(p[i]) for p in pairs]) for i in (0, 1))
        self.next = np.zeros((len(self.chars) + 1, len(self.chars) // 8 + 1), np.uint8)  # a bit a pair
        np.bitwise_or.at(self.next, (a, b >> 3), (1 << (b & 7)).astype(np.uint8))

    def parts(self, words: list[str]) -> tuple[list[str], np.ndarray]:
        """The parts of all words (blanks marked), one after another, and where each word's begin."""
        out, begin = [], []
        for k in range(0, len(words), CUT_WORDS):  # the arrays of a few words at a time stay small
            some, at = self._cut(words[k:k + CUT_WORDS])
            begin.append(at[:-1] + len(out))
            out += some
        return out, np.concatenate([*begin, np.array([len(out)])])

    def _cut(self, words: list[str]) -> tuple[list[str], np.ndarray]:
        text = "".join(words).replace(" ", MARK)
        begin = np.cumsum([0, *map(len, words)])
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        at = np.minimum(np.searchsorted(self.chars, points), len(self.chars) - 1)
        at = np.where(self.chars[at] == points, at, len(self.chars))  # the last row holds no pair
        left, right = at[:-1], at[1:]
        bits = self.next[left, np.minimum(right >> 3, self.next.shape[1] - 1)] >> (right & 7).astype(np.uint8)
        joined = (bits & 1).astype(bool) & (right < len(self.chars))
        cut = np.ones(len(points) + 1, bool)
        cut[1:-1] = ~joined
        cut[begin] = True
        cuts = np.flatnonzero(cut)
        ends = cuts.tolist()
        return [text[a:z] for a, z in zip(ends, ends[1:])], np.searchsorted(cuts, begin)


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Slices of a task's rows with the number of their block; the same cuts on every pass over the rows."""
    from pyspark import TaskContext

    base, k, held = TaskContext.get().partitionId() << 24, 0, 0
    for b in batches:
        lengths = pa.compute.binary_length(b.column(1)).to_numpy(zero_copy_only=False)
        lo = 0
        for hi in range(1, b.num_rows + 1):
            held += int(lengths[hi - 1])
            if held >= size or hi == b.num_rows:
                yield base + k, b.slice(lo, hi - lo)
                lo = hi
                if held >= size:
                    k, held = k + 1, 0


ENCODED_SCHEMA = "doc_id long, text string, n_words long, ids array<int>"
#: (rows of doc_id and text, words of each, ids of each as int32 bytes) -> the rows to return
Finish = Callable[[pa.RecordBatch, list[int], list[bytes]], pa.Table]


def id_lists(arrays: list[bytes]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(arrays), np.int32), pa.int32()))


def encode(docs: DataFrame, model: str) -> DataFrame:
    """``doc_id, text, n_words, ids`` of every row of ``docs``."""
    def finish(b: pa.RecordBatch, n_words: list[int], arrays: list[bytes]) -> pa.Table:
        return pa.table({"doc_id": b.column(0), "text": b.column(1), "n_words": pa.array(n_words, pa.int64()), "ids": id_lists(arrays)})

    return _encoded(docs, Pieces.read(model), finish, ENCODED_SCHEMA)


def _encoded(docs: DataFrame, pieces: Pieces, finish: Finish, schema: str, size: int | None = None) -> DataFrame:
    neighbours = Neighbours({(p[i], p[i + 1]) for p, _, _ in pieces.rows for i in range(len(p) - 1)})
    rows, byte_ids, size = id_text(docs), pieces.byte_ids, size or BLOCK_BYTES
    find = re.compile(WORD).findall
    shared = docs.sparkSession.sparkContext.broadcast({p: (i, s) for p, i, s in pieces.rows})
    unknown_score, longest, max_part = pieces.unknown_score, pieces.longest, MAX_PART

    def words_in(text: str) -> list[str]:
        """The words of a text, each without the blank that begins it."""
        if not text or text[0] != " " and text[-1] != " " and "  " not in text:
            return text.split(" ") if text else []
        return [w[1:] for w in find(" " + text)]

    def dealt(parts: list[str]) -> tuple[dict[int, list[str]], dict[int, int]]:
        """The distinct parts of a block, long ones apart, by bucket, in the order of their first places (the same on both
        passes), and each bucket's sum of checksums."""
        out, sums = defaultdict(list), defaultdict(int)
        for p in dict.fromkeys(parts):
            if len(p) <= max_part:
                c = zlib.crc32(p.encode())
                out[c % buckets].append(p)
                sums[c % buckets] += c
        return out, sums

    total = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    partitions = min(total // PARTITION_TEXT + 1, MAX_PARTITIONS)
    buckets = 2 * partitions
    id_type = "smallint" if max(i for _, i, _ in pieces.rows) < 1 << 15 else "int"

    def list_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_of(block, words):
            out, _ = dealt(neighbours.parts([" " + w for w in words])[0])
            return pa.RecordBatch.from_arrays([pa.array(list(out), pa.int32()), pa.array([block] * len(out), pa.int64()),
                                               pa.array([" ".join(x) for x in out.values()], pa.string())],
                                              names=["bucket", "block", "parts"])

        current, words = None, {}  # a dictionary keeps the order
        for block, b in _blocks(batches, size):
            if block != current and words:
                yield rows_of(current, words)
                words = {}
            current = block
            for t in b.column(1):
                words.update(dict.fromkeys(words_in(t.as_py())))
        if words:
            yield rows_of(current, words)
        del words
        pa.default_memory_pool().release_unused()  # the worker lives on, idle in the lattice's stage

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for block, b in _blocks(batches, size):
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, b.schema, options=options) as w:
                w.write_batch(b)
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([out.getvalue().to_pybytes()],
                                                                                      pa.binary())],
                                             names=["block", "packed"])

    key = ["h1", "h2", "bucket", "g"]  # the hash first: sorts compare it alone
    parts = (rows.mapInArrow(list_parts, "bucket int, block long, parts string").repartition(partitions, "bucket")
             .select("bucket", "block", F.posexplode(F.split("parts", " ")).alias("at", "word"))
             .withColumn("h1", F.xxhash64("word")).withColumn("h2", F.xxhash64(F.lit(1), "word"))
             .withColumn("g", F.expr(f"block div {GROUP_TASKS << 24}")))
    parts = parts.groupBy(*key).agg(F.first("word").alias("word"), F.collect_list(F.struct("block", "at")).alias("blocks"))
    # Still together by bucket: one row a bucket and block, which names parts by their places in the block's list.
    coded = (encode_words(parts, pieces, key, ["blocks"])
             .select("bucket", F.crc32(F.col("word").cast("binary")).alias("sum"), "ids", F.explode("blocks").alias("b"))
             .select("bucket", F.col("b.block").alias("of_block"), "sum",
                     F.struct((F.col("b.at") * PLACE + F.size("ids")).alias("place"), F.col("ids").cast(f"array<{id_type}>").alias("ids"))
                     .alias("c"))
             .groupBy("of_block", "bucket").agg(F.collect_list("c").alias("c"), F.sum("sum").alias("sum"))
             .select("of_block", "bucket", "sum", F.col("c.place").alias("places"), F.flatten("c.ids").alias("ids")))

    def write(left: pa.Table, right: pa.Table) -> pa.Table:
        def packed_ids(part: str, ids) -> bytes:
            if min(ids) < 0:
                ids = [k for i in ids for k in ([i] if i >= 0 else [byte_ids[b] for b in part[-1 - i].encode()])]
            return array("i", ids).tobytes()

        def of_part(part: str) -> bytes:
            if len(part) <= max_part:
                raise KeyError(part)
            return packed_ids(part, long_path(part, shared.value, unknown_score, longest))

        number: dict[str, int] = defaultdict(count().__next__)  # of the block's distinct words
        batches = []
        for packed in left.column("packed"):
            for b in pa.ipc.open_stream(packed.as_py()):
                batches.append((b, [array("i", map(number.__getitem__, words_in(t))) for t in b.column(1).to_pylist()]))
        parts, begin = neighbours.parts([" " + w for w in number])
        (lists, sums), known = dealt(parts), {}
        for row in range(right.num_rows):
            bucket, check, places, ids = (right.column(c)[row] for c in ("bucket", "sum", "places", "ids"))
            names, places = lists[bucket.as_py()], places.values.to_numpy()
            if sums[bucket.as_py()] != check.as_py():
                raise KeyError(f"the texts of bucket {bucket} were cut differently before")
            flat, ends, at = ids.values.to_numpy().astype(np.int32), np.cumsum(places % PLACE), places // PLACE
            raw, begins = flat.tobytes(), [0, *(4 * ends[:-1]).tolist()]
            known.update(zip(map(names.__getitem__, at.tolist()), [raw[a:z] for a, z in zip(begins, (4 * ends).tolist())]))
            for i in np.unique(np.searchsorted(ends, np.flatnonzero(flat < 0), "right")).tolist():  # unknown characters
                known[names[at[i]]] = packed_ids(names[at[i]], flat[ends[i - 1] if i else 0:ends[i]].tolist())
        del right, lists
        coded_parts, begin = list(map(known.get, parts)), begin.tolist()
        if None in coded_parts:
            coded_parts = [of_part(p) if c is None else c for p, c in zip(parts, coded_parts)]
        coded_words = [b"".join(coded_parts[a:z]) for a, z in zip(begin, begin[1:])]
        del parts, coded_parts, number, known
        of_word = coded_words.__getitem__
        out = pa.concat_tables([finish(b, list(map(len, docs)), [b"".join(map(of_word, d)) for d in docs]) for b, docs in batches])
        pa.default_memory_pool().release_unused()  # the worker lives on
        return out

    texts = rows.mapInArrow(pack, "block long, packed binary")
    return (texts.groupBy("block").cogroup(coded.groupBy("of_block"))
            .applyInArrow(write, schema))


def decode_ids(ids: np.ndarray, texts: list[bytes]) -> str:
    raw = b"".join([texts[i] for i in ids.tolist()])
    return raw.decode("utf-8", "replace")[1:]  # the blank set before every text


DIGEST_SCHEMA = ("doc_id long, n_words long, n_pieces long, ids array<int>, ids_crc32 long, decoded_crc32 long, "
                 "round_trip boolean")


def digests(texts: list[bytes]) -> Finish:
    """``doc_id, n_words, n_pieces, ids, ids_crc32, decoded_crc32, round_trip`` of encoded rows.

    Checksums are of the ids as little-endian unsigned 32-bit integers and of
    the decoded text's UTF-8 bytes.
    """
    def finish(b: pa.RecordBatch, n_words: list[int], arrays: list[bytes]) -> pa.Table:
        n, crc, back, same = [], [], [], []
        for text, raw in zip(b.column(1), arrays):
            ids = np.frombuffer(raw, np.int32)
            decoded = decode_ids(ids, texts)
            n.append(len(ids))
            crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
            back.append(zlib.crc32(decoded.encode()))
            same.append(decoded == text.as_py().replace(MARK, " "))
        return pa.table({"doc_id": b.column(0), "n_words": pa.array(n_words, pa.int64()), "n_pieces": pa.array(n, pa.int64()),
                         "ids": id_lists(arrays), "ids_crc32": pa.array(crc, pa.int64()), "decoded_crc32": pa.array(back, pa.int64()),
                         "round_trip": pa.array(same, pa.bool_())})

    return finish


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``doc_id, text`` back from ``doc_id, ids``."""
    texts = Pieces.read(model).texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [decode_ids(np.asarray(x.as_py() or [], np.int64), texts) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, model: str, block_bytes: int | None = None) -> DataFrame:
    """Encode every text, decode the ids, and digest both (beside the ids: texts do not travel again).

    ``block_bytes`` (``BLOCK_BYTES``): larger blocks take fewer CPU seconds and more of a worker's memory; results are the same.
    """
    pieces = Pieces.read(model)
    return _encoded(docs, pieces, digests(pieces.texts), DIGEST_SCHEMA, block_bytes)
