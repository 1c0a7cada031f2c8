"""Exact substring dedup: remove bytes covered by a long string that starts earlier.

A byte goes when it lies in a string of ``length`` bytes that also starts
earlier in the corpus (smaller ``doc_id``, or same document and earlier
start); matches never cross documents and are judged on the input.

1. Cutting.  Every window of ``length`` bytes has an anchor: its least 16-byte
   substring under a hash order (leftmost on ties).  Equal windows have equal
   anchors at equal offsets, so a text is cut into segments of consecutive
   windows with one anchor, about 140 bytes each, and equal windows lie in
   segments of one anchor.  Anchors that a fixed-size sketch finds frequent
   are joined by a second anchor under another order, so the surroundings of a
   passage that millions of documents share spread over keys.
2. Copies of one whole segment (equal 64-bit anchor and 64-bit digest) are
   folded, first inside a map task, then per anchor: all but the earliest go.
   Anchors left with a single segment have no other match and stop here.
3. Suffix-array shards.  The remaining segments travel by anchor and are
   packed into shards of about ``SHARD_BYTES``.  Each shard's suffix array is
   induced (see ``suffix_array``); runs of it with a permuted common prefix of
   at least ``length`` are sets of equal windows, of which the earliest stays.
4. An anchor with more than ``SHARD_BYTES`` of segments (the edges of a passage
   that very many documents share) is dealt over as many shards as that takes.
   Each also lists the earliest place of every window it holds, by 128-bit
   digest; of a digest listed by several shards all but the earliest go.
5. The removed ranges of a document are merged and cut from its bytes.

Defined cases: a null text is empty; texts shorter than ``length`` lose
nothing; rows of one ``doc_id`` with equal text count as one document (both
get the same result), with different texts as documents ordered by a hash of
the text; a null ``doc_id`` sorts before all others; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 (pa.compute)
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, unused
from .sketch import frequency_levels, slot
from .suffix_array import permuted_lcp, suffix_array

LENGTH = 100
GRAM = 16
BLOCK_BYTES = 2_000_000
SHARD_BYTES = 2_000_000
ANCHOR_BYTES = 64_000
AT_ONCE = 1 << 15  # positions: their arrays stay in a core's cache
_POS_BITS = 24
_ODD = [np.uint64(v) for v in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def gram_hashes(x: np.ndarray) -> np.ndarray:
    """64-bit hash of the 16 bytes at every position (those inside the array)."""
    n = max(len(x) - GRAM + 1, 0)
    out = np.empty(n, np.uint64)
    for lo in range(0, n, AT_ONCE):
        hi = min(lo + AT_ONCE, n)
        h = x[lo:hi + GRAM - 1].astype(np.uint64) + np.uint64(1)
        for i, odd in enumerate(_ODD):
            step = 1 << i
            h = h[:-step] * odd + h[step:]
            h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        out[lo:hi] = h ^ (h >> np.uint64(32))
    return out


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Position of the least hash in each run of ``width`` (leftmost on ties)."""
    n = len(h) - width + 1
    out = np.empty(n, np.int64)
    for lo in range(0, n, AT_ONCE):
        hi = min(lo + AT_ONCE, n)
        least = h[lo:hi + width - 1] & ~np.uint64((1 << _POS_BITS) - 1)
        least |= np.arange(lo, hi + width - 1, dtype=np.uint64)
        run = 1  # each entry is the least of the run that begins at it
        while run < width:
            step = min(run, width - run)
            least = np.minimum(least[:-step], least[step:])
            run += step
        out[lo:hi] = least & np.uint64((1 << _POS_BITS) - 1)
    return out


def cut(x: np.ndarray, sizes: np.ndarray, length: int, level: np.ndarray | None):
    """Segments of a block of joined documents: (key, document, start in the block, bytes).

    ``level`` (sketch levels) marks frequent anchors; None: anchors alone are wanted.
    """
    h = gram_hashes(x)
    width = length - GRAM + 1
    if len(h) < width:
        z = np.empty(0, np.int64)
        return z.astype(np.uint64), z, z, z
    at = _least(h, width)
    n = len(at)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    valid = np.ones(n, bool)
    for a, z in zip(np.maximum(begins, ends - length + 1).tolist(), ends.tolist()):
        valid[a:z] = False
    new = np.ones(n, bool)
    np.not_equal(at[1:], at[:-1], out=new[1:])
    if level is not None and (level[slot(h[at[new]])] > 0).any():  # an anchor is looked up once a run
        key = h[at]
        hot = level[slot(key)] > 0
        other = _least((h ^ np.uint64(0x5851F42D4C957F2D)) * np.uint64(0x2545F4914F6CDD1D), width)
        key = np.where(hot, (key ^ (h[other] >> np.uint64(7))) * _ODD[1] + h[other], key)
        mark = np.where(hot, (at + 1) * (1 << _POS_BITS) + other, at)
        np.not_equal(mark[1:], mark[:-1], out=new[1:])
    else:
        key = None
    new[1:] |= ~valid[:-1]
    new[begins[begins < n]] = True
    first = np.flatnonzero(new & valid)
    bound = np.flatnonzero(new | ~valid)
    nxt = np.append(bound, n)[np.searchsorted(bound, first, side="right")]
    doc = np.searchsorted(ends, first, side="right")
    return h[at[first]] if key is None else key[first], doc, first, nxt - first + length - 1


def anchor_keys(texts: Iterable[str], length: int) -> Iterator[np.ndarray]:
    """The anchors of all segments; short documents are cut many at a time."""
    held, size = [], 0
    for t in texts:
        for _, p in _pieces(t.encode(), length):
            if held and size + len(p) > ANCHOR_BYTES:
                yield _joined_keys(held, length)
                held, size = [], 0
            held.append(p)
            size += len(p)
    if held:
        yield _joined_keys(held, length)


def _joined_keys(parts: list[bytes], length: int) -> np.ndarray:
    return cut(np.frombuffer(b"".join(parts), np.uint8), np.array([len(p) for p in parts], np.int64), length, None)[0]


def merged(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of ranges as maximal disjoint runs, ascending."""
    if not len(lo):
        return lo, hi
    o = np.argsort(lo, kind="stable")
    lo, hi = lo[o], np.maximum.accumulate(hi[o])
    new = np.concatenate([[True], lo[1:] > hi[:-1]])
    ends = np.append(np.flatnonzero(new)[1:] - 1, len(lo) - 1)
    return lo[new], hi[ends]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list[bytes]]]:
    """Documents of a task in blocks of about ``BLOCK_BYTES`` (a longer document alone)."""
    ids, tags, texts, size = [], [], [], 0
    for b in batches:
        for i, t, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            raw = x.as_py()
            if texts and size + len(raw) > BLOCK_BYTES:
                yield ids, tags, texts
                ids, tags, texts, size = [], [], [], 0
            ids.append(i)
            tags.append(t)
            texts.append(raw)
            size += len(raw)
    if texts:
        yield ids, tags, texts


def _pieces(raw: bytes, length: int) -> Iterator[tuple[int, bytes]]:
    """A document in parts small enough to index, overlapping so that every window lies in one part."""
    step = (1 << _POS_BITS) - 4 * length
    for at in range(0, max(len(raw) - length + 1, 1), step):
        yield at, raw[at:at + step + length - 1]


def identified(docs: DataFrame) -> DataFrame:
    """``doc_id, tag, raw``: bytes of every row; the tag tells apart different texts of one id."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(raw).alias("tag"), raw.alias("raw"))


_ROW = ["key", "seg", "doc_id", "tag", "start", "size"]
_ROW_SCHEMA = "key long, seg long, doc_id long, tag long, start long, size int"


NULL_ID = -(1 << 63)


def segment_rows(docs: DataFrame, level: np.ndarray, length: int) -> DataFrame:
    """Segments of all documents (``seg`` set, the task's earliest of equal ones) and ranges already known to go."""
    shared = docs.sparkSession.sparkContext.broadcast(level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        lv = shared.value
        for ids, tags, texts in _blocks(batches):
            parts = [(d, at, p) for d, raw in enumerate(texts) for at, p in _pieces(raw, length)]
            cols = [[] for _ in range(5)]
            groups = [parts] if sum(len(p) for _, _, p in parts) < 1 << _POS_BITS else [[p] for p in parts]
            for group in groups:
                raw = b"".join(p for _, _, p in group)
                sizes = np.array([len(p) for _, _, p in group], np.int64)
                key, part, first, size = cut(np.frombuffer(raw, np.uint8), sizes, length, lv)
                offset = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                owner, base = (np.array([g[i] for g in group], np.int64) for i in (0, 1))
                seg = np.array([digest(raw[a:a + n]) for a, n in zip(first.tolist(), size.tolist())], np.uint64)
                for c, v in zip(cols, (key.view(np.int64), seg.view(np.int64), owner[part],
                                       first - offset[part] + base[part], size)):
                    c.append(v)
            key, seg, doc, start, size = (np.concatenate(c) for c in cols)
            id_col = np.array([NULL_ID if i is None else i for i in ids], np.int64)[doc]
            tag_col = np.array(tags, np.int64)[doc]
            o = np.lexsort((start, tag_col, id_col, seg, key))
            key, seg, start, size, id_col, tag_col = (v[o] for v in (key, seg, start, size, id_col, tag_col))
            head = np.ones(len(key), bool)
            head[1:] = (key[1:] != key[:-1]) | (seg[1:] != seg[:-1])
            first_at = np.flatnonzero(head)[np.cumsum(head) - 1] if len(head) else np.empty(0, np.int64)
            itself = (id_col == id_col[first_at]) & (tag_col == tag_col[first_at]) & (start == start[first_at])
            gone = ~head & ~itself
            if head.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[head]) for c in (key, seg, id_col, tag_col, start, size.astype(np.int32))], names=_ROW)
            if gone.any():
                i, t, a, z = _merge_by_doc(id_col[gone], tag_col[gone], start[gone], start[gone] + size[gone])
                k = len(i)
                spread = pa.array((a * 0x9E3779B1 + i) % 1009)
                # A range already known to go: no digest; its key only spreads the rows.
                yield pa.RecordBatch.from_arrays(
                    [spread, pa.nulls(k, pa.int64()), pa.array(i), pa.array(t), pa.array(a),
                     pa.array((z - a).astype(np.int32))], names=_ROW)

    return identified(docs).mapInArrow(run, _ROW_SCHEMA)


def _merge_by_doc(ids, tags, lo, hi):
    """Merged ranges per (id, tag), as flat columns."""
    o = np.lexsort((lo, tags, ids))
    ids, tags, lo, hi = ids[o], tags[o], lo[o], hi[o]
    cutp = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1])]))
    out = [[], [], [], []]
    for a, z in zip(cutp, np.append(cutp[1:], len(ids))):
        x, y = merged(lo[a:z], hi[a:z])
        for c, v in zip(out, (np.full(len(x), ids[a]), np.full(len(x), tags[a]), x, y)):
            c.append(v)
    return tuple(np.concatenate(c) for c in out)


_FOLDED_SCHEMA = "kind int, key long, doc_id long, tag long, start long, size int"


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, seg, position): kind 0, ranges to go; kind 1, segments for a suffix array.

    Of equal segments the first is the earliest; the others go.  A first
    segment is wanted when its key has another one.  State: one row.
    """
    names = ["kind", "key", "doc_id", "tag", "start", "size"]

    def out(kind, rows):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(rows[0]), kind, np.int32))]
                                          + [pa.array(r) for r in rows], names=names)

    head = None  # the earliest row of the segment in progress, as [values], and whether it was sent
    sent = False
    for b in batches:
        if not b.num_rows:
            continue
        known = b.filter(pa.compute.is_null(b.column(1)))
        if known.num_rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(known.num_rows, np.int32))] + [known.column(i) for i in (0, 2, 3, 4, 5)], names=names)
        b = b.filter(pa.compute.is_valid(b.column(1)))
        if not b.num_rows:
            continue
        cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
        carried = head is not None
        if carried:
            cols = [np.concatenate([np.array([h], c.dtype), c]) for h, c in zip(head, cols)]
        key, seg, ids, tags, start, size = cols
        first = np.ones(len(key), bool)
        first[1:] = (key[1:] != key[:-1]) | (seg[1:] != seg[:-1])
        heads = np.flatnonzero(first)
        mine = heads[np.cumsum(first) - 1]
        gone = ~first & ~((ids == ids[mine]) & (tags == tags[mine]) & (start == start[mine]))
        if gone.any():
            yield out(0, [c[gone] for c in (key, ids, tags, start, size)])
        hk = key[heads]
        pair = np.zeros(len(heads), bool)
        pair[1:] = hk[1:] == hk[:-1]
        pair[:-1] |= pair[1:].copy()
        if carried and sent:
            pair[0] = False
        if pair.any():
            w = heads[pair]
            yield out(1, [c[w] for c in (key, ids, tags, start, size)])
        last = heads[-1]
        was_sent = (sent if carried and last == 0 else False) or bool(pair[-1])
        # A key whose earlier segments were sent must send its next one too: pair compares with the carried head.
        head, sent = [c[last] for c in cols], was_sent


def dealt_segments(wanted: DataFrame) -> DataFrame:
    """``wanted`` with ``part``: -1, or for an over-full key one of as many parts as keep each near ``SHARD_BYTES``."""
    total = wanted.groupBy("key").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > SHARD_BYTES)
    # At most one row for every SHARD_BYTES of segments.
    large = F.broadcast(total.select("key", F.ceil(F.col("bytes") / SHARD_BYTES).alias("parts")))
    part = F.coalesce(F.pmod(F.xxhash64("doc_id", "tag", "start"), F.col("parts")), F.lit(-1)).cast("int")
    return wanted.join(large, "key", "left").withColumn("part", part).drop("parts")


def segment_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``key, part, doc_id, tag, start, bytes`` of the wanted segments, cut from their documents."""
    spots = wanted.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("key", "part", "start", "size")).alias("spots"))
    dictionary = text_dictionary(docs)
    once = packed_texts(docs, dictionary).dropDuplicates(["doc_id", "tag"])
    rows = once.join(spots, ["doc_id", "tag"]).select("doc_id", "tag", "packed", "spots")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdDecompressor(**_shared(dictionary))
        for b in batches:
            for i in range(b.num_rows):
                raw = z.decompress(b.column(2)[i].as_py())
                s = b.column(3)[i].values
                key, part, start, size = (s.field(k) for k in range(4))
                pieces = [raw[a:a + n] for a, n in zip(start.to_pylist(), size.to_pylist())]
                k = len(pieces)
                yield pa.RecordBatch.from_arrays(
                    [key, part, pa.array([b.column(0)[i].as_py()] * k, pa.int64()),
                     pa.array([b.column(1)[i].as_py()] * k, pa.int64()), start, pa.array(pieces, pa.binary())],
                    names=["key", "part", "doc_id", "tag", "start", "bytes"])

    return rows.mapInArrow(run, "key long, part int, doc_id long, tag long, start long, bytes binary")


SAMPLE_TEXTS, SAMPLE_BYTES, DICTIONARY_BYTES = 2_000, 8_000, 64_000


def text_dictionary(docs: DataFrame) -> bytes:
    """What the texts have in common, for their compressor: learned from the beginnings of a few (empty if too few)."""
    rows = docs.select(F.substring(F.coalesce(F.col("text"), F.lit("")), 1, SAMPLE_BYTES).alias("t")).limit(SAMPLE_TEXTS).collect()
    sample = [r["t"].encode() for r in rows if r["t"]]
    if sum(map(len, sample)) < 20 * DICTIONARY_BYTES:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample).as_bytes()
    except zstandard.ZstdError:  # nothing in common
        return b""


def _shared(dictionary: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}


def packed_texts(docs: DataFrame, dictionary: bytes) -> DataFrame:
    """``doc_id, tag, packed``: compressed bytes of every row, for a shuffle by document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=6, **_shared(dictionary))
        for b in batches:
            ids = [NULL_ID if i is None else i for i in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), b.column(1), pa.array([z.compress(x.as_py()) for x in b.column(2)],
                                                                  pa.binary())], names=["doc_id", "tag", "packed"])

    return identified(docs).mapInArrow(run, "doc_id long, tag long, packed binary")


def repeated_windows(pieces: list[bytes], order: np.ndarray, length: int,
                     firsts: bool = False) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per piece, offsets of windows that also start at an earlier place, and (with ``firsts``) of those that do not.

    ``order``: one ascending-by-place number per piece times 2^32, plus its
    start; a window's place is that number plus its offset.
    """
    x = np.frombuffer(b"\xff".join(pieces) + b"\xff", np.uint8)  # 0xFF occurs in no UTF-8 text
    size = np.array([len(p) for p in pieces], np.int64)
    begin = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
    sa = suffix_array(x)
    common = permuted_lcp(x, sa)[sa]
    run = np.cumsum(common < length)
    piece = np.repeat(np.arange(len(pieces)), size + 1)
    whole = np.arange(len(x)) + length <= (begin + size)[piece]
    take = whole[sa]
    pos, run = sa[take].astype(np.int64), run[take]
    if not len(pos):
        none = [np.empty(0, np.int64) for _ in pieces]
        return none, none
    place = order[piece[pos]] + (pos - begin[piece[pos]])
    new = np.concatenate([[True], run[1:] != run[:-1]])
    earliest = np.minimum.reduceat(place, np.flatnonzero(new))[np.cumsum(new) - 1]

    def by_piece(found: np.ndarray) -> list[np.ndarray]:
        found = np.sort(found)
        cuts = np.searchsorted(found, begin)
        return [found[a:z] - b for a, z, b in zip(cuts, np.append(cuts[1:], len(found)), begin)]

    return by_piece(pos[place > earliest]), by_piece(pos[place == earliest]) if firsts else []


_SHARD_SCHEMA = "digest long, digest2 long, doc_id long, tag long, lo long, hi long"


def _shards(length: int):
    """Segments sorted by key and part to ranges that go, through one suffix array per shard of whole parts.

    A part of a key also lists its windows that stay, with their digests.
    """

    def solve(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        ids, tags, starts = (np.array([r[i] for r in rows], np.int64) for i in (2, 3, 4))
        o = np.lexsort((tags, ids))
        new = np.concatenate([[False], (ids[o][1:] != ids[o][:-1]) | (tags[o][1:] != tags[o][:-1])])
        rank = np.empty(len(rows), np.int64)
        rank[o] = np.cumsum(new)
        found, firsts = repeated_windows([r[5] for r in rows], (rank << 33) + starts, length,
                                         any(r[1] >= 0 for r in rows))
        out = [[], [], [], []]
        for i, offs in enumerate(found):
            if len(offs):
                lo, hi = merged(starts[i] + offs, starts[i] + offs + length)
                for c, v in zip(out, (np.full(len(lo), ids[i]), np.full(len(lo), tags[i]), lo, hi)):
                    c.append(v)
        cols = [np.concatenate(c) if c else np.empty(0, np.int64) for c in out]
        none = pa.nulls(len(cols[0]), pa.int64())
        names = ["digest", "digest2", "doc_id", "tag", "lo", "hi"]
        yield pa.RecordBatch.from_arrays([none, none] + [pa.array(c) for c in cols], names=names)
        digest = xxhash.xxh3_128_digest
        raw, out = [], [[], [], []]
        for i, offs in enumerate(firsts):
            if rows[i][1] >= 0 and len(offs):
                raw += [digest(rows[i][5][a:a + length]) for a in offs.tolist()]
                for c, v in zip(out, (np.full(len(offs), ids[i]), np.full(len(offs), tags[i]), starts[i] + offs)):
                    c.append(v)
        if raw:
            d = np.frombuffer(b"".join(raw), np.int64).reshape(-1, 2)
            i, t, lo = (np.concatenate(c) for c in out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(c)) for c in (d[:, 0], d[:, 1], i, t, lo, lo + length)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if row[:2] != last and size >= SHARD_BYTES:
                    yield from solve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[5])
                last = row[:2]
        if held:
            yield from solve(held)

    return run


def removed_ranges(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, tag, lo, hi``: byte ranges to remove (overlaps possible; null ids as the least long)."""
    if length < GRAM:
        raise ValueError(f"length must be at least {GRAM}")

    level = frequency_levels(docs, lambda texts: anchor_keys(texts, length))
    rows = segment_rows(docs, level, length).repartition("key").sortWithinPartitions(*_ROW[:5])
    folded = stored(rows.mapInArrow(_fold, _FOLDED_SCHEMA), "segments", "zstd")
    known = folded.where("kind = 0").select("doc_id", "tag", F.col("start").alias("lo"),
                                            (F.col("start") + F.col("size")).alias("hi"))
    texts = segment_texts(docs, dealt_segments(folded.where("kind = 1")))
    found = stored(texts.repartition("key", "part").sortWithinPartitions("key", "part", "doc_id", "tag", "start")
                   .mapInArrow(_shards(length), _SHARD_SCHEMA), "shards", "zstd")
    # The windows that parts of one key list are folded like segments: a digest has one row per part at most.
    windows = found.where("digest IS NOT NULL").select(
        F.col("digest").alias("key"), F.col("digest2").alias("seg"), "doc_id", "tag", F.col("lo").alias("start"),
        F.lit(length).alias("size"))
    across = (windows.repartition("key", "seg").sortWithinPartitions(*_ROW[:5]).mapInArrow(_fold, _FOLDED_SCHEMA)
              .where("kind = 0").select("doc_id", "tag", F.col("start").alias("lo"),
                                        (F.col("start") + F.col("size")).alias("hi")))
    within = found.where("digest IS NULL").select("doc_id", "tag", "lo", "hi")
    return stored(known.unionByName(within).unionByName(across), "removed", "zstd")


def dedup_substrings(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (remaining bytes) and ``spans`` for every row of ``docs``."""
    ranges = removed_ranges(docs, length).groupBy("doc_id", "tag").agg(
        F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    dictionary = text_dictionary(docs)
    rows = packed_texts(docs, dictionary).join(ranges, ["doc_id", "tag"], "left").select("doc_id", "packed", "ranges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdDecompressor(**_shared(dictionary))
        for b in batches:
            ids, total, removed, spans, kept = [], [], [], [], []
            for i in range(b.num_rows):
                raw = z.decompress(b.column(1)[i].as_py())
                r = b.column(2)[i]
                lo = hi = np.empty(0, np.int64)
                if r.is_valid:
                    lo, hi = merged(*(r.values.field(k).to_numpy() for k in (0, 1)))
                edges = [0, *np.stack([lo, hi], 1).ravel().tolist(), len(raw)]
                ids.append(None if b.column(0)[i].as_py() == NULL_ID else b.column(0)[i].as_py())
                total.append(len(raw))
                removed.append(int((hi - lo).sum()))
                spans.append([{"lo": a, "hi": e} for a, e in zip(lo.tolist(), hi.tolist())])
                kept.append(b"".join(raw[a:e] for a, e in zip(edges[::2], edges[1::2])))
            span = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, span), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    out = rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, spans array<struct<lo:long,hi:long>>, kept binary")
    return out.withColumn("n_spans", F.size("spans").cast("long"))


def cut_texts(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs``, all columns, with the repeated bytes cut from ``text`` (a character cut in part goes whole)."""
    i, t, found_in, mine, mine_tag = unused(docs, "_id", "_tag", "_ranges", "_own", "_own_tag")
    ranges = removed_ranges(docs, length).groupBy("doc_id", "tag").agg(
        F.collect_list(F.struct("lo", "hi")).alias(found_in))
    ranges = ranges.select(F.col("doc_id").alias(i), F.col("tag").alias(t), found_in)

    @F.arrow_udf("string")
    def cut_out(text: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for t, r in zip(text, found):
            raw = t.as_py()
            if r.is_valid and raw is not None:
                raw = raw.encode()
                lo, hi = merged(*(r.values.field(k).to_numpy() for k in (0, 1)))
                edges = [0, *np.stack([lo, hi], 1).ravel().tolist(), len(raw)]
                raw = b"".join(raw[a:e] for a, e in zip(edges[::2], edges[1::2])).decode("utf-8", "ignore")
            out.append(raw)
        return pa.array(out, pa.string())

    tag = F.xxhash64(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    own = F.coalesce(docs["doc_id"].cast("long"), F.lit(NULL_ID))
    joined = docs.withColumn(mine, own).withColumn(mine_tag, tag).join(
        ranges, (F.col(mine) == F.col(i)) & (F.col(mine_tag) == F.col(t)), "left")
    return joined.withColumn("text", cut_out("text", found_in)).select(*docs.columns)


def dedup_digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    return dedup_substrings(docs, length).select("doc_id", "n_bytes", "n_removed", "n_spans",
                                                 F.sha2("kept", 256).alias("kept_sha256"))
