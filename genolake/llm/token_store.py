"""Token ids in a chunked binary store with shuffled planes.

File format.  A store is a table of chunks (Parquet is only the container, so
Spark's commit protocol covers lost and repeated tasks).  The ids of all
documents, in ascending ``doc_id`` order and each document closed by an end
id, form one stream per shard; shard k's ids come before shard k+1's.  A chunk
holds ``CHUNK_IDS`` consecutive ids of a shard (the last may be shorter):

* ``payload``: the ids as little-endian unsigned 32-bit integers, transposed
  into 4 byte planes (or 32 bit planes), each plane compressed with zstandard
  and the planes concatenated; an all-zero plane takes no bytes;
* chunk index: ``shard, chunk, first_id`` (place in the shard), ``n_ids``,
  ``planes`` ("byte" or "bit"), ``plane_bytes`` (compressed size of each);
* document index: for every document piece in the chunk its document number
  in the shard, ``doc_id``, piece number and number of ids, so any chunk can
  be decoded, and any document found, without its neighbours.

Encoding uses the tokenizers library.  Its byte-level pre-tokenizer never
joins text across a space that follows a non-blank character, so texts are cut
there and each distinct piece is encoded once per worker (bounded cache).
Pieces of common characters are cut into pre-tokens by the pre-tokenizer's own
pattern here, all others by the library.

Defined cases: a null or empty text is one end id; a long document spans
chunks; rows with equal ``doc_id`` follow each other (by crc32, then length);
an empty table gives an empty store; extra columns are ignored.
"""

from __future__ import annotations

import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genolake.session import scratch_path

from .common import id_text, partition_offsets, spread_salt

CHUNK_IDS = 1 << 16
CACHE_PIECES, CACHE_WORDS = 1_000_000, 600_000
_CUT = re.compile(r"(?<=\S)(?= )")
_SPACES = [chr(c) for c in range(0x3001) if chr(c).isspace()]
# The byte-level pre-tokenizer's pattern over characters whose classes never changed: Latin letters, digits, ASCII signs, blanks.
_LETTERS, _SIGNS, _BLANKS = "A-Za-zÀ-ÖØ-öø-ɏ", r"!-/:-@\[-`{-~", r" \n\r\t"
_PRE_TOKENS = re.compile(f"'(?:[sdmt]|ll|ve|re)| ?[{_LETTERS}]+| ?[0-9]+| ?[{_SIGNS}]+|[{_BLANKS}]+(?![^{_BLANKS}])|[{_BLANKS}]+")
# The byte letters of bytes that are no printable characters, by the library's rule: the n-th of them is U+0100 + n.
_SHOWN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_LETTERS = {b: 0x100 + n for n, b in enumerate(b for b in range(256) if b not in _SHOWN)}


def blanks_meet(text: str) -> bool:
    """Whether a space follows another blank."""
    return any(c in text and c + " " in text for c in _SPACES)


class WordIds(dict):
    """Ids (packed) of a pre-token: its text, or after a NUL its byte letters. Pieces with other punctuation share it."""

    def __init__(self, model, dtype):
        super().__init__()
        self.tokenize, self.code = model.tokenize, "H" if dtype.itemsize == 2 else "I"

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        letters = word[1:] if word[0] == "\0" else word.encode().decode("latin-1").translate(_BYTE_LETTERS)
        out = self[word] = array(self.code, [t.id for t in self.tokenize(letters)]).tobytes()
        return out


class PieceIds(dict):
    """Ids (packed) of a text piece that follows a space, computed once by the library."""

    def __init__(self, tokenizer, dtype):
        super().__init__()
        self.pre, self.words = tokenizer.pre_tokenizer.pre_tokenize_str, WordIds(tokenizer.model, dtype)
        kind = repr(tokenizer.pre_tokenizer)
        self.own = kind.startswith("ByteLevel(") and "add_prefix_space=False" in kind and "use_regex=True" in kind

    def pre_tokens(self, piece: str) -> list[str]:
        """The pre-tokens of ``piece``, as ``WordIds`` takes them."""
        if self.own:
            out = _PRE_TOKENS.findall(piece)
            if sum(map(len, out)) == len(piece):  # only common characters
                return out
        return ["\0" + w for w, _ in self.pre(piece)]

    def encode(self, piece: str) -> bytes:
        """``piece`` as it stands, through pre-tokenizer and model."""
        return b"".join(map(self.words.__getitem__, self.pre_tokens(piece)))

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHE_PIECES:
            self.clear()
        if piece.isascii() and piece.isalpha():  # one pre-token
            out = self.words[" " + piece]
        else:
            out = self.encode(" " + piece)
        self[piece] = out
        return out


class Encoder:
    """Whole texts to ids, equal to the library's ``encode(text, add_special_tokens=False)``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.normalizer is not None or "ByteLevel" not in repr(self.tokenizer.pre_tokenizer):
            raise ValueError("the piece cache needs a byte-level pre-tokenizer without normalizer")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.pieces = PieceIds(self.tokenizer, self.dtype)

    def ids(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype)
        if blanks_meet(text):
            first, *rest = _CUT.split(text)
            rest = [p[1:] for p in rest]
        else:
            first, *rest = text.split(" ")
        packed = b"".join(map(self.pieces.__getitem__, rest))
        return np.frombuffer(self.pieces.encode(first) + packed if first else packed, self.dtype)


def worker_encoder(path: str) -> Encoder:
    """One encoder per worker process, kept across its tasks."""
    kept = sys.__dict__.setdefault("_genolake_encoders", {})
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def pack(ids: np.ndarray, planes: str = "byte", level: int = 1) -> tuple[list[int], bytes]:
    """Compressed size of each plane, and the planes."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8)
    if planes == "byte":
        rows = raw.reshape(-1, 4).T
    else:
        rows = np.packbits(np.unpackbits(raw.reshape(-1, 4), axis=1, bitorder="little").T, axis=1, bitorder="little")
    z = zstandard.ZstdCompressor(level=level)
    parts = [z.compress(np.ascontiguousarray(r).tobytes()) if r.any() else b"" for r in rows]
    return [len(p) for p in parts], b"".join(parts)


def unpack(payload: bytes, plane_bytes: list[int], n: int, planes: str = "byte") -> np.ndarray:
    size = n if planes == "byte" else (n + 7) // 8
    z, rows, at = zstandard.ZstdDecompressor(), [], 0
    for k in plane_bytes:
        rows.append(np.frombuffer(z.decompress(payload[at:at + k]), np.uint8) if k else np.zeros(size, np.uint8))
        at += k
    cube = np.stack(rows)
    if planes == "byte":
        return np.ascontiguousarray(cube.T).reshape(-1).view("<u4")
    bits = np.unpackbits(cube, axis=1, count=n, bitorder="little")
    return np.packbits(bits.T, axis=1, bitorder="little").reshape(-1).view("<u4")


_CHUNK = pa.schema([
    ("shard", pa.int32()), ("chunk", pa.int32()), ("first_id", pa.int64()), ("n_ids", pa.int32()),
    ("planes", pa.string()), ("plane_bytes", pa.list_(pa.int32())),
    ("doc_nos", pa.list_(pa.int64())), ("doc_ids", pa.list_(pa.int64())),
    ("piece_nos", pa.list_(pa.int32())), ("piece_ids", pa.list_(pa.int32())), ("payload", pa.binary())])
CHUNK_SCHEMA = ("shard int, chunk int, first_id long, n_ids int, planes string, plane_bytes array<int>, "
                "doc_nos array<long>, doc_ids array<long>, piece_nos array<int>, piece_ids array<int>, payload binary")


def _chunks(shard: int, docs: Iterator[tuple[int, np.ndarray]], chunk_ids: int, planes: str) -> Iterator[dict]:
    """Chunk rows of one shard from its documents' ids in order."""
    no, at, buffer, pieces = 0, 0, [], []
    held = 0

    def close() -> dict:
        sizes, payload = pack(np.concatenate(buffer), planes)
        doc_nos, doc_ids, piece_nos, piece_ids = zip(*pieces)
        return {"shard": shard, "chunk": at // chunk_ids, "first_id": at, "n_ids": held, "planes": planes,
                "plane_bytes": sizes, "doc_nos": doc_nos, "doc_ids": doc_ids, "piece_nos": piece_nos,
                "piece_ids": piece_ids, "payload": payload}

    for no, (doc_id, ids) in enumerate(docs):
        piece = 0
        while len(ids):
            part, ids = ids[:chunk_ids - held], ids[chunk_ids - held:]
            buffer.append(part)
            pieces.append((no, doc_id, piece, len(part)))
            piece, held = piece + 1, held + len(part)
            if held == chunk_ids:
                yield close()
                at, held, buffer, pieces = at + held, 0, [], []
    if held:
        yield close()


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, planes: str = "byte",
                chunk_ids: int = CHUNK_IDS) -> None:
    """Encode every text of ``docs`` and write the store (one range shuffle on ``doc_id``)."""
    text = F.col("text").cast("binary")
    keys = ["doc_id", "_crc", "_len", "_salt"]
    placed = (id_text(docs).withColumn("_crc", F.crc32(text)).withColumn("_len", F.length(text))
              .withColumn("_salt", spread_salt(1024))
              .repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = worker_encoder(tokenizer)

        def rows():
            for b in batches:
                for doc_id, t in zip(b.column(0), b.column(1)):
                    yield doc_id.as_py(), np.append(encoder.ids(t.as_py()).astype("<u4"), np.uint32(end_id))

        for row in _chunks(TaskContext.get().partitionId(), rows(), chunk_ids, planes):
            yield pa.RecordBatch.from_pylist([row], schema=_CHUNK)

    placed.mapInArrow(encode, CHUNK_SCHEMA).write.option("compression", "uncompressed").parquet(path)


def crc_combine(a: int, b: int, n: int) -> int:
    """crc32 of two byte strings joined, from their crc32s and the second's length (GF(2) matrices)."""
    def times(m, v):
        out, i = 0, 0
        while v:
            if v & 1:
                out ^= m[i]
            v, i = v >> 1, i + 1
        return out

    step = [0xEDB88320] + [1 << i for i in range(31)]  # one zero bit
    for _ in range(3):
        step = [times(step, c) for c in step]  # one zero byte
    while n:
        if n & 1:
            a = times(step, a)
        n >>= 1
        if n:
            step = [times(step, c) for c in step]
    return a ^ b


def read_pieces(spark, path: str) -> DataFrame:
    """Every document piece of a store, decoded: its ids, place and checksum."""
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                ids = unpack(r["payload"], r["plane_bytes"], r["n_ids"], r["planes"])
                ends = np.cumsum(r["piece_ids"], dtype=np.int64)
                starts = ends - r["piece_ids"]
                crc = [zlib.crc32(ids[a:z].tobytes()) for a, z in zip(starts, ends)]
                n = len(ends)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["shard"]] * n, pa.int32()), pa.array(r["doc_nos"], pa.int64()),
                     pa.array(r["doc_ids"], pa.int64()), pa.array(r["piece_nos"], pa.int32()),
                     pa.array(starts + r["first_id"]), pa.array(r["piece_ids"], pa.int64()),
                     pa.array(crc, pa.int64())],
                    names=["shard", "doc_no", "doc_id", "piece_no", "at", "n", "crc"])

    schema = "shard int, doc_no long, doc_id long, piece_no int, at long, n long, crc long"
    return spark.read.schema(CHUNK_SCHEMA).parquet(path).mapInArrow(decode, schema)


def read_ids(spark, path: str) -> DataFrame:
    """``shard, doc_no, doc_id, piece_no, ids``: the stored ids themselves, piece by piece."""
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                ids = unpack(r["payload"], r["plane_bytes"], r["n_ids"], r["planes"]).astype(np.int64)
                parts = np.split(ids, np.cumsum(r["piece_ids"])[:-1])
                n = len(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["shard"]] * n, pa.int32()), pa.array(r["doc_nos"], pa.int64()),
                     pa.array(r["doc_ids"], pa.int64()), pa.array(r["piece_nos"], pa.int32()),
                     pa.array(parts, pa.list_(pa.int64()))],
                    names=["shard", "doc_no", "doc_id", "piece_no", "ids"])

    return spark.read.schema(CHUNK_SCHEMA).parquet(path).mapInArrow(
        decode, "shard int, doc_no long, doc_id long, piece_no int, ids array<long>")


def read_digests(spark, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the stored chunks."""
    index = spark.read.schema(CHUNK_SCHEMA).parquet(path).select(F.col("shard").alias("_pid"), "n_ids")
    offsets, _ = partition_offsets(index.groupBy("_pid").agg(F.sum("n_ids").alias("_n")))

    @F.pandas_udf("long")
    def joined(pieces: pd.Series) -> pd.Series:
        out = []
        for parts in pieces:
            crc = None
            for p in parts if parts is not None else ():
                crc = p["crc"] if crc is None else crc_combine(crc, p["crc"], 4 * p["n"])
            out.append(crc)
        return pd.Series(out, dtype="Int64")

    docs = read_pieces(spark, path).groupBy("shard", "doc_no", "doc_id").agg(
        F.min("at").alias("_at"), F.sum("n").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("piece_no", "n", "crc"))).alias("_pieces"))
    return (docs.join(F.broadcast(offsets), docs["shard"] == offsets["_pid"])
            .select("doc_id", (F.col("_off") + F.col("_at")).alias("start"), "n_tokens",
                    F.coalesce(F.when(F.size("_pieces") == 1, F.col("_pieces")[0]["crc"]),
                               joined(F.when(F.size("_pieces") > 1, F.col("_pieces")))).alias("ids_crc32")))


def stored_token_digests(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write the store to the shared scratch folder, then read every document back from it."""
    path = scratch_path(docs.sparkSession, "token-store")
    write_store(docs, path, tokenizer, end_id)
    return read_digests(docs.sparkSession, path)
