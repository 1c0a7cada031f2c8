"""Reproducible shuffle and sharding by a Feistel permutation.

Rows get a dense global number in ``(doc_id, crc32, size)`` order.  A balanced
Feistel network over the smallest even number of bits that holds the row
count permutes ``[0, 2^bits)``; values beyond the last row walk on through the
network until they fall inside (cycle walking), which makes the map a
permutation of exactly the row numbers.  Shard and slot follow by arithmetic:
``shard = p mod shards``, ``slot = p div shards``, so shard sizes differ by at
most one row and any row's place can be computed, or inverted, without a
table.

Null text: size 1, crc32 0.  Repeated rows each get a number of their own
(they are interchangeable).  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered

ROUNDS = 6
MULT_A, MULT_B, KEY_STEP, WORD = 0x9E3779B1, 0x85EBCA6B, 0x632BE5AB, 0xFFFFFFFF


def half_bits(n: int) -> int:
    """Half the width of the network: ``4**half_bits >= n``."""
    return max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)


def round_key(seed: int, i: int) -> int:
    return (seed * MULT_A + (i + 1) * KEY_STEP) & WORD


def _round(x: np.ndarray, key: int, mask: int) -> np.ndarray:
    x = (x * np.uint64(MULT_A) + np.uint64(key)) & np.uint64(WORD)
    x ^= x >> np.uint64(15)
    x = (x * np.uint64(MULT_B)) & np.uint64(WORD)
    return (x ^ (x >> np.uint64(13))) & np.uint64(mask)


def permute(rows: np.ndarray, n: int, seed: int, inverse: bool = False) -> np.ndarray:
    """Place of each row number in the shuffle of ``n`` rows (or back)."""
    if n > 1 << 62:
        raise ValueError("too many rows")
    h = half_bits(n)
    mask = (1 << h) - 1
    out = np.asarray(rows, np.uint64).copy()
    walk = np.arange(len(out))
    order = range(ROUNDS - 1, -1, -1) if inverse else range(ROUNDS)
    while len(walk):
        x = out[walk]
        left, right = x >> np.uint64(h), x & np.uint64(mask)
        for i in order:
            k = round_key(seed, i)
            if inverse:
                left, right = right ^ _round(left, k, mask), left
            else:
                left, right = right, left ^ _round(right, k, mask)
        out[walk] = (left << np.uint64(h)) | right
        walk = walk[out[walk] >= np.uint64(n)]
    return out.astype(np.int64)


def shard_rows(docs: DataFrame, shards: int = 8, seed: int = 17) -> DataFrame:
    """``doc_id, size, text_crc32, row_no, shard, slot`` for every row of ``docs``."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (F.length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    placed, n = numbered(rows, ["doc_id", "text_crc32", "size"], "shard-rows")

    @F.pandas_udf("long")
    def place(chunks: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for c in chunks:
            yield pd.Series(permute(c.to_numpy(), n, seed))

    out = placed.withColumn("_p", place("row_no"))
    return out.select("doc_id", "size", "text_crc32", "row_no",
                      F.pmod("_p", F.lit(shards)).cast("int").alias("shard"),
                      F.expr(f"_p div {shards}").alias("slot"))
