"""A fixed-size count sketch of 64-bit hashes over all rows of a table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_text

BITS = 21
ROW = 1 << 16


def slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def frequency_levels(docs: DataFrame, hashes: Callable[[list[str]], Iterator[np.ndarray]]) -> np.ndarray:
    """Per slot: 0 for ordinary, k for counts 2^k times the ordinary (and more).

    ``hashes`` maps a block of texts to arrays of 64-bit hashes.  Every task
    counts into one sketch of ``2**BITS`` slots; rows of sketches are added up
    by slot range, and only the levels (one byte a slot, whatever the size of
    the table) come to the driver.
    """
    width = 1 << BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, rows = np.zeros(width, np.uint32), 0
        for b in batches:
            rows += b.num_rows
            for h in hashes(t.as_py() for t in b.column(1)):
                np.add.at(sketch, slot(h), 1)
        if rows:
            parts = sketch.reshape(-1, ROW)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()),
                                              pa.array([p.tobytes() for p in parts], pa.binary())], names=["k", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, c in zip(b.column(0).to_pylist(), b.column(1)):
                part = np.frombuffer(c.as_py(), np.uint32)
                total[k] = total[k] + part if k in total else part.astype(np.uint64)
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()),
                                              pa.array([v.tobytes() for v in total.values()], pa.binary())],
                                             names=["k", "counts"])

    rows = (id_text(docs).mapInArrow(count, "k int, counts binary").repartition("k")
            .mapInArrow(add, "k int, counts binary").collect())  # 2**BITS counters in all
    counts = np.zeros(width, np.uint64)
    for r in rows:
        counts[r["k"] * ROW:(r["k"] + 1) * ROW] = np.frombuffer(r["counts"], np.uint64)
    ordinary = 2.0 * counts.mean() + 16
    return np.clip(np.floor(np.log2(np.maximum(counts / ordinary, 0.5))) + 1, 0, 31).astype(np.uint8)
