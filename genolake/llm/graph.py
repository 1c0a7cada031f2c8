"""Connected components of an edge table, and sorted streaming by key."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` of every node of ``edges(a, b)``; root: the component's least node.

    Alternating large-star and small-star steps: each hangs a node's
    neighbours on its least neighbour, by a minimum per node (partial
    aggregation) and an equi-join; no group is collected.  The number of
    rounds is logarithmic; every round is a written table.
    """
    e = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(),
               "edges")
    before = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b")))
                 .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
        e = stored(small, "edges")
        state = e.agg(F.count(F.lit(1)), F.count_distinct("a"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before and state[0] == state[1]:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    leaves = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return leaves.unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def stream_groups(df: DataFrame, keys: list[str], order: list[str], work: Callable[[pa.Table], Iterator[pa.RecordBatch]],
                  schema: str) -> DataFrame:
    """``work`` on the rows of each key (one Arrow table, sorted), many small groups to a task.

    For keys whose groups are bounded: a task holds one group at a time.
    """
    names = df.columns
    at = [names.index(k) for k in keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current = None
        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(i).to_pylist() for i in at]
            marks = list(zip(*cols))
            lo = 0
            for hi in range(1, len(marks) + 1):
                if hi == len(marks) or marks[hi] != marks[lo]:
                    if current is not None and marks[lo] != current:
                        yield from work(pa.Table.from_batches(held))
                        held = []
                    held.append(b.slice(lo, hi - lo))
                    current, lo = marks[lo], hi
        if held:
            yield from work(pa.Table.from_batches(held))

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)
