"""Vector compression to codes: a codebook per part, searched by a GNAT over its entries.

A vector's components become integers ``floor(256 * x)``; the vector is cut
into equal consecutive parts and every part is replaced by the index of the
nearest entry of its part position's codebook.  Codebooks start from the parts
of the vectors with the least ids and are moved twice to their parts' means,
rounded down.  All distances are exact integers.

Search: the entries of a codebook form a geometric near-neighbour access tree.
A node holds a few split points, each with the entries nearest to it, and for
every (split point, child) the range of distances from that point to the
child's entries.  A query measures itself against the split points; with ``r``
the least distance so far, a child whose range lies wholly outside
``[d - r, d + r]`` for some split point cannot hold an entry as near, and goes
with its whole subtree.  Distances are rounded outwards, so only entries that
are strictly farther go; what is left is compared by integer distances, equal
ones by the lower index.

Passes over the vectors: one for the first codebooks, one a round, one for the
codes; each sends at most parts x entries rows of sums a task.  Only codebooks
reach the driver.

Defined cases: rows whose vector is null, or holds a null or non-finite
component, or has another length than the vector of the least kept id, are
left out.  Repeated rows are coded each; of several vectors with one id the
least (as integers, in component order) starts a codebook.  A null id is coded
but starts no codebook.  Fewer than ``entries`` ids: smaller codebooks.  No
kept rows: an empty result.  A length that does not divide into the parts, or
components beyond ``2**26`` as integers, raise ``ValueError``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spread_salt, stored

SCALE, LIMIT = 256, 1 << 26
LEAF = 8
OUTWARDS = 2.0 ** -48  # far above the rounding of a square root of an integer below 2**62
BROADCAST_GROUPS = 500_000


# -- the tree ----------------------------------------------------------------

def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances, rows of ``x`` by entries."""
    out = np.zeros((len(x), len(entries)), np.int64)
    for c in range(x.shape[1]):
        diff = x[:, c, None] - entries[None, :, c]
        out += diff * diff
    return out


@dataclass
class Node:
    splits: np.ndarray  # entry numbers, ascending
    children: list["Node | np.ndarray | None"] = field(default_factory=list)
    low: np.ndarray | None = None  # [split, child]: least and greatest distance, rounded outwards
    high: np.ndarray | None = None


def build_tree(entries: np.ndarray, members: np.ndarray, degree: int = 8) -> Node | np.ndarray:
    """A GNAT over ``members`` (entry numbers); a small set stays a plain array."""
    if len(members) <= LEAF:
        return members
    gap = squared(entries[members], entries[members])
    picked = [int(np.argmax(gap.max(axis=1)))]
    while len(picked) < min(degree, len(members)):  # the farthest from all split points so far
        near = gap[:, picked].min(axis=1)
        near[picked] = -1
        picked.append(int(np.argmax(near)))
    picked = sorted(picked)
    rest = np.setdiff1d(np.arange(len(members)), picked)
    home = np.argmin(gap[np.ix_(rest, picked)], axis=1)
    dist = np.sqrt(gap.astype(np.float64))
    node = Node(members[picked], [], np.full((len(picked),) * 2, np.inf), np.full((len(picked),) * 2, -np.inf))
    for g in range(len(picked)):
        mine = rest[home == g]
        if not len(mine):
            node.children.append(None)
            continue
        node.low[:, g] = dist[np.ix_(picked, mine)].min(axis=1) * (1 - OUTWARDS)
        node.high[:, g] = dist[np.ix_(picked, mine)].max(axis=1) * (1 + OUTWARDS)
        child = members[mine]
        # equal entries cannot be told apart by more split points
        node.children.append(child if (entries[child] == entries[child[0]]).all() else build_tree(entries, child, degree))
    return node


@dataclass
class Search:
    """Nearest entries of many queries at once; ``measured`` counts the distances computed."""

    entries: np.ndarray
    degree: int = 8
    measured: int = 0

    def __post_init__(self):
        self.tree = build_tree(self.entries, np.arange(len(self.entries)), self.degree)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        best = np.full(len(x), np.iinfo(np.int64).max)
        at = np.full(len(x), len(self.entries), np.int64)
        self._visit(self.tree, np.arange(len(x)), x, best, at)
        return at, best

    def _visit(self, node, rows, x, best, at):
        members = node if isinstance(node, np.ndarray) else node.splits
        d2 = squared(x[rows], self.entries[members])
        self.measured += d2.size
        first = np.argmin(d2, axis=1)  # the first of equal ones: members ascend
        value, number = d2[np.arange(len(rows)), first], members[first]
        better = (value < best[rows]) | ((value == best[rows]) & (number < at[rows]))
        best[rows[better]], at[rows[better]] = value[better], number[better]
        if isinstance(node, np.ndarray):
            return
        dist = np.sqrt(d2.astype(np.float64))
        near, far = dist * (1 - OUTWARDS), dist * (1 + OUTWARDS)
        for g, child in enumerate(node.children):
            if child is None:
                continue
            r = (np.sqrt(best[rows].astype(np.float64)) * (1 + OUTWARDS))[:, None]
            gone = ((near - r > node.high[:, g]) | (far + r < node.low[:, g])).any(axis=1)
            if not gone.all():
                self._visit(child, rows[~gone], x, best, at)


# -- vectors -----------------------------------------------------------------

def usable(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the usable vectors of an Arrow list column; all components as floors; every row's begin and end."""
    size = np.asarray(col.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False), np.int64)
    values = np.asarray(col.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False), np.float64)
    end = np.cumsum(np.maximum(size, 0))
    begin = end - np.maximum(size, 0)
    sound = np.concatenate([[0], np.cumsum(np.isfinite(values))])
    rows = np.flatnonzero((size >= 0) & (sound[end] - sound[begin] == size))
    with np.errstate(over="ignore", invalid="ignore"):
        return rows, np.floor(values * SCALE), begin, end


def checked(out: np.ndarray) -> np.ndarray:
    if out.size and np.abs(out).max() > LIMIT:
        raise ValueError(f"a vector component is beyond {LIMIT // SCALE}")
    return out.astype(np.int64)


def integers(col: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the usable vectors of this length, and their integers (rows, length)."""
    rows, floors, begin, end = usable(col)
    rows = rows[end[rows] - begin[rows] == length]
    return rows, checked(floors[begin[rows][:, None] + np.arange(length)[None, :]])


def first_vectors(rows: DataFrame, count: int, length: int | None = None) -> list[list[int]]:
    """The vectors of the ``count`` least ids; each task sends at most ``count`` rows."""

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for b in batches:
            ids = b.column(0).to_pylist()
            places, floors, begin, end = usable(b.column(1))
            top = max(held) if len(held) == count else None
            fit = [i for i in places if ids[i] is not None and (top is None or ids[i] <= top)
                   and (length is None or end[i] - begin[i] == length)]
            new: set[int] = set()
            for i in sorted(fit, key=ids.__getitem__):
                new.add(ids[i])
                if len(new) > count:
                    break
                v = checked(floors[begin[i]:end[i]]).tolist()
                held[ids[i]] = min(held.get(ids[i], v), v)
            held = dict(sorted(held.items())[:count])
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()),
                                          pa.array(list(held.values()), pa.list_(pa.int64()))], names=["vec_id", "v"])

    found = (rows.select("vec_id", "embedding").mapInArrow(least, "vec_id long, v array<long>")
             .groupBy("vec_id").agg(F.min("v").alias("v")).orderBy("vec_id").limit(count).collect())
    vectors = [r["v"] for r in found]
    if length is None and any(len(v) != len(vectors[0]) for v in vectors):
        return first_vectors(rows, count, len(vectors[0]))
    return vectors


# -- codebooks ---------------------------------------------------------------

@dataclass
class Codebooks:
    books: np.ndarray  # parts, entries, width
    length: int

    @property
    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.reshape(-1).tolist())).encode()).hexdigest()

    def searches(self) -> list[Search]:
        return [Search(b) for b in self.books]


def _coded(searches: list[Search], vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    parts = np.split(vectors, len(searches), axis=1)
    found = [s.nearest(p) for s, p in zip(searches, parts)]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def moved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """One round: every entry moves to the mean of its parts, rounded down; unused ones stay."""
    n_parts, n_entries, width = books.books.shape
    sums = [f"s{c}" for c in range(width)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = books.searches()
        total = np.zeros((n_parts * n_entries, width), np.int64)
        count = np.zeros(n_parts * n_entries, np.int64)
        for b in batches:
            _, vectors = integers(b.column(0), books.length)
            codes, _ = _coded(searches, vectors)
            for p in range(n_parts):
                slot = codes[:, p] + p * n_entries
                np.add.at(total, slot, vectors[:, p * width:(p + 1) * width])
                count += np.bincount(slot, minlength=len(count))
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(count[used]), *(pa.array(total[used, c]) for c in range(width))],
                                         names=["slot", "n", *sums])

    out = (rows.select("embedding").mapInArrow(add, "slot long, n long, " + ", ".join(f"{s} long" for s in sums))
           .groupBy("slot").agg(F.sum("n").alias("n"), *(F.sum(s).alias(s) for s in sums)))
    new = books.books.copy()
    for r in out.collect():  # at most parts x entries rows
        new[r["slot"] // n_entries, r["slot"] % n_entries] = [r[s] // r["n"] for s in sums]
    return Codebooks(new, books.length)


def train(rows: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2) -> Codebooks | None:
    """Codebooks of ``rows(vec_id, embedding)``; None if no vector is usable."""
    start = first_vectors(rows, entries)
    if not start:
        return None
    length = len(start[0])
    if not length or length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} equal parts")
    first = np.array(start, np.int64).reshape(len(start), parts, length // parts)
    books = Codebooks(np.ascontiguousarray(first.transpose(1, 0, 2)), length)
    for _ in range(rounds):
        books = moved(rows, books)
    return books


CODED = "vec_id long, label {label}, code string, error long"


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``vec_id, label, code, error`` of every usable vector; codes as two hex digits a part."""
    label = rows.schema["label"].dataType

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = books.searches()
        for b in batches:
            places, vectors = integers(b.column(2), books.length)
            if not len(places):
                continue
            codes, errors = _coded(searches, vectors)
            text = [row.tobytes().hex() for row in codes.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(places)), b.column(1).take(pa.array(places)),
                                              pa.array(text), pa.array(errors.sum(axis=1))],
                                             names=["vec_id", "label", "code", "error"])

    return rows.select("vec_id", "label", "embedding").mapInArrow(code, CODED.format(label=label.simpleString()))


def decode(coded: DataFrame, books: Codebooks) -> DataFrame:
    """``vec_id`` and the vector that each code stands for."""
    n_parts = len(books.books)

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = np.frombuffer(bytes.fromhex("".join(b.column(1).to_pylist())), np.uint8).reshape(-1, n_parts)
            vectors = books.books[np.arange(n_parts)[None, :], codes].reshape(len(codes), -1) / SCALE
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(vectors.tolist(), pa.list_(pa.float64()))],
                                             names=["vec_id", "embedding"])

    return coded.select("vec_id", "code").mapInArrow(back, "vec_id long, embedding array<double>")


def with_group_sum(rows: DataFrame, group: str, value: str, out: str, broadcast_max: int = BROADCAST_GROUPS) -> DataFrame:
    """Adds the sum of ``value`` over the row's group (nulls together).

    Partial sums first, one row a group; joined back by a broadcast of counted
    size, beyond it by a join whose hot groups are dealt over 64 salts.
    """
    sums = rows.groupBy(F.col(group).alias("_g")).agg(F.sum(value).alias(out))
    if sums.limit(broadcast_max + 1).count() <= broadcast_max:
        return rows.join(F.broadcast(sums), rows[group].eqNullSafe(F.col("_g"))).drop("_g")
    dealt = sums.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(63))))
    salted = rows.withColumn("_s", spread_salt(64))
    return salted.join(dealt, (salted["_s"] == dealt["_s"]) & salted[group].eqNullSafe(dealt["_g"])) \
        .select(*rows.columns, out)


def vector_codes(embeddings: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2) -> DataFrame:
    """``vec_id, label, code, error, label_error, codebooks_sha256`` of every usable vector."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    books = train(rows, parts, entries, rounds)
    if books is None:
        spark = embeddings.sparkSession
        label = rows.schema["label"].dataType.simpleString()
        return spark.createDataFrame([], CODED.format(label=label) + ", label_error long, codebooks_sha256 string")
    coded = stored(encode(rows, books), "vector-codes")
    return with_group_sum(coded, "label", "error", "label_error").withColumn("codebooks_sha256", F.lit(books.digest))
