"""Near-duplicate documents: an n-gram Jaccard join with a count-vector R-tree.

A document is its set of 5-word shingles (64-bit hashes).  Two documents link
when ``100 * |A and B| >= 75 * |A or B|``.

1. Texts with equal sets share a fingerprint; the join works on distinct sets.
2. Count vectors.  The shingles of a set are hashed into ``GROUPS`` groups and
   counted: a point.  The overlap of two sets is at most the sum of their
   coordinate minima; against an R-tree node, with the coordinate maxima of
   its points.  Large sets, whose counts even out, have a second, finer point.  With the size ranges this bounds which sets can link.
3. Buckets (lossless).  Linked sets overlap in at least 75 % of each, so under
   any fixed order of the shingles their first ``n - ceil(0.75 n) + 1`` share
   one.  The order puts frequent shingles last: a fixed-size count sketch over
   all documents ranks them in levels, hash order inside a level.  Under the
   first shingle that two sets share, both have all they share still before
   them: a set stays in a bucket only if, by sizes and places, some other one
   of it can still overlap enough with it.  The points
   of a bucket (a prefix shingle) are indexed in an R-tree and joined with it.
   Frequent shingles are salted into ``SALTS`` trees, or as many as keep a
   tree near ``TREE_SETS`` sets, whose components are then joined as nodes, by
   their coordinate maxima.  The nodes of a shingle beyond ``NODE_BLOCK`` are
   cut into blocks; every pair of blocks is a task of its own.
4. Pairs that can link connect sets to clusters (connected components; a
   bucket sends a spanning forest of its pairs, never all of them).
5. Inside a cluster the R-tree proposes pairs, nearest first, which are
   verified on the shingles themselves; pairs already connected are not
   verified again, so a cluster of n copies costs about n verifications.
   Clusters beyond ``MAX_CLUSTER`` sets or ``MAX_SHINGLES`` shingles are cut
   into blocks by fingerprint; every pair of blocks is a task of its own.
6. Components over verified links give every document the least ``doc_id`` of
   its group.

Defined cases: a text of fewer than 5 words is one shingle; one without words
(null, empty, blank) has none, links with nothing and is its own component;
repeated rows belong to one component; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, may_match, stored, with_tag
from .graph import connected_components, stream_groups
from .sketch import frequency_levels, slot

SHINGLE = 5
NUMERATOR, DENOMINATOR = 75, 100
GROUPS = 256
FINE_FROM, FINE_GROUPS = 1024, 4096  # sets so large also have a finer point
MANY = 255  # a packed count of this stands for any number
LEAF = 32
SALTS = 64
TREE_SETS = 16_384
NODE_BLOCK = 8192
MAX_CLUSTER = 8000
MAX_SHINGLES = 4_000_000

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_MULT = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingles(text: str) -> np.ndarray:
    """Distinct shingle hashes of a text, ascending."""
    words = text.encode().translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    h = np.fromiter((digest(w) for w in words), np.uint64, len(words))
    size = min(SHINGLE, len(h))
    out = np.full(len(h) - size + 1, size, np.uint64)
    for i in range(size):
        out = out * _MULT + h[i:len(h) - size + 1 + i]
    return np.unique(_mix(out))


def fingerprint(s: np.ndarray) -> int:
    return int(np.array(xxhash.xxh3_64_intdigest(s.tobytes()), np.uint64).view(np.int64))


def count_vector(s: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    return np.bincount((s & np.uint64(groups - 1)).astype(np.int64), minlength=groups).astype(np.int32)


def pack_point(*points: np.ndarray) -> bytes:
    return np.minimum(np.concatenate(points), MANY).astype(np.uint8).tobytes()


def set_points(s: np.ndarray) -> list[np.ndarray]:
    """A set's point; for a large set also its finer point (which adds up to the first)."""
    return [count_vector(s)] + ([count_vector(s, FINE_GROUPS)] if len(s) >= FINE_FROM else [])


def _counts(packed: list[bytes], groups: int) -> np.ndarray:
    """Rows of counts; the largest packed value becomes a number no set reaches, so bounds stay bounds."""
    out = np.frombuffer(b"".join(packed), np.uint8).reshape(-1, groups).astype(np.int32)
    out[out == MANY] = 1 << 22
    return out


def unpack_points(packed) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Points; and the finer points with each point's row among them (-1: none)."""
    row = np.full(len(packed), -1, np.int64)
    large = [i for i, p in enumerate(packed) if len(p) > GROUPS]
    row[large] = np.arange(len(large))
    return _counts([p[:GROUPS] for p in packed], GROUPS), (row, _counts([packed[i][GROUPS:] for i in large], FINE_GROUPS))


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return DENOMINATOR * both >= NUMERATOR * (len(a) + len(b) - both)


def prefix_size(n: int) -> int:
    return n - -(-NUMERATOR * n // DENOMINATOR) + 1


class CountTree:
    """R-tree over count vectors, bulk-loaded by halving along the widest coordinate.

    A point is a set (``least`` = ``most`` = its size) or a group of sets
    (coordinate maxima and the range of sizes).
    """

    def __init__(self, points: np.ndarray, least: np.ndarray, most: np.ndarray | None = None, fine=None):
        self.row, self.fine = fine or (np.full(len(points), -1, np.int64), None)
        self.points, self.least, self.most = points, least, least if most is None else most
        high, low, top, kids, self.members = [], [], [], [], []

        def load(idx: np.ndarray) -> int:
            me, p = len(high), points[idx]
            high.append(p.max(0))
            low.append(self.least[idx].min())
            top.append(self.most[idx].max())
            kids.append((-1, -1))
            self.members.append(idx)
            if len(idx) > LEAF:
                axis = int(np.argmax(high[me] - p.min(0)))
                order = idx[np.argsort(p[:, axis], kind="stable")]
                half = len(order) // 2
                kids[me] = (load(order[:half]), load(order[half:]))
            return me

        if len(points):
            load(np.arange(len(points)))
        self.high, self.low, self.top = np.array(high), np.array(low), np.array(top)
        self.kids = np.array(kids).reshape(-1, 2)

    @staticmethod
    def possible(overlap, a, b, least, most):
        """Can a set of a size in [a, b] link with one in [least, most], overlapping at most ``overlap``?"""
        n, d = NUMERATOR, DENOMINATOR
        smallest = np.maximum(least, -(-n * a // d))
        return (d * most >= n * a) & (n * least <= d * b) & ((d + n) * overlap >= n * (a + smallest))

    def near(self, i: int) -> np.ndarray:
        """Points that may link with point ``i`` (a superset of those that do), itself among them."""
        point, a, b = self.points[i], self.least[i], self.most[i]
        nodes, out = np.zeros(1, np.int64), []
        while len(nodes):
            bound = np.minimum(self.high[nodes], point).sum(1)
            nodes = nodes[self.possible(bound, a, b, self.low[nodes], self.top[nodes])]
            leaf = self.kids[nodes, 0] < 0
            out += [self.members[k] for k in nodes[leaf]]
            nodes = self.kids[nodes[~leaf]].ravel()
        if not out:
            return np.empty(0, np.int64)
        idx = np.concatenate(out)
        bound = np.minimum(self.points[idx], point).sum(1)
        idx = idx[self.possible(bound, a, b, self.least[idx], self.most[idx])]
        large = self.row[idx] >= 0
        if self.row[i] >= 0 and large.any():  # two large sets: the finer bound too
            both = idx[large]
            bound = np.minimum(self.fine[self.row[both]], self.fine[self.row[i]]).sum(1)
            both = both[self.possible(bound, a, b, self.least[both], self.most[both])]
            idx = np.concatenate([idx[~large], both])
        return idx


def link_forest(sets: list[np.ndarray], side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect all linked sets (a spanning forest); with ``side``, only across sides.

    Of the sets that the tree proposes for one, the nearest is verified first,
    then all that are not connected to it yet, together.
    """
    points = np.stack([count_vector(s) for s in sets])
    sizes = np.array([len(s) for s in sets], np.int64)
    large = np.flatnonzero(sizes >= FINE_FROM)
    row = np.full(len(sets), -1, np.int64)
    row[large] = np.arange(len(large))
    fine = np.array([count_vector(sets[k], FINE_GROUPS) for k in large], np.int32).reshape(-1, FINE_GROUPS)
    tree, root, out = CountTree(points, sizes, fine=(row, fine)), np.arange(len(sets)), []
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    ids = np.split(flat, np.cumsum(sizes)[:-1])
    mine = np.zeros(flat.max() + 1, np.int64)

    def verified(i: int, near: np.ndarray) -> np.ndarray:
        starts = np.concatenate([[0], np.cumsum(sizes[near])[:-1]])
        both = np.add.reduceat(mine[np.concatenate([ids[j] for j in near])], starts)
        return near[DENOMINATOR * both >= NUMERATOR * (sizes[i] + sizes[near] - both)]

    for i in range(1, len(sets)):
        near = tree.near(i)
        near = near[near < i]
        if side is not None:
            near = near[side[near] != side[i]]
        if not len(near):
            continue
        mine[ids[i]] = 1
        first = near[np.argmin(np.abs(points[near] - points[i]).sum(1))]
        for group in (np.array([first]), near):
            group = group[root[group] != root[i]]
            for j in verified(i, group) if len(group) else ():
                if root[j] != root[i]:
                    out.append((i, int(j)))
                    root[root == root[j]] = root[i]
        mine[ids[i]] = 0
    return out


def shingle_levels(docs: DataFrame) -> np.ndarray:
    """Frequency level of every sketch slot, from all shingles of all documents (fixed size)."""
    return frequency_levels(docs, lambda texts: map(shingles, texts))


def prefix_rows(docs: DataFrame, levels: np.ndarray) -> DataFrame:
    """Per document ``doc_id, tag`` (hash of the text), ``n, set_id``; with the first of equal sets in a task, also its point and its prefix
    shingles ``tokens``, of which the first ``cold`` are ordinary and the rest frequent."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, seen = shared.value, set()
        for b in batches:
            sizes, ids, points, tokens, cold = [], [], [], [], []
            for t in b.column(1):
                s = shingles(t.as_py())
                fp = fingerprint(s)
                sizes.append(len(s))
                ids.append(fp)
                if not len(s) or fp in seen:
                    points.append(None)
                    tokens.append(None)
                    cold.append(None)
                    continue
                seen.add(fp)
                lv = level[slot(s)]
                order = np.lexsort((s, lv))[:prefix_size(len(s))]
                points.append(pack_point(*set_points(s)))
                tokens.append(s[order].view(np.int64))
                cold.append(int((lv[order] == 0).sum()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()), pa.array(points, pa.binary()),
                 pa.array(tokens, pa.list_(pa.int64())), pa.array(cold, pa.int32())],
                names=["doc_id", "tag", "n", "set_id", "point", "tokens", "cold"])

    return with_tag(id_text(docs)).mapInArrow(
        run, "doc_id long, tag long, n long, set_id long, point binary, tokens array<long>, cold int")


def _whole_runs(batches: Iterator[pa.RecordBatch], keys: int = 2) -> Iterator[list[np.ndarray]]:
    """Columns of rows sorted by their first ``keys``, regrouped so that no run of these is cut."""
    held: list[np.ndarray] | None = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [np.array(c.to_pylist(), object) if pa.types.is_binary(c.type) else c.to_numpy(zero_copy_only=False)
                for c in b.columns]
        if held is not None:
            cols = [np.concatenate([h, c]) for h, c in zip(held, cols)]
        other = np.flatnonzero(np.logical_or.reduce([c != c[-1] for c in cols[:keys]]))
        cut = other[-1] + 1 if len(other) else 0
        if cut:
            yield [c[:cut] for c in cols]
        held = [c[cut:] for c in cols]
    if held is not None:
        yield held


def _new_run(*cols: np.ndarray) -> np.ndarray:
    out = np.ones(len(cols[0]), bool)
    out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
    return out


def farthest(n: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Largest size of a set that can link with one of ``n`` shingles if the first they share is its ``at``-th (from 0)."""
    return ((DENOMINATOR + NUMERATOR) * (n - at) - NUMERATOR * n) // NUMERATOR


def with_partner(run: np.ndarray, n: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Whether each row may have a partner in its run: another with ``n <= far`` both ways (exact in runs of two, in larger
    ones a superset).  ``run``: ascending numbers; ``far``: see ``farthest``."""
    span = np.int64(max(n.max(initial=0), far.max(initial=0)) + 1)
    order = np.lexsort((n, run))
    base, n, far = run[order].astype(np.int64) * span, n[order], far[order]
    key, at = base + n, np.arange(len(n))
    start = np.searchsorted(base, base)
    # A smaller set before it, of those its own reach allows; the runs' spans keep their maxima apart.
    most = np.maximum.accumulate(base + far)
    last = np.minimum(at, np.searchsorted(key, base + far, "right")) - 1
    smaller = (last >= start) & (most[last] - base >= n)
    # A larger one after it: the next in size is within its reach, and some later one reaches back.
    after = np.append(base[1:] == base[:-1], False)
    back = np.maximum.accumulate((far - base)[::-1])[::-1]
    larger = after & (np.append(n[1:], 0) <= far) & (np.append(back[1:], 0) + base >= n)
    out = np.empty(len(n), bool)
    out[order] = smaller | larger
    return out


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (token, salt, set), with the set's size and the token's place in it: distinct members of runs
    that may have a partner there, and of salted runs.

    An unsalted run is renamed by a digest of its members, so that the many
    shingles which the same sets share make one bucket (a clash of digests
    would only join two buckets).
    """
    for cols in _whole_runs(batches):
        first = _new_run(*cols[:3])
        token, salt, sid, place = (c[first] for c in cols)
        run = np.cumsum(_new_run(token, salt)) - 1
        n = place >> 32
        keep = with_partner(run, n, farthest(n, place & 0xFFFFFFFF)) | (salt >= 0)
        token, salt, sid, run = (c[keep] for c in (token, salt, sid, run))
        if not len(run):
            continue
        run = np.cumsum(_new_run(run)) - 1
        starts = np.flatnonzero(_new_run(run))
        digest = _mix(np.add.reduceat(_mix(sid.view(np.uint64)), starts) + np.bincount(run).astype(np.uint64))
        token = np.where(salt >= 0, token, digest.view(np.int64)[run])
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (token, salt, sid)], names=["token", "salt", "set_id"])


def possible_forest(points: np.ndarray, least: np.ndarray, most: np.ndarray, fine=None,
                    side: np.ndarray | None = None) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Spanning forest of the pairs that the bound allows (with ``side``, only across sides), and each point's component."""
    tree, root, out = CountTree(points, least, most, fine), np.arange(len(points)), []
    for i in range(1, len(points)):
        near = tree.near(i)
        near = near[near < i]
        if side is not None:
            near = near[side[near] != side[i]]
        for r, j in zip(*np.unique(root[near], return_index=True)):
            out.append((i, int(near[j])))
            root[root == r] = i
    return out, root


_EDGE_SCHEMA = "a long, b long, token long, point binary, least long, most long"


def _edge_batch(a, b, token=(), rep=(), point=(), least=(), most=()) -> pa.RecordBatch:
    """Edges, then node rows (``a`` a member of the node, ``b`` null)."""
    k, m = len(a), len(token)
    return pa.RecordBatch.from_arrays(
        [pa.array([*a, *rep], pa.int64()), pa.array([*b, *[None] * m], pa.int64()),
         pa.array([*[None] * k, *token], pa.int64()), pa.array([*[None] * k, *point], pa.binary()),
         pa.array([*[None] * k, *least], pa.int64()), pa.array([*[None] * k, *most], pa.int64())],
        names=["a", "b", "token", "point", "least", "most"])


def _bucket_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (token, salt, set, n, point) in whole buckets to edges; salted buckets also send their components."""
    for token, salt, sid, n, packed in _whole_runs(batches):
        points, (row, fine) = unpack_points(packed)
        starts = np.flatnonzero(_new_run(token, salt))
        ends = np.append(starts[1:], len(token))
        pair = (ends - starts == 2) & (salt[starts] < 0) & (row[starts] < 0)
        i = starts[pair]
        ok = CountTree.possible(np.minimum(points[i], points[i + 1]).sum(1), n[i], n[i], n[i + 1], n[i + 1])
        a, b = sid[i[ok]].tolist(), sid[i[ok] + 1].tolist()
        nodes = [[], [], [], [], []]
        for lo, hi in zip(starts[~pair].tolist(), ends[~pair].tolist()):
            forest, root = possible_forest(points[lo:hi], n[lo:hi], n[lo:hi], (row[lo:hi], fine))
            a += [int(sid[lo + x]) for x, _ in forest]
            b += [int(sid[lo + y]) for _, y in forest]
            if salt[lo] >= 0:
                for r in np.unique(root):
                    m = lo + np.flatnonzero(root == r)
                    for c, v in zip(nodes, (int(token[lo]), int(sid[m[0]]), pack_point(points[m].max(0)),
                                            int(n[m].min()), int(n[m].max()))):
                        c.append(v)
        yield _edge_batch(a, b, *nodes)


def _node_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (token, lo, hi, block, set, point, least, most), nodes of one or two blocks of a token, to edges between nodes."""
    for token, one, other, block, rep, packed, least, most in _whole_runs(batches, 3):
        points, out = unpack_points(packed)[0], []
        starts = np.flatnonzero(_new_run(token, one, other))
        for lo, hi in zip(starts.tolist(), np.append(starts[1:], len(token)).tolist()):
            if hi - lo > 1:
                side = block[lo:hi] if one[lo] != other[lo] else None
                forest, _ = possible_forest(points[lo:hi], least[lo:hi], most[lo:hi], side=side)
                out += [(int(rep[lo + x]), int(rep[lo + y])) for x, y in forest]
        yield _edge_batch([x for x, _ in out], [y for _, y in out])


def node_pairs(nodes: DataFrame) -> DataFrame:
    """Nodes of every token in blocks of about ``NODE_BLOCK``, each with itself and with every other block."""
    count = nodes.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > NODE_BLOCK)
    # At most one row for every NODE_BLOCK nodes.
    large = F.broadcast(count.select("token", F.ceil(F.col("n") / NODE_BLOCK).cast("int").alias("blocks")))
    rows = nodes.join(large, "token", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select("token", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
                       "block", "a", "point", "least", "most")


def candidate_edges(prefixes: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` that connect all sets which share a prefix shingle and can link by their count vectors."""
    rows = prefixes.where("tokens IS NOT NULL")
    often = rows.select(F.explode(F.expr("slice(tokens, cold + 1, size(tokens))")).alias("token"))
    often = often.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SALTS * TREE_SETS)
    # At most one row for every SALTS * TREE_SETS prefix shingles.
    trees = F.broadcast(often.select("token", F.ceil(F.col("n") / TREE_SETS).alias("trees")))
    tokens = rows.select("set_id", "n", "cold", F.posexplode("tokens").alias("_at", "token")).join(trees, "token", "left")
    salt = F.when(F.col("_at") < F.col("cold"), F.lit(-1)).otherwise(
        F.pmod("set_id", F.coalesce("trees", F.lit(SALTS)))).cast("int")
    place = F.shiftleft("n", 32) + F.col("_at")  # one number: it travels with every prefix shingle
    members = (tokens.select("token", salt.alias("salt"), "set_id", place.alias("place")).repartition("token", "salt")
               .sortWithinPartitions("token", "salt", "set_id")
               .mapInArrow(_shared, "token long, salt int, set_id long").dropDuplicates())
    members = stored(members, "buckets")
    points = prefixes.where("point IS NOT NULL").groupBy("set_id").agg(F.first("n").alias("n"), F.first("point").alias("point"))
    rows = members.join(points, "set_id").select("token", "salt", "set_id", "n", "point")
    found = stored(rows.repartition("token", "salt").sortWithinPartitions("token", "salt", "set_id")
                   .mapInArrow(_bucket_edges, _EDGE_SCHEMA), "bucket-edges")
    nodes = found.where("token IS NOT NULL").select("token", "a", "point", "least", "most")
    across = (node_pairs(nodes).repartition("token", "lo", "hi").sortWithinPartitions("token", "lo", "hi", "block", "a")
              .mapInArrow(_node_edges, _EDGE_SCHEMA))
    return found.where("b IS NOT NULL").select("a", "b").unionByName(across.select("a", "b")).distinct()


def verified_links(docs: DataFrame, members: DataFrame) -> DataFrame:
    """Spanning links ``(a, b)`` of each cluster; ``members``: one row ``least, n, set_id, cluster`` per distinct set."""
    size = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("total"))
    blocks = F.greatest(F.ceil(F.col("sets") / MAX_CLUSTER), F.ceil(F.col("total") / MAX_SHINGLES))
    m = members.join(size.where("sets > 1").select("cluster", blocks.cast("int").alias("blocks")), "cluster")
    m = m.withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))
    m = stored(m.select(F.col("least.doc_id").alias("_id"), F.col("least.tag").alias("_tag"), "set_id", "cluster", "blocks", "block"),
               "candidates")
    # Most texts are in no cluster: they don't travel to the join.
    rows = may_match(with_tag(id_text(docs)), m.select(F.col("_id").alias("doc_id"), F.col("_tag").alias("tag")), ["doc_id", "tag"])
    with_text = rows.join(m, rows["doc_id"].eqNullSafe(m["_id"]) & (rows["tag"] == m["_tag"]))
    # Every set goes to the pair (own block, other block) once for each other block.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = (with_text.withColumn("other", other)
            .select("cluster", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
                    "block", "set_id", "text"))

    def work(t: pa.Table) -> Iterator[pa.RecordBatch]:
        ids, at, sets, seen = t.column("set_id").to_pylist(), [], [], set()
        for i, text in enumerate(t.column("text")):
            s = shingles(text.as_py())
            if ids[i] not in seen and fingerprint(s) == ids[i]:  # a text may have come repeated
                seen.add(ids[i])
                at.append(i)
                sets.append(s)
        if len(sets) < 2:
            return
        block = t.column("block").to_numpy()[at]
        across = t.column("lo")[0] != t.column("hi")[0]
        links = link_forest(sets, block if across else None)
        yield pa.RecordBatch.from_arrays([pa.array([ids[at[i]] for i, _ in links], pa.int64()),
                                          pa.array([ids[at[j]] for _, j in links], pa.int64())], names=["a", "b"])

    return stream_groups(rows, ["cluster", "lo", "hi"], ["set_id"], work, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs`` (a null id only leads rows of null ids)."""
    return grouped_rows(docs).select("doc_id", "n_shingles", "component_id")


def grouped_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, tag, n_shingles, component_id, leads``: whether the row is the least, by id (null last) and text hash, of
    its component."""
    levels = shingle_levels(docs)
    rows = stored(prefix_rows(docs, levels), "prefixes")
    mine = rows.select("doc_id", "tag", "n", "set_id")
    place = F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "tag")
    sets = mine.where("n > 0").groupBy("set_id").agg(F.min(place).alias("least"), F.min("n").alias("n"))
    clusters = connected_components(candidate_edges(rows))
    members = sets.join(clusters.select(F.col("node").alias("set_id"), F.col("root").alias("cluster")), "set_id")
    roots = connected_components(stored(verified_links(docs, stored(members, "members")), "links"))
    roots = roots.select(F.col("node").alias("set_id"), "root")
    grouped = sets.join(roots, "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    least = grouped.groupBy("root").agg(F.min("least").alias("of_root"))
    per_set = stored(grouped.join(least, "root").select("set_id", "of_root"), "set-components")
    return mine.join(per_set, "set_id", "left").withColumn("component_id", F.col("of_root.doc_id")).select(
        "doc_id", "tag", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        ((F.col("n") == 0) | (F.col("doc_id").eqNullSafe(F.col("component_id"))
                              & (F.col("tag") == F.col("of_root.tag")))).alias("leads"))
