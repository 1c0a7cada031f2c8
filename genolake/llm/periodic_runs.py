"""Periodic runs of words, by a difference cover and a harmonic grid.

A run is a stretch of words that repeats itself at a distance ``q`` (its
smallest period), is at least ``max(12, 2 q)`` words long and cannot be made
longer on either side.

Enumeration: a run with period ``p`` holds a stretch of at least ``p`` places
``x`` with ``w[x] == w[x + p]``, so one of the grid places ``0, p, 2p, ...``
lies in it.  From every grid place of every period up to half the text
(n/1 + n/2 + n/3 + ... places) the longest common extensions of ``x`` and
``x + p`` to both sides give the stretch; it is reported at its first grid
place, and of several periods with the same borders the smallest is the run's.

Extensions: of the word places only those in a difference cover modulo 31
(6 of 31) have their suffixes sorted, document by document, first by 31 words
and then by doubling.  For any two places some shift below 31 brings both into
the cover: the words up to there are compared one by one, and the rest is a
range minimum, by a sparse table, over the common prefixes of neighbouring
sorted suffixes.  Suffixes of a document are sorted only if some comparison in
it reaches the cover.  Extensions to the left are those of the reversed words.

Documents are taken in groups of a bounded number of words, so the work runs
over whole arrays; a longer document is a group of its own.  No shuffle.

Defined cases: words are ``[^\\x20\\x09-\\x0D]+``; null text has none; a text
without runs has an empty list and its words joined by blanks as collapsed
text.  Repeated rows are read each on its own, also with a null id.  An empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_LENGTH = 12
#: A perfect difference set modulo 31.
MODULUS, COVER = 31, (0, 1, 3, 8, 12, 18)
GROUP_WORDS, CHUNK_PAIRS = 400_000, 1 << 20

IN_COVER = np.isin(np.arange(MODULUS), COVER)
#: least shift that brings places of these two remainders into the cover
SHIFT = np.array([[next(d for d in range(MODULUS) if IN_COVER[(a + d) % MODULUS] and IN_COVER[(b + d) % MODULUS])
                   for b in range(MODULUS)] for a in range(MODULUS)], np.int64)


def _refined(name: np.ndarray, tied: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names after one more symbol; a name is its group's first place in sorted order, so others stay."""
    group = name[tied]
    order = np.lexsort((symbol, group))
    g, s = group[order], symbol[order]
    new_group = np.concatenate([[True], g[1:] != g[:-1]])
    new_sub = new_group | np.concatenate([[True], s[1:] != s[:-1]])
    at = np.arange(len(g))
    first = np.maximum.accumulate(np.where(new_group, at, 0))
    sub = np.maximum.accumulate(np.where(new_sub, at, 0))
    out = name.copy()
    out[tied[order]] = g + sub - first
    lone = new_sub & np.concatenate([new_sub[1:], [True]])
    return out, np.sort(tied[order[~lone]])


class CoverSample:
    """The sorted cover-sampled suffixes of some documents of a group, and their common prefixes."""

    def __init__(self, words: np.ndarray, end: np.ndarray, doc: np.ndarray, docs: np.ndarray):
        self.docs = docs
        wanted = np.zeros(int(doc.max()) + 2, bool)
        wanted[docs] = True
        places = np.flatnonzero(wanted[doc] & IN_COVER[np.arange(len(words)) % MODULUS] & (np.arange(len(words)) < end))
        self.number = np.full(len(words), -1, np.int32)
        self.number[places] = np.arange(len(places), dtype=np.int32)
        stop = end[places]
        name = np.searchsorted(doc[places], doc[places]).astype(np.int64)  # each document a group of its own
        tied = np.arange(len(places))
        for t in range(MODULUS):
            if not len(tied):
                break
            at = places[tied] + t
            name, tied = _refined(name, tied, np.where(at < stop[tied], words[np.minimum(at, len(words) - 1)], -1))
        levels, width = [], MODULUS
        while len(tied):
            levels.append((width, name))
            at = places[tied] + width
            inside = at < stop[tied]
            nxt = np.where(inside, name[self.number[np.where(inside, at, places[tied])]], -1)
            name, tied = _refined(name, tied, nxt)
            width *= 2
        order = np.empty(len(places), np.int64)
        order[name] = np.arange(len(places))
        self.rank = name.astype(np.int32)
        self.table = self._sparse(self._prefixes(words, places[order], stop[order], levels))

    def _prefixes(self, words, places, stop, levels) -> np.ndarray:
        """Common prefix of each sorted suffix with the one before it (0 across documents)."""
        x, y = places[:-1].copy(), places[1:].copy()
        same = stop[:-1] == stop[1:]
        live = np.flatnonzero(same)
        last = stop[1:]
        for width, name in reversed(levels):
            a, b = x[live], y[live]
            inside = (a < last[live]) & (b < last[live])
            a, b = np.where(inside, a, 0), np.where(inside, b, 0)
            step = live[inside & (name[self.number[a]] == name[self.number[b]])]
            x[step] += width
            y[step] += width
        for _ in range(MODULUS):
            if not len(live):
                break
            a, b = x[live], y[live]
            equal = (a < last[live]) & (b < last[live])
            equal &= words[np.where(equal, a, 0)] == words[np.where(equal, b, 0)]
            live = live[equal]
            x[live] += 1
            y[live] += 1
        out = np.zeros(len(places), np.int32)
        out[1:] = np.where(same, x - places[:-1], 0)
        return out

    @staticmethod
    def _sparse(lcp: np.ndarray) -> list[np.ndarray]:
        """Minima over spans of 1, 2, 4, ... neighbours, as far as any span above 0 reaches."""
        table = [lcp]
        while len(table[-1]) > 1 << (len(table) - 1) and table[-1].any():
            half = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        return table

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Common prefixes of the suffixes at sampled places ``x`` and ``y`` of one document."""
        a, b = self.rank[self.number[x]], self.rank[self.number[y]]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b)
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        out = np.zeros(len(x), np.int64)  # spans wider than the table have minimum 0
        for k in np.unique(level):
            if k < len(self.table):
                at = np.flatnonzero(level == k)
                out[at] = np.minimum(self.table[k][low[at]], self.table[k][high[at] - (1 << int(k)) + 1])
        return out


class Extensions:
    """Longest common extensions inside the documents of a group; ``words`` ends each with -1."""

    def __init__(self, words: np.ndarray, end: np.ndarray, doc: np.ndarray):
        self.words, self.end, self.doc = words, end, doc
        self.sample: CoverSample | None = None

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Number of equal words from ``x`` and ``y`` on, ``x < y`` in one document."""
        shift = SHIFT[x % MODULUS, y % MODULUS]
        out = shift.copy()
        live = np.arange(len(x))
        reached = []
        for t in range(MODULUS):
            done = shift[live] == t
            reached.append(live[done])
            live = live[~done]
            if not len(live):
                break
            equal = self.words[x[live] + t] == self.words[y[live] + t]
            out[live[~equal]] = t
            live = live[equal]
        at = np.concatenate(reached)
        at = at[y[at] + shift[at] < self.end[y[at]]]
        # the last word may differ already: no sorted suffixes needed
        at = at[self.words[x[at] + shift[at]] == self.words[y[at] + shift[at]]]
        if len(at):
            docs = np.unique(self.doc[x[at]])
            if self.sample is None or not np.isin(docs, self.sample.docs).all():
                known = docs if self.sample is None else np.union1d(docs, self.sample.docs)
                self.sample = CoverSample(self.words, self.end, self.doc, known)
            out[at] += self.sample.common(x[at] + shift[at], y[at] + shift[at])
        return out


def grid(begin: np.ndarray, size: np.ndarray, chunk: int = CHUNK_PAIRS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places ``x`` and periods ``p`` of the harmonic grid of each document, in pieces of about ``chunk`` pairs."""
    half = size // 2
    for lo, hi in _pieces(half, chunk):
        doc = np.repeat(np.arange(lo, hi), half[lo:hi])
        period = np.arange(len(doc)) - np.repeat(np.cumsum(half[lo:hi]) - half[lo:hi], half[lo:hi]) + 1
        pairs = (size[doc] - 1) // period
        for a, b in _pieces(pairs, chunk):
            n, p = pairs[a:b], period[a:b]
            first = np.cumsum(n) - n
            step = np.repeat(p, n)
            yield np.repeat(begin[doc[a:b]] - first * p, n) + np.arange(len(step)) * step, step


def _pieces(weights: np.ndarray, chunk: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges of total weight about ``chunk`` (one index at least)."""
    total = np.cumsum(weights)
    lo = 0
    while lo < len(weights):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + chunk, "right")))
        yield lo, hi
        lo = hi


def find_runs(words: np.ndarray, size: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs ``(start, end, period)`` of a group, by start, then period.

    ``words`` holds the documents' word numbers one after another, each
    followed by one -1; starts and ends are places in it.
    """
    begin = np.cumsum(size + 1) - size - 1
    doc = np.repeat(np.arange(len(size)), size + 1)
    end = np.repeat(begin + size, size + 1)
    mirror = np.repeat(2 * begin + size - 1, size + 1)
    back = words.copy()
    inside = np.flatnonzero(words >= 0)
    back[(mirror - np.arange(len(words)))[inside]] = words[inside]
    ahead, behind = Extensions(words, end, doc), Extensions(back, end, doc)
    found = []
    held, n_held = [], 0

    def settle():
        x, p = (np.concatenate(c) for c in zip(*held))
        f = ahead.common(x, x + p)
        b = behind.common(mirror[x] - (x + p) + 1, mirror[x] - x + 1)
        good = (b < p) & (f + b >= np.maximum(p, min_length - p))
        x, p, f, b = x[good], p[good], f[good], b[good]
        found.append((x - b, x + p + f, p))

    for x, p in grid(begin, size):
        equal = np.flatnonzero(words[x] == words[x + p])
        held.append((x[equal], p[equal]))
        n_held += len(equal)
        if n_held >= CHUNK_PAIRS:
            settle()
            held, n_held = [], 0
    if held:
        settle()
    if not found:
        return (np.empty(0, np.int64),) * 3
    start, stop, period = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((period, stop, start))
    start, stop, period = start[order], stop[order], period[order]
    least = np.concatenate([[True], (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])])[:len(start)]
    start, stop, period = start[least], stop[least], period[least]
    order = np.lexsort((period, start))
    return start[order], stop[order], period[order]


#: (doc_id, number of words) -> places of the words to read instead, or None
Rewrite = Callable[[int | None, int], np.ndarray | None]

RUN_SCHEMA = ("doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, "
              "collapsed string")


def _analysed(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
    number: dict[bytes, int] = defaultdict(count().__next__)
    size = np.array([len(t) for t in texts], np.int64)
    words = np.full(int(size.sum()) + len(texts), -1, np.int32)
    begin = np.cumsum(size + 1) - size - 1
    for at, t in zip(begin.tolist(), texts):
        words[at:at + len(t)] = [number[w] for w in t]
    start, stop, period = find_runs(words, size)
    gone = np.zeros(len(words) + 1, np.int32)
    np.add.at(gone, start + period, 1)
    np.add.at(gone, stop, -1)
    kept = np.cumsum(gone[:-1]) == 0
    cuts = np.searchsorted(start, np.concatenate([begin, [len(words)]])).astype(np.int32)
    doc = np.repeat(np.arange(len(texts)), np.diff(cuts))
    collapsed = []
    for d, t in enumerate(texts):
        if cuts[d] < cuts[d + 1]:
            t = [t[i] for i in np.flatnonzero(kept[begin[d]:begin[d] + len(t)])]
        collapsed.append(b" ".join(t))
    runs = pa.ListArray.from_arrays(pa.array(cuts), pa.StructArray.from_arrays(
        [pa.array(start - begin[doc]), pa.array(stop - start), pa.array(period)], names=["start", "length", "period"]))
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(size), runs, pa.array(collapsed, pa.string())],
                                      names=["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row of ``docs``.

    ``collapsed`` is the text without the words that any run holds after its
    first ``period`` words.  ``rewrite`` may set other words in place of a
    document's own (to plant runs) before it is read.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held = [], [], 0
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                words = (t or b"").split()
                places = rewrite(i, len(words)) if rewrite else None
                if places is not None:
                    words = [words[k] for k in places.tolist()]
                if texts and held + len(words) > GROUP_WORDS:
                    yield _analysed(ids, texts)
                    ids, texts, held = [], [], 0
                ids.append(i)
                texts.append(words)
                held += len(words) + 1
        if texts:
            yield _analysed(ids, texts)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(read, RUN_SCHEMA)


def planted_period(doc_id: int | None, n: int) -> np.ndarray | None:
    """Fixed rule of the query: a tenth of the documents turn periodic from some word on; null ids do not."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([np.arange(a), a + np.arange(n - a) % p])


def run_digests(docs: DataFrame, rewrite: Rewrite | None = planted_period) -> DataFrame:
    """Per document: number of runs, the longest one, digests of all runs and of the collapsed text."""
    rows = periodic_runs(docs, rewrite)
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"),
                                                                 r["period"].alias("p"))))
    text = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    top = rows.withColumn("_top", longest)
    return top.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_top.s").alias("start"), (-F.col("_top.l")).alias("length"),
        F.col("_top.p").alias("period"), F.expr("(-1000 * _top.l) div _top.p").alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"), F.sha2(F.coalesce("collapsed", F.lit("")), 256).alias("collapsed_sha256"))
