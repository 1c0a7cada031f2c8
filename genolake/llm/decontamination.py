"""Benchmark decontamination with a positional inverted index.

Indexing.  Documents are cut into segments (the consecutive documents of one
scan task, about ``SEGMENT_WORDS`` words each).  A segment is one row of a
stored table: its documents, and for every term the sorted word positions at
which it occurs.  Positions run on through the segment, with a gap between
documents, so no phrase crosses a document.  Only terms of the test set are
posted: no other term can take part in a match.  Nothing is shuffled.

Matching.  Corpus frequencies of the test terms are summed over the segments.
Each test phrase then intersects its offset-adjusted posting lists, starting
with its rarest terms, inside every segment; a phrase with a term the segment
lacks ends at once.  Proximity matches ask only that every term lies within
``slop`` words of its place in the phrase.

Size.  The test set is dealt into blocks of at most ``BLOCK_ITEMS`` items and
``MAX_BLOCK_CHARS`` characters on Spark (an item larger than that is a block of
its own) and read to the driver one block at a time, each of which costs a pass
over the corpus; a block's vocabulary frequencies are the only other thing
gathered there.  The index grows with the corpus and stays distributed.

Defined cases: a null or empty text has no words (its document is returned
with zeros, its item never occurs); repeated documents are matched each on
their own; repeated items count by distinct ``item_id``, and items without an id
as one whose id is the empty text; empty tables give empty or all-clean
results; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, stored, with_tag

WINDOW = 10
SEGMENT_WORDS = 2_000_000
BLOCK_ITEMS = 20_000
MAX_BLOCK_CHARS = 64_000_000

#: Byte map: A-Z to a-z, digits and bytes of non-ASCII characters kept, the rest to blanks.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
              for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) runs of ASCII digits, letters and non-ASCII characters."""
    return (text or "").encode().translate(_FOLD).split()


class Phrases:
    """Distinct windows of a block of items, as term-id tuples over a local vocabulary."""

    def __init__(self, items: list[tuple], window: int = WINDOW):
        self.vocab: dict[bytes, int] = {}
        index: dict[tuple, int] = {}
        owners: list[set] = []
        for item_id, text in items:
            ids = tuple(self.vocab.setdefault(w, len(self.vocab)) for w in words_of(text))
            if not ids:
                continue
            size = min(window, len(ids))
            for i in range(len(ids) - size + 1):
                at = index.setdefault(ids[i:i + size], len(index))
                if at == len(owners):
                    owners.append(set())
                owners[at].add("" if item_id is None else str(item_id))
        self.phrases = list(index)
        self.owners = [sorted(o) for o in owners]

    def rarest_first(self, frequency: dict[int, int]) -> list[tuple[tuple[int, int], ...]]:
        """Each phrase as (offset, term) pairs, rarest term of the corpus first."""
        return [tuple(sorted(enumerate(p), key=lambda ot: (frequency.get(ot[1], 0), ot[0]))) for p in self.phrases]


INDEX_SCHEMA = ("segment string, doc_ids array<long>, tags array<long>, starts array<long>, n_words array<long>, "
                "terms array<int>, counts array<long>, positions array<long>")


def build_index(docs: DataFrame, vocab: dict[bytes, int], gap: int, segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """The postings of ``vocab``'s terms, one row per segment, stored; all documents are listed."""

    def segment(name: str, doc_ids: list, tags: list, lengths: list, parts: list) -> dict:
        starts = np.concatenate([[0], np.cumsum(np.asarray(lengths[:-1], np.int64) + gap)]) if lengths else []
        ids = np.concatenate([p for p, _ in parts]) if parts else np.empty(0, np.int32)
        at = np.concatenate([p + s for (_, p), s in zip(parts, starts)]) if parts else np.empty(0, np.int64)
        order = np.argsort(ids, kind="stable")
        terms, counts = np.unique(ids, return_counts=True)
        return {"segment": name, "doc_ids": doc_ids, "tags": tags, "starts": np.asarray(starts, np.int64), "n_words": lengths,
                "terms": terms.astype(np.int32), "counts": counts.astype(np.int64), "positions": at[order]}

    schema = pa.schema([("segment", pa.string()), ("doc_ids", pa.list_(pa.int64())), ("tags", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64())),
                        ("n_words", pa.list_(pa.int64())), ("terms", pa.list_(pa.int32())),
                        ("counts", pa.list_(pa.int64())), ("positions", pa.list_(pa.int64()))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, k = TaskContext.get().partitionId(), 0
        doc_ids, tags, lengths, parts, total = [], [], [], [], 0
        lookup = vocab.get

        def close():
            row = segment(f"{task}-{k}", doc_ids, tags, lengths, parts)
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for b in batches:
            for doc_id, text, tag in zip(b.column(0), b.column(1), b.column(2)):
                words = words_of(text.as_py())
                ids = np.fromiter((lookup(w, -1) for w in words), np.int32, len(words))
                at = np.flatnonzero(ids >= 0)
                doc_ids.append(doc_id.as_py())
                tags.append(tag.as_py())
                lengths.append(len(words))
                parts.append((ids[at], at))
                total += len(words)
                if total >= segment_words:
                    yield close()
                    doc_ids, tags, lengths, parts, total, k = [], [], [], [], 0, k + 1
        if doc_ids:
            yield close()

    return stored(with_tag(id_text(docs)).mapInArrow(cut, INDEX_SCHEMA), "postings")


def term_frequencies(index: DataFrame) -> dict[int, int]:
    """Corpus occurrences of each posted term: one row per term of the test set."""
    x = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("x"))
    return {r["t"]: r["n"] for r in x.groupBy(F.col("x.terms").alias("t")).agg(F.sum("x.counts").alias("n")).collect()}


def phrase_starts(plan: tuple, postings: dict[int, np.ndarray], slop: int = 0) -> np.ndarray:
    """Positions at which a phrase starts; ``plan`` is its (offset, term) pairs, rarest first."""
    if any(t not in postings for _, t in plan):
        return np.empty(0, np.int64)
    starts: np.ndarray | None = None
    for offset, term in plan:
        at = postings[term] - offset
        if starts is None:
            starts = at
            continue
        low = np.searchsorted(at, starts - slop)
        ok = low < len(at)
        ok[ok] = at[low[ok]] <= starts[ok] + slop
        starts = starts[ok]
        if not len(starts):
            break
    return starts


MATCH_SCHEMA = "doc_id long, tag long, doc_row long, segment string, n_words long, hits array<long>, items array<string>"


def find_phrases(index: DataFrame, phrases: Phrases, frequency: dict[int, int], slop: int = 0) -> DataFrame:
    """Per document: hit word positions (within the document) and the ids of items that occur.

    With ``slop`` 0 the matches are exact phrases; otherwise each term must lie
    within ``slop`` words of its place (and inside the document).
    """
    plans, owners = phrases.rarest_first(frequency), phrases.owners

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = {n: b.column(j)[i].values.to_numpy(zero_copy_only=False) for j, n in enumerate(b.schema.names)
                       if n not in ("segment", "doc_ids", "tags")}
                doc_ids = b.column(b.schema.get_field_index("doc_ids"))[i].values  # may hold nulls
                tags = b.column(b.schema.get_field_index("tags"))[i].values
                ends = np.cumsum(row["counts"])
                postings = {int(t): row["positions"][e - c:e] for t, e, c in zip(row["terms"], ends, row["counts"])}
                starts, lengths = row["starts"], row["n_words"]
                spans, found = [], {}
                for p, plan in enumerate(plans):
                    at = phrase_starts(plan, postings, slop)
                    if not len(at):
                        continue
                    doc = np.searchsorted(starts, np.maximum(at, 0), side="right") - 1
                    inside = (at >= starts[doc]) & (at + len(plan) <= starts[doc] + lengths[doc])
                    at, doc = at[inside], doc[inside]
                    if len(at):
                        spans.append((at[:, None] + np.arange(len(plan))).ravel())
                    for d in np.unique(doc):
                        found.setdefault(int(d), set()).update(owners[p])
                hit = np.unique(np.concatenate(spans)) if spans else np.empty(0, np.int64)
                lo, hi = np.searchsorted(hit, starts), np.searchsorted(hit, starts + lengths)
                name = b.column(0)[i].as_py()
                n = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [doc_ids, tags, pa.array(np.arange(n)), pa.array([name] * n, pa.string()),
                     pa.array(lengths, pa.int64()),
                     pa.array([hit[a:z] - s for a, z, s in zip(lo, hi, starts)], pa.list_(pa.int64())),
                     pa.array([sorted(map(str, found.get(d, ()))) for d in range(n)], pa.list_(pa.string()))],
                    names=["doc_id", "tag", "doc_row", "segment", "n_words", "hits", "items"])

    return index.mapInArrow(match, MATCH_SCHEMA)


def item_blocks(benchmark: DataFrame) -> list[DataFrame]:
    """The test set's distinct items in blocks that fit the driver: one, unless it is large."""
    items = benchmark.select("item_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    size = items.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")).first()
    blocks = max(-(-size["n"] // BLOCK_ITEMS), -(-(size["chars"] or 0) // MAX_BLOCK_CHARS))
    if blocks <= 1:
        return [items]
    # Items are dealt to small slots by hash; consecutive slots are put together while they fit.
    items = stored(items.distinct().withColumn("slot", F.pmod(F.xxhash64("item_id", "text"), F.lit(64 * blocks))), "items")
    sizes = items.groupBy("slot").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")).collect()
    starts, n, chars = [], BLOCK_ITEMS, MAX_BLOCK_CHARS
    for r in sorted(sizes):
        n, chars = n + r["n"], chars + r["chars"]
        if not starts or n > BLOCK_ITEMS or chars > MAX_BLOCK_CHARS:
            starts.append(r["slot"])
            n, chars = r["n"], r["chars"]
    return [items.where((F.col("slot") >= lo) & (F.col("slot") < hi)).drop("slot")
            for lo, hi in zip(starts, [*starts[1:], 64 * blocks])]


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """Per document row: ``doc_id, n_words, hits`` (word positions), ``items`` (ids as sorted strings)."""
    return matched_rows(docs, benchmark, window, slop).drop("tag")


def matched_rows(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """Per document row: ``doc_id, tag`` (hash of the text), ``n_words, hits`` (word positions), ``items`` (ids as sorted strings).

    Items are taken one block at a time; the blocks' findings meet by document
    id and text hash.  That key lies in the data, so it does not matter how a
    pass cuts its input: rows equal in both have equal findings, and come back
    as often as they are there.
    """
    blocks = item_blocks(benchmark)
    out = None
    for block in blocks:
        phrases = Phrases(sorted((tuple(r) for r in block.collect()), key=str), window)
        index = build_index(docs, phrases.vocab, gap=window + slop + 1)
        found = find_phrases(index, phrases, term_frequencies(index), slop)
        if len(blocks) > 1:  # written: the driver lets go of the block
            found = stored(found.groupBy("doc_id", "tag", "n_words").agg(
                F.count(F.lit(1)).alias("copies"), F.first("hits").alias("hits"), F.first("items").alias("items")), "matches")
        out = found if out is None else out.unionByName(found)
    if len(blocks) > 1:  # a row a block and distinct document
        out = out.groupBy("doc_id", "tag", "n_words").agg(
            F.max("copies").alias("copies"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("hits"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return out.select("doc_id", "tag", "n_words", "hits", "items")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    m = matches(docs, benchmark, window)
    return m.select("doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"),
                    F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
                    (F.size("hits") > 0).alias("contaminated"))
