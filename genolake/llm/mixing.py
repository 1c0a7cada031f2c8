"""Mixing sources to target weights: token blocks, multinomial draws, index permutations, a join by index.

*Targets.*  Sources in code point order (null last) weigh 5, 2, 1, 5, 2, 1, ...
and share the words of all documents by weight; none may exceed three times
its own size, and what it cannot use goes to the others by weight.  Sorted by
size over weight this is one running sum: a source is full when the share left
for it and its successors exceeds its limit.

*Blocks.*  A source's documents, in id order, are one sequence of words, cut
into blocks of a fixed length; only the last block is shorter.

*Draws.*  Every output shard draws how many of its slots each source gets: a
multinomial, by one uniform number a slot.  Over all shards the counts come to
within the draw's own deviation of the target; of a source that drew more than
its quota the surplus, evenly spaced over the whole mix, passes to the sources
short of theirs, so that quotas are met exactly and no block is taken a fourth
time.

*Index maps.*  The ``j``-th slot of a source takes its block
``perm(j mod blocks)``, another permutation for every ``j div blocks``: a
Feistel network over a grid ``a x b`` just larger than the number of full
blocks, walked until it falls inside.  The short last block comes last in each
round through a source, so part of a round is a whole number of blocks.
Slots and blocks are joined on (source, block).

Everything is DataFrame functions.  Uniform numbers are digests of (seed, name,
numbers), so reruns agree whatever the partitioning.  Running sums go over
written partitions (two levels); unpartitioned windows see one row a source.

Defined cases: null text has no words, and with it a document takes no part
(taken 0); null sources form one source; rows equal in id, text and source are
counted each (which of them is the first is not told apart); a null id is an
id like others, first in order.  No words at all: all targets and takes are 0.
An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import spread_salt, stored

#: Weights in order of the sources, and the most a source may repeat.
WEIGHTS, MAX_REPEATS = (5, 2, 1), 3
BLOCK_WORDS, SHARD_BLOCKS, SEED = 64, 1024, 11
GUIDE, WALK = 4096, 64
BROADCAST_SOURCES = 100_000
_BLANK = r"\x20\x09-\x0D"


def uniform(*parts: Column | str | int) -> Column:
    """60 pseudorandom bits of the parts."""
    text = F.concat_ws(":", *[(p if isinstance(p, Column) else F.lit(p)).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def word_count(text: Column) -> Column:
    """Number of words: each, with the blanks before it, becomes one character (no list of words is built)."""
    clipped = F.rtrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.length(F.regexp_replace(clipped, f"[{_BLANK}]*[^{_BLANK}]+", "x")).cast("long")


def _before(value: str, *keys: str, order: list) -> Column:
    """Sum of ``value`` over the earlier rows of the window."""
    w = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(*order)
    return F.coalesce(F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast where the counted rows allow it."""
    return F.broadcast(df) if rows <= BROADCAST_SOURCES else df


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``source, source_no, source_size, target`` from ``(source, size)`` rows; one row a source."""
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(Window.partitionBy().orderBy(F.col("source").asc_nulls_last())) - 1
    s = s.withColumn("source_no", number.cast("int"))
    dec = lambda c: F.col(c).cast("decimal(38,0)")
    s = (s.withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), F.col("source_no") % len(weights) + 1).cast("long"))
         .withColumn("_limit", F.col("source_size") * max_repeats))
    order = [F.col("_limit") / F.col("_w"), F.col("source_no")]
    every = Window.partitionBy()
    s = (s.withColumn("_limits", _before("_limit", order=order)).withColumn("_ws", _before("_w", order=order))
         .withColumn("_all", F.sum("source_size").over(every)).withColumn("_all_w", F.sum("_w").over(every)))
    full = (dec("_all") - dec("_limits")) * dec("_w") > dec("_limit") * (dec("_all_w") - dec("_ws"))
    s = (s.withColumn("_full", full)
         .withColumn("_left", F.col("_all") - F.sum(F.when(F.col("_full"), F.col("_limit")).otherwise(0)).over(every))
         .withColumn("_left_w", F.sum(F.when(F.col("_full"), 0).otherwise(F.col("_w"))).over(every)))
    share = F.col("_left").cast("double") * F.col("_w") / F.col("_left_w").cast("double")
    return s.select("source", "source_no", "source_size",
                    F.when(F.col("_full"), F.col("_limit").cast("double")).otherwise(share).alias("target"), "_full")


def with_quotas(targets: DataFrame, block_words: int = BLOCK_WORDS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Adds each source's blocks, its quota of slots, and where its slots begin (one row a source)."""
    size, b = F.col("source_size"), F.lit(block_words)
    t = (targets.withColumn("full_blocks", F.expr(f"source_size div {block_words}"))
         .withColumn("blocks", F.ceil(size / b).cast("long"))
         .withColumn("_rounds", F.when(F.col("_full"), F.lit(max_repeats))
                     .otherwise(F.floor(F.col("target") / F.greatest(size, F.lit(1)))).cast("long"))
         .withColumn("_rest", F.greatest(F.col("target") - F.col("_rounds") * size, F.lit(0.0)))
         .withColumn("_k", F.least(F.floor(F.col("_rest") / b + 0.5), F.col("full_blocks"))))
    last = (F.col("blocks") > F.col("full_blocks")) & (size - F.col("_rest") < F.abs(F.col("_rest") - F.col("_k") * b))
    t = t.withColumn("quota", F.col("_rounds") * F.col("blocks") + F.when(last, F.col("blocks")).otherwise(F.col("_k")))
    side = F.greatest(F.ceil(F.sqrt(F.col("full_blocks").cast("double"))), F.lit(1)).cast("long")
    return (t.withColumn("_a", side).withColumn("_b", F.greatest(F.ceil(F.col("full_blocks") / F.col("_a")), F.lit(1)).cast("long"))
            .withColumn("first_slot", _before("quota", order=[F.col("source_no")]))
            .drop("_rounds", "_rest", "_k", "_full"))


def _lookup(rows: DataFrame, at: str, ranges: DataFrame, begin: str, length: str, total: int, n_ranges: int,
            keep: list[Column], how: str = "inner") -> DataFrame:
    """Each row with the range ``[begin, begin + length)`` that holds its number ``at``.

    Numbers are cut into at most ``GUIDE`` steps; a range is listed under each
    step it touches, so a row meets its step's few ranges by an equi-join.
    """
    step = max(1, -(-total // GUIDE))
    guide = (ranges.where(F.col(length) > 0)
             .select(F.col(begin).alias("_lo"), (F.col(begin) + F.col(length)).alias("_hi"), *keep)
             .withColumn("_step", F.explode(F.expr(f"sequence(_lo div {step}, (_hi - 1) div {step})"))))
    cond = (F.expr(f"{at} div {step}") == F.col("_step")) & (F.col(at) >= F.col("_lo")) & (F.col(at) < F.col("_hi"))
    return rows.join(_small(guide, n_ranges + GUIDE), cond, how).drop("_lo", "_hi", "_step")


def drawn_slots(sources: DataFrame, slots: int, n_sources: int, shard_blocks: int = SHARD_BLOCKS, seed: int = SEED) -> DataFrame:
    """``slot, shard, source_no, nth``: every slot's source and its number among that source's slots.

    Shard counts are multinomial; the sources' quotas are met exactly (see above).
    """
    spark = sources.sparkSession
    ids = spark.range(slots) if slots <= 1 << 23 else spark.range(0, slots, numPartitions=slots >> 20)
    ids = ids.select(F.col("id").alias("slot"), F.expr(f"id div {shard_blocks}").alias("shard"),
                     (uniform(seed, "slot", F.col("id")) % max(slots, 1)).alias("_u"))
    drawn = _lookup(ids, "_u", sources, "first_slot", "quota", slots, n_sources, [F.col("source_no")]).drop("_u")
    counts = drawn.groupBy("source_no", "shard").agg(F.count(F.lit(1)).alias("n")).withColumn("_g", F.expr("shard div 1024"))
    groups = (counts.groupBy("source_no", "_g").agg(F.sum("n").alias("_n"))
              .withColumn("_base", _before("_n", "source_no", order=[F.col("_g")])).drop("_n"))
    offsets = (counts.withColumn("_in", _before("n", "source_no", "_g", order=[F.col("shard")])).join(groups, ["source_no", "_g"])
               .select("source_no", "shard", (F.col("_base") + F.col("_in")).alias("_off")))
    # a source beyond its quota gives its surplus, evenly spaced among its slots, to those short of theirs
    total = counts.groupBy("source_no").agg(F.sum("n").alias("_got"))
    order = [F.col("source_no")]
    settled = (sources.join(total, "source_no", "left").withColumn("_got", F.coalesce("_got", F.lit(0)))
               .withColumn("_over", F.greatest(F.col("_got") - F.col("quota"), F.lit(0)))
               .withColumn("_short", F.greatest(F.col("quota") - F.col("_got"), F.lit(0)))
               .withColumn("_over_at", _before("_over", order=order)).withColumn("_short_at", _before("_short", order=order)))
    settled = stored(settled.select("source_no", "_got", "_over", "_over_at", "_short", "_short_at"), "mix-settled")
    rank = F.row_number().over(Window.partitionBy("source_no", "shard").orderBy("slot")) - 1
    nth = (drawn.withColumn("_rank", rank).join(offsets, ["source_no", "shard"])
           .withColumn("_n", F.col("_off") + F.col("_rank"))
           .join(_small(settled.select("source_no", "_got", "_over", "_over_at"), n_sources), "source_no")
           .withColumn("_given", F.expr("(_n * _over) div _got"))
           .withColumn("_gives", F.when(F.expr("((_n + 1) * _over) div _got") > F.col("_given"), F.col("_over_at") + F.col("_given")))
           .select("slot", "shard", "source_no", (F.col("_n") - F.col("_given")).alias("nth"), "_gives"))
    given = settled.agg(F.coalesce(F.sum("_short"), F.lit(0)).alias("n")).first()["n"]
    moved = _lookup(nth, "_gives", settled, "_short_at", "_short", given, n_sources,
                    [F.col("source_no").alias("_to"), F.col("_got").alias("_to_got"), F.col("_short_at").alias("_to_at")], "left")
    to = F.col("_gives").isNotNull()
    return moved.select("slot", "shard", F.when(to, F.col("_to")).otherwise(F.col("source_no")).alias("source_no"),
                        F.when(to, F.col("_to_got") + F.col("_gives") - F.col("_to_at")).otherwise(F.col("nth")).alias("nth"))


def with_blocks(slots: DataFrame, sources: DataFrame, n_sources: int, seed: int = SEED) -> DataFrame:
    """Adds ``block``: the place of the source's ``nth`` slot under its permutations."""
    per = sources.select("source_no", "blocks", "full_blocks", "_a", "_b")
    s = slots.join(_small(per, n_sources), "source_no").withColumn("_round", F.expr("nth div blocks")) \
        .withColumn("_x", F.expr("nth % blocks"))
    a, b = F.col("_a"), F.col("_b")

    def mixed(i: int, value: Column) -> Column:
        return uniform(seed, "block", F.col("source_no"), F.col("_round"), i, value)

    def network(x: Column) -> Column:
        left, right = F.floor(x / b).cast("long"), x % b
        left = (left + mixed(1, right)) % a
        right = (right + mixed(2, left)) % b
        left = (left + mixed(3, right)) % a
        right = (right + mixed(4, left)) % b
        return left * b + right

    s = (s.withColumn("_l0", F.expr("_x div _b")).withColumn("_r0", F.expr("_x % _b"))
         .withColumn("_l1", (F.col("_l0") + mixed(1, F.col("_r0"))) % a).withColumn("_r1", (F.col("_r0") + mixed(2, F.col("_l1"))) % b)
         .withColumn("_l2", (F.col("_l1") + mixed(3, F.col("_r1"))) % a).withColumn("_r2", (F.col("_r1") + mixed(4, F.col("_l2"))) % b)
         .withColumn("_y", F.col("_l2") * b + F.col("_r2")))
    # the grid has fewer than _a places beyond the blocks, so a walk of 64 steps can only fail on a grid far over 64 x 64
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), F.col("_y"),
                         lambda y, _: F.when(y < F.col("full_blocks"), y).otherwise(network(y)))
    y = F.when(F.col("_x") >= F.col("full_blocks"), F.col("_x")).when(F.col("_y") < F.col("full_blocks"), F.col("_y")) \
        .otherwise(walked)
    s = s.withColumn("_block", y)
    lost = F.raise_error(F.lit("a block's index walked too long")).cast("long")
    return s.select("slot", "shard", "source_no", "nth",
                    F.when(F.col("_block") < F.col("blocks"), F.col("_block")).otherwise(lost).alias("block"))


@dataclass
class Mix:
    """A mix of documents: what was measured, what is taken, and from where."""

    docs: DataFrame  # the documents mixed
    placed: DataFrame  # row, source_no, doc_id, text_hash, size, start: a row a document
    sources: DataFrame  # a row a source: source, sizes, target, blocks, quota
    slots: DataFrame  # slot, shard, source_no, nth, block
    n_sources: int
    block_words: int

    def segments(self) -> DataFrame:
        """The blocks: ``source_no, block, row, doc_id, first_word, n_words``, a row for a document's part of a block."""
        b = self.block_words
        cut = (self.placed.where("size > 0")
               .withColumn("block", F.explode(F.expr(f"sequence(start div {b}, (start + size - 1) div {b})"))))
        return cut.select("source_no", "block", "row", "doc_id", "text_hash", "start",
                          F.greatest(F.expr(f"block * {b} - start"), F.lit(0)).cast("long").alias("first_word"),
                          F.expr(f"least((block + 1) * {b}, start + size) - greatest(block * {b}, start)").alias("n_words"))

    def mixed(self) -> DataFrame:
        """The mix: ``shard, slot`` with the document parts of the block it takes."""
        return self.slots.join(self.segments(), ["source_no", "block"])

    def texts(self) -> DataFrame:
        """``shard, slot, source, words``: the mix itself, every slot's words in order."""
        texts = (self.docs.select(F.col("doc_id").cast("long").alias("_d"), F.coalesce("text", F.lit("")).alias("_t"))
                 .withColumn("_h", F.xxhash64("_t")).dropDuplicates(["_d", "_h"])
                 .withColumn("_w", F.explode(F.array(F.regexp_extract_all("_t", F.lit(f"([^{_BLANK}]+)"))))).drop("_t"))
        parts = self.mixed().join(texts, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_h")))
        words = F.slice("_w", F.col("first_word").cast("int") + 1, F.col("n_words").cast("int"))
        rows = (parts.groupBy("shard", "slot", "source_no")
                .agg(F.array_sort(F.collect_list(F.struct(F.col("start"), words.alias("w")))).alias("_p"))  # a block's parts
                .withColumn("words", F.flatten(F.transform("_p", lambda p: p["w"]))))
        names = self.sources.select("source_no", "source")
        return rows.join(_small(names, self.n_sources), "source_no").select("shard", "slot", "source", "words")

    def taken(self) -> DataFrame:
        """``doc_id, size, source_size, target, taken``: words the mix takes of each document, repeats counted."""
        rows = self.placed.select("row", "source_no", "doc_id", "size", F.lit(0).cast("long").alias("n_words")).unionByName(
            self.mixed().select("row", "source_no", "doc_id", F.lit(0).cast("long").alias("size"), "n_words"))
        out = rows.groupBy("row", "source_no", "doc_id").agg(F.sum("size").alias("size"), F.sum("n_words").alias("taken"))
        per = self.sources.select("source_no", "source_size", "target")
        return out.join(_small(per, self.n_sources), "source_no").select("doc_id", "size", "source_size", "target", "taken")


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS, seed: int = SEED,
        weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> Mix:
    """Plan a mix of ``docs(doc_id, text, source)``; word counts are taken once and written."""
    sized = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                               word_count(F.col("text")).alias("size"),
                               F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")), "mix-sizes")
    sources = stored(with_quotas(source_targets(sized, weights, max_repeats), block_words, max_repeats), "mix-sources")
    totals = sources.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("quota"), F.lit(0)).alias("slots")).first()
    keys = ["source_no", "doc_id", "text_hash", "size"]
    numbered = sized.join(_small(sources.select("source", "source_no"), totals["n"]).withColumnRenamed("source", "_s"),
                          F.col("source").eqNullSafe(F.col("_s"))).select(*keys)
    placed = stored(numbered.withColumn("_salt", spread_salt(1024)).repartitionByRange(*keys, "_salt")
                    .sortWithinPartitions(*keys, "_salt").drop("_salt")
                    .withColumn("row", F.monotonically_increasing_id()), "mix-placed") \
        .withColumn("_part", F.shiftright("row", 33))
    base = (placed.groupBy("source_no", "_part").agg(F.sum("size").alias("_n"))
            .withColumn("_base", _before("_n", "source_no", order=[F.col("_part")])).drop("_n"))
    starts = (placed.withColumn("_in", _before("size", "source_no", "_part", order=[F.col("row")]))
              .join(base, ["source_no", "_part"]).withColumn("start", F.col("_base") + F.col("_in"))
              .select("row", "source_no", "doc_id", "text_hash", "size", "start"))
    starts = stored(starts, "mix-starts")
    slots = with_blocks(drawn_slots(sources, totals["slots"], totals["n"], shard_blocks, seed), sources, totals["n"], seed)
    return Mix(docs, starts, sources, slots, totals["n"], block_words)
