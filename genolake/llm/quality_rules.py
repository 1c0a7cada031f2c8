"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document.  The ledger stores the raw
measurements and one ``failures`` bit per failed rule; a policy is a named,
versioned set of rules, applied to the stored ledger with one bitwise test,
and the effect of each rule (ablation) is counted from the same bits without
touching a text again.

Measurements of a document (null text: as empty; all counts 0):
``n_words`` words split at ASCII white space, ``word_chars`` code points in
words, ``n_symbols`` characters of ``#*$%&|<>``, ``n_lines`` lines with a
word, ``n_dup_lines`` of them equal to an earlier line, ``n_repeat_words``
words lying in a 3-word window that occurs at least twice in the text,
``n_shout`` exclamation marks.  Repeated rows are measured each on its own;
an empty table gives an empty ledger; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text, stored

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_shout"]

#: rule name -> failing condition; a rule's bit is its place in this mapping.
RULES: dict[str, Column | None] = dict.fromkeys(
    ["few_words", "repeated_words", "symbols", "duplicate_lines", "shouting", "short_words", "long_words"])


def failing(rule: str) -> Column:
    """Integer conditions, so the verdict never depends on rounding."""
    w, c = F.col("n_words"), F.col
    return {
        "few_words": w < 50,
        "repeated_words": 100 * c("n_repeat_words") > 50 * w,
        "symbols": 10 * c("n_symbols") > w,
        "duplicate_lines": 100 * c("n_dup_lines") > 30 * c("n_lines"),
        "shouting": 10 * c("n_shout") > w,
        "short_words": c("word_chars") < 2 * w,
        "long_words": c("word_chars") > 20 * w,
    }[rule]


def bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(bit(r) for r in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_words"))
STANDARD = Policy("standard", 1, tuple(RULES))

_SYMBOLS, _BLANKS = b"#*$%&|<>", b" \t\n\r\x0b\x0c"


def measure(text: str) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``."""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    chars = len(text) - len(raw) + len(raw.translate(None, _BLANKS))
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        seen, covered = Counter(windows), bytearray(n)
        for i, w in enumerate(windows):
            if seen[w] > 1:
                covered[i:i + 3] = b"\1\1\1"
        repeated = sum(covered)
    return n, chars, symbols, len(lines), len(lines) - len(set(lines)), repeated, raw.count(b"!")


def _measure_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [measure(t.as_py()) for t in b.column(1)]
        cols = zip(*rows) if rows else [[] for _ in MEASURES]
        yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in cols)],
                                         names=["doc_id", *MEASURES])


def ledger(docs: DataFrame) -> DataFrame:
    """``doc_id``, the measurements and ``failures`` (bit i: rule i failed). No shuffle."""
    schema = "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES)
    out = id_text(docs).mapInArrow(_measure_batches, schema)
    bits = [F.when(failing(r), F.lit(bit(r))).otherwise(F.lit(0)).cast("long") for r in RULES]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return out.withColumn("failures", total)


def apply_policy(led: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with ``kept``: no rule of the policy failed."""
    return led.withColumn("kept", F.col("failures").bitwiseAND(F.lit(policy.mask)) == 0)


def ablations(led: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: documents it rejects, rejects alone, and kept without it.

    One aggregation over the stored bits: failing documents are first counted
    by their bit pattern (at most 2^rules groups), then by rule.
    """
    masked = F.col("failures").bitwiseAND(F.lit(policy.mask))
    patterns = led.groupBy(masked.alias("bits")).agg(F.count(F.lit(1)).alias("docs"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(bit(r)).cast("long").alias("bit"))
                                for r in policy.rules])).alias("r")
    x = patterns.select("bits", "docs", rules)
    hit, alone = F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("bits") == F.col("r.bit")

    def docs_if(c: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(c, F.col("docs"))), F.lit(0)).alias(name)

    return x.groupBy(F.col("r.rule").alias("rule")).agg(
        docs_if(hit, "rejected"), docs_if(alone, "rejected_alone"),
        docs_if(alone | (F.col("bits") == 0), "kept_without"))


def rule_verdicts(docs: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """Ledger stored once, then the base and the given policy read from its bits."""
    led = stored(ledger(docs), "quality-ledger")
    out = apply_policy(led, policy)
    base_failed = F.col("failures").bitwiseAND(F.lit(BASE.mask)) != 0
    return out.withColumn("base_failed", base_failed).withColumn("kept", F.col("kept") & ~base_failed)
