"""Toxicity by a weighted lexicon.

Folding: compatibility forms taken apart (NFKD: mathematical, full-width and
accented letters), combining marks and format characters (zero-width ones, soft
hyphens) dropped, lower case, look-alike letters of other scripts and digit or
sign substitutions read as the letters they imitate (``1`` stands for i and l
alike, so these two fold together), everything else a blank.  ``fold_places``
gives the place in the text of every folded character.

Lexicon: word stems (a stem matches at the start of a word) with weights.  An
Aho-Corasick automaton finds all stems in one pass; per word the heaviest stem
counts once.  A match inside an exception phrase does not count.  The summed
weight is normalised by the number of words; a logistic curve over that
density and the total turns it into a score.

Learning (only outside the held-out fold, at most ``PER_CLASS`` documents per
class): Spark counts in how many document families of each class a stem
occurs (near copies share a family: the least hash over their word triples).
Stems much more frequent in toxic documents stay, unless a shorter stem that is
kept already tells as much; phrases around a stem that occur in clean documents
only become exceptions.  Every stem and phrase over the thresholds is taken: a
share of the sample's families must hold it, which bounds their number.  Of a
family the text with the least hash (then id) speaks, so the fit is the same in
every run; the sample is written once.

Defined cases: null or empty texts have no match and get the base score;
without training rows the score is 0; repeated rows score alike; extra
columns are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, stored
from .labelled import collected, held_out, training_rows

PER_CLASS = 8192
STEM_SIZES = (3, 4, 5, 6, 7, 8)
MIN_FAMILIES = 6
MIN_SHARE = 0.004
MIN_RATIO = 12.0
THRESHOLD = 0.3

#: Letters of other scripts and signs that pass for Latin letters (fixed values).
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y",
    "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ɡ": "g", "ı": "i", "ℓ": "l", "ո": "n",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "σ": "s", "τ": "t",
    "υ": "u", "χ": "x", "ω": "w", "ß": "s", "ø": "o", "ł": "l", "đ": "d",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
}


#: Blocks of combining marks for letters of any script.
MARKS = [*range(0x300, 0x370), *range(0x1AB0, 0x1B00), *range(0x1DC0, 0x1E00), *range(0x20D0, 0x2100), *range(0xFE20, 0xFE30)]


def _fold_table() -> dict[int, str | None]:
    out: dict[int, str | None] = {cp: " " for cp in range(0x80) if not chr(cp).isalpha()}
    out |= {cp: " " for cp in [*range(0x80, 0x250), *range(0x2000, 0x2070)] if not chr(cp).isalpha()}
    out |= {ord(k): v for k, v in LOOKALIKES.items()}
    out = {cp: "i" if v == "l" else v for cp, v in out.items()} | {ord("l"): "i"}
    dropped = [cp for cp in [*range(0x20000), *range(0xE0000, 0xE0200)] if unicodedata.category(chr(cp)) == "Cf"]
    return out | dict.fromkeys([*MARKS, *dropped])


_FOLD = _fold_table()


def fold(text: str) -> str:
    """Folded text."""
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text)
    return text.lower().translate(_FOLD)


def fold_places(text: str) -> tuple[str, list[int]]:
    """Folded text and, of each of its characters, the place in ``text`` of the character it came from."""
    parts = [fold(c) for c in text]
    return "".join(parts), [i for i, p in enumerate(parts) for _ in p]


@dataclass
class Lexicon:
    stems: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    curve: tuple[float, float, float] = (-4.0, 1.0, 1.0)

    def automaton(self):
        import ahocorasick

        a = ahocorasick.Automaton()
        for s, w in self.stems.items():
            a.add_word(" " + s, (len(s) + 1, w))
        for e in self.exceptions:
            a.add_word(" " + e, (len(e) + 1, None))
        if len(a):
            a.make_automaton()
        return a


def hits(folded: str, automaton) -> dict[int, float]:
    """Start of each matched word in ``folded`` and the heaviest weight there, exceptions left out."""
    if not len(automaton):
        return {}
    found: dict[int, float] = {}
    spared: list[tuple[int, int]] = []
    for end, (size, weight) in automaton.iter(" " + folded):
        start = end - size + 1
        if weight is None:
            spared.append((start, end))
        elif weight > found.get(start, 0.0):
            found[start] = weight
    for lo, hi in spared:
        for s in [s for s in found if lo <= s < hi]:
            del found[s]
    return found


def features(total: float, n_words: int) -> tuple[float, float]:
    return math.log1p(total), math.log1p(100.0 * total / max(n_words, 1))


def logistic(x: np.ndarray, curve: tuple[float, float, float]) -> np.ndarray:
    z = curve[0] + x @ np.asarray(curve[1:])
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def _family(words: list[str]) -> int:
    if len(words) < 3:
        return zlib.crc32(" ".join(words).encode())
    return min(zlib.crc32(" ".join(t).encode()) for t in zip(words, words[1:], words[2:]))


def _families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        folded = [fold(t.as_py()) for t in b.column(1)]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(folded, pa.string()), b.column(2),
             pa.array([_family(f.split()) for f in folded], pa.int64())],
            names=["doc_id", "folded", "label", "family"])


def _count_stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tally: dict[int, Counter] = {0: Counter(), 1: Counter()}

    def flush():
        for label, c in tally.items():
            if c:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), pa.string()), pa.array([label] * len(c), pa.int32()),
                     pa.array(list(c.values()), pa.int64())], names=["stem", "label", "n"])
            c.clear()

    for b in batches:
        for folded, label in zip(b.column(0), b.column(1)):
            words = set(folded.as_py().split())
            tally[label.as_py()].update({w[:k] for w in words for k in STEM_SIZES if len(w) >= k} | words)
        if sum(map(len, tally.values())) > 2_000_000:
            yield from flush()
    yield from flush()


def pick_stems(counts: list[tuple[str, int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Stems with weights from ``(stem, toxic families, clean families)``.

    A stem gives way to a longer one that nearly all its toxic families have
    ("idi" to "idiot"); a longer stem that tells hardly more than a kept
    shorter one is dropped.
    """
    least = max(MIN_FAMILIES, MIN_SHARE * toxic)
    rated = {}
    for stem, a, b in counts:
        ratio = ((a + 0.5) / (toxic + 1)) / ((b + 0.5) / (clean + 1))
        if a >= least and ratio >= MIN_RATIO:
            rated[stem] = (a, b, math.log(ratio))
    for stem in sorted(rated, key=len, reverse=True):
        for k in range(len(stem) - 1, 0, -1):
            if stem[:k] in rated and stem in rated and rated[stem][0] >= 0.95 * rated[stem[:k]][0]:
                del rated[stem[:k]]
    kept: dict[str, float] = {}
    for stem in sorted(rated, key=lambda s: (len(s), s)):
        a, b, w = rated[stem]
        shorter = [kept[stem[:k]] for k in range(1, len(stem)) if stem[:k] in kept]
        if not shorter or w > max(shorter) + 1.0:
            kept[stem] = w
    return {s: kept[s] for s in sorted(kept)}


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS) -> Lexicon:
    """Lexicon, exceptions and curve from the bounded training sample."""
    sample = training_rows(docs, labels, label, per_class).mapInArrow(
        _families, "doc_id long, folded string, label int, family long")
    first = F.min(F.struct(F.xxhash64("folded").alias("h"), "doc_id", "folded")).alias("f")
    sample = stored(sample.groupBy("family", "label").agg(first)
                    .select(F.col("f.doc_id").alias("doc_id"), F.col("f.folded").alias("folded"), "label"), "toxicity-sample")
    size = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    if not toxic or not clean:
        return Lexicon({}, curve=(-30.0, 0.0, 0.0))
    least = max(MIN_FAMILIES, MIN_SHARE * toxic)
    counts = (sample.select("folded", "label").mapInArrow(_count_stems, "stem string, label int, n long")
              .groupBy("stem").agg(F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("a"),
                                   F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("b"))
              .where((F.col("a") >= least)
                     & ((F.col("a") + 0.5) / (toxic + 1) >= MIN_RATIO * (F.col("b") + 0.5) / (clean + 1)))
              .orderBy(F.col("a").desc(), "b", "stem"))
    lexicon = Lexicon(pick_stems([tuple(r) for r in counts.collect()], toxic, clean))
    lexicon.exceptions = _exceptions(sample, lexicon, least)
    lexicon.curve = _curve(sample, lexicon, 2 * per_class)
    return lexicon


_WORDS = re.compile(r"\S+").finditer


def _exceptions(sample: DataFrame, lexicon: Lexicon, least: float) -> list[str]:
    """Two-word phrases around a stem seen in clean families only (at least ``least`` of them)."""
    bare = Lexicon(lexicon.stems)

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = bare.automaton()
        for b in batches:
            rows = []
            for folded, label in zip(b.column(0), b.column(1)):
                text = folded.as_py()
                around, found = set(), hits(text, a)
                words = [(m.start(), m.group()) for m in _WORDS(text)] if found else []
                at = {s: i for i, (s, _) in enumerate(words)}
                for i in (at[s] for s in found if s in at):
                    before, after = [w for _, w in words[max(0, i - 1):i]], [w for _, w in words[i:i + 2]]
                    around.add(" ".join(after))
                    around.add(" ".join(before + after[:1]))
                rows += [(p, label.as_py()) for p in around if " " in p]
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.string()),
                                              pa.array([x for _, x in rows], pa.int32())], names=["phrase", "label"])

    seen = (sample.select("folded", "label").mapInArrow(phrases, "phrase string, label int").groupBy("phrase")
            .agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b"))
            .where((F.col("a") == 0) & (F.col("b") >= least)).orderBy(F.col("b").desc(), "phrase"))
    return [r["phrase"] for r in seen.collect()]


def _measured(lexicon: Lexicon, keep: list[str], fold_first: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = lexicon.automaton()
        for b in batches:
            totals, words, n_hits = [], [], []
            for t in b.column(1):
                text = fold(t.as_py()) if fold_first else t.as_py()
                found = hits(text, a)
                totals.append(sum(found.values()))
                n_hits.append(len(found))
                words.append(len(text.split()))
            x = np.array([features(t, n) for t, n in zip(totals, words)], np.float64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index(c)) for c in keep]
                + [pa.array(words, pa.int64()), pa.array(n_hits, pa.int64()), pa.array(totals, pa.float64()),
                   pa.array(logistic(x, lexicon.curve), pa.float64())],
                names=[*keep, "n_words", "n_hits", "weight", "score"])

    return run


def _curve(sample: DataFrame, lexicon: Lexicon, bound: int) -> tuple[float, float, float]:
    """Logistic regression (Newton steps, small ridge) on the sample's two features."""
    rows = sample.select("doc_id", "folded", "label").mapInArrow(
        _measured(lexicon, ["doc_id", "label"], False),
        "doc_id long, label int, n_words long, n_hits long, weight double, score double")
    d = collected(rows, bound)
    x = np.array([features(t, n) for t, n in zip(d["weight"], d["n_words"])])
    x, y = np.column_stack([np.ones(len(x)), x]), d["label"].to_numpy(float)
    w = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + 0.1 * w * [0, 1, 1]
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-6, 0.1, 0.1])
        w = w - np.linalg.solve(hess, grad)
    return tuple(float(v) for v in w)


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``doc_id, n_words, n_hits, weight, score`` for every row: one map pass, no shuffle."""
    return id_text(docs).mapInArrow(_measured(lexicon, ["doc_id"], True),
                                    "doc_id long, n_words long, n_hits long, weight double, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` (1: toxic) and the match figures."""
    out = score(docs, learn(docs, labels))
    return out.select("doc_id", held_out().alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"), "n_hits", "n_words")
