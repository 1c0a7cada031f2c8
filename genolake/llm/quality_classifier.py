"""Quality by nearest-neighbour voting over latent-semantic vectors.

Terms of a text are its character-class trigrams (vowel, consonant, capital,
digit, blank, line end, punctuation kinds, symbols, non-ASCII) and a few
bucketed shape measures (repetition of words, lines and word triples, word
length, capitals, symbols, size).  They describe form, not vocabulary, and so
carry over between languages.  Log counts times inverse document frequency,
scaled to length one, are projected on the leading right singular vectors of
the training sample (latent semantic analysis).

Scoring broadcasts the training vectors and, block by block, takes the exact
cosine with every one of them for every document; the ``NEIGHBOURS`` most
similar vote with their labels, weighted by similarity.  Ties in similarity
go to the lower training row.

Bounds: at most ``PER_CLASS`` training documents per class, hence a fixed
broadcast (about 2 MB); every document is scored on its whole text in one map
pass without a shuffle.

Defined cases: null or empty texts are scored like any other (their shape is
a term too); without any training rows every score is 0.5; repeated rows get
equal scores; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text
from .labelled import collected, held_out, training_rows

PER_CLASS = 4096
DIMENSIONS = 48
NEIGHBOURS = 51
SHARPNESS = 8
THRESHOLD = 0.7
BLOCK = 512

CLASSES = 13


def _class_table() -> np.ndarray:
    t = np.full(256, 10, np.uint8)  # other punctuation and controls
    t[[32, 9]] = 0
    t[[10, 13]] = 1
    t[97:123] = 3
    t[[ord(c) for c in "aeiouy"]] = 2
    t[65:91] = 4
    t[48:58] = 5
    t[ord(".")], t[ord(",")] = 6, 7
    t[[ord("!"), ord("?")]] = 8
    t[[ord(c) for c in "#*$%&|<>"]] = 9
    t[0xC0:] = 11
    t[0x80:0xC0] = 12
    return t


_TABLE = _class_table()
TRIGRAMS = CLASSES ** 3
BUCKETS = 12
SHAPES = 8
TERMS = TRIGRAMS + BUCKETS * SHAPES
_SHAPE_WEIGHT = 3.0


def terms(text: str) -> np.ndarray:
    """Log term counts of one text (float32, length ``TERMS``)."""
    raw = text.encode()
    out = np.zeros(TERMS, np.float32)
    c = _TABLE[np.frombuffer(raw, np.uint8)].astype(np.int32)
    if len(c) >= 3:
        grams = c[:-2] * (CLASSES * CLASSES) + c[1:-1] * CLASSES + c[2:]
        out[:TRIGRAMS] = np.log1p(np.bincount(grams, minlength=TRIGRAMS))
    words = raw.split()
    n = max(len(words), 1)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    count = np.bincount(c, minlength=CLASSES)
    size = max(len(raw), 1)
    shares = [
        min(np.log2(len(words) + 1) / 16, 1.0),
        1 - len(set(words)) / n if words else 1.0,
        1 - len(set(zip(words, words[1:], words[2:]))) / max(len(words) - 2, 1) if len(words) > 2 else 0.0,
        1 - len(set(lines)) / max(len(lines), 1) if lines else 0.0,
        min(size / n / 24, 1.0),
        count[4] / size,
        min(4 * count[9] / size, 1.0),
        min(4 * count[8] / size, 1.0),
    ]
    for i, s in enumerate(shares):
        out[TRIGRAMS + i * BUCKETS + min(int(s * BUCKETS), BUCKETS - 1)] = _SHAPE_WEIGHT
    return out


@dataclass
class Model:
    idf: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def embed(self, counts: np.ndarray) -> np.ndarray:
        x = counts * self.idf
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
        v = x @ self.projection
        return (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)).astype(np.float32)

    def score(self, counts: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(counts), 0.5)
        cosine = self.embed(counts) @ self.vectors.T
        k = min(neighbours, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.clip(np.take_along_axis(cosine, near, 1), 1e-6, 1).astype(np.float64) ** SHARPNESS
        return np.clip((weight * self.labels[near]).sum(1) / weight.sum(1), 0, 1)


def _packed(v: np.ndarray) -> bytes:
    """The terms that a text has: their numbers (16 bits each), then their values (float16); most are zero."""
    at = np.flatnonzero(v)
    return at.astype("<u2").tobytes() + v[at].astype("<f2").tobytes()


def _unpacked(packed: list[bytes]) -> np.ndarray:
    """Term rows (float32) from ``_packed``."""
    out = np.zeros((len(packed), TERMS), np.float32)
    for row, p in zip(out, packed):
        half = len(p) // 2
        row[np.frombuffer(p, "<u2", half // 2)] = np.frombuffer(p, "<f2", half // 2, half)
    return out


def _term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        packed = [_packed(terms(t.as_py())) for t in b.column(1)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(packed, pa.binary())],
                                         names=["doc_id", "label", "terms"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS,
        dimensions: int = DIMENSIONS) -> Model:
    """Latent-semantic model of a bounded training sample; term rows come from Spark, the SVD is local.

    Term rows reach the driver without their zeros and are unpacked a block at a time.
    """
    sample = training_rows(docs, labels, label, per_class)
    rows = collected(sample.mapInArrow(_term_rows, "doc_id long, label int, terms binary"), 2 * per_class)
    if rows.empty:
        return Model(np.ones(TERMS, np.float32), np.zeros((TERMS, 1), np.float32),
                     np.zeros((0, 1), np.float32), np.zeros(0))
    packed, known = rows["terms"].tolist(), rows["label"].to_numpy(np.float64)
    del rows

    def blocks() -> Iterator[np.ndarray]:
        return (_unpacked(packed[lo:lo + BLOCK]) for lo in range(0, len(packed), BLOCK))

    holders = sum((x > 0).sum(0) for x in blocks())
    idf = (np.log((1 + len(packed)) / (1 + holders)) + 1).astype(np.float32)
    gram = np.zeros((TERMS, TERMS), np.float32)
    for x in blocks():
        y = x * idf
        y /= np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-9)
        gram += y.T @ y
    _, vectors = np.linalg.eigh(gram)
    del gram
    projection = np.ascontiguousarray(vectors[:, ::-1][:, :dimensions]).astype(np.float32)
    del vectors
    model = Model(idf, projection, np.zeros((0, 1), np.float32), known)
    model.vectors = np.concatenate([model.embed(x) for x in blocks()])
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            for lo in range(0, b.num_rows, BLOCK):
                part = b.slice(lo, BLOCK)
                x = np.stack([terms(t.as_py()) for t in part.column(1)])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(m.score(x), pa.float64())],
                                                 names=["doc_id", "score"])

    return id_text(docs).mapInArrow(vote, "doc_id long, score double")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, keep_unlearned: bool = False) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches the threshold; one map pass.

    With ``keep_unlearned`` all rows stay if there was no training row: nothing learned, nothing rejected.
    """
    model = fit(docs, labels)
    if keep_unlearned and not len(model.labels):
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def vote(chunks: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for c in chunks:
            parts = [np.stack([terms(t) for t in c.iloc[lo:lo + BLOCK]]) for lo in range(0, len(c), BLOCK)]
            yield pd.Series(np.concatenate([shared.value.score(x) for x in parts]) if parts else [], dtype="float64")

    return docs.where(vote(F.coalesce("text", F.lit(""))) >= threshold)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` (1: good)."""
    out = score(docs, fit(docs, labels))
    return out.select("doc_id", held_out().alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
