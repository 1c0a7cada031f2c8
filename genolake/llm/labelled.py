"""Labelled training rows shared by the two classifiers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text

HELD_OUT_REMAINDER, FOLDS = 2, 4


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text leaves remainder 2 mod 4: never learned from."""
    return F.pmod(F.crc32(F.col(doc_id).cast("long").cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT_REMAINDER


def training_rows(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """``text, label``: at most ``per_class`` distinct labelled texts of each class outside the held-out fold.

    The sample is the first rows in order of a hash of the id, so it does not
    depend on partitioning.  Conflicting or repeated labels of a document
    count by their maximum; null labels are ignored.  Of several texts of one
    id the one with the least hash is taken.
    """
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
             .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    order = F.xxhash64(F.lit("sample"), "doc_id")
    picked = [known.where(F.col("label") == v).orderBy(order, "doc_id").limit(per_class) for v in (0, 1)]
    rows = id_text(docs).join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id")
    one = rows.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least"))
    return one.select("doc_id", F.col("least.text").alias("text"), "label").dropDuplicates(["text", "label"])


def collected(df: DataFrame, bound: int) -> pd.DataFrame:
    """Rows whose number is bounded by a parameter, in a stable order, on the driver."""
    out = df.limit(bound + 1).toPandas()
    if len(out) > bound:
        raise ValueError(f"more than {bound} rows")
    return out.sort_values("doc_id", kind="stable").reset_index(drop=True)
