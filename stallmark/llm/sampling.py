"""A bounded, reproducible sample of labelled rows, and features of its documents gathered for a fit."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold

#: Labelled rows of which crc32(doc_id) mod 5 is 0 are held out of every fit.
HELD_OUT_PARTS = 5


def labelled_sample(labels: DataFrame, label: str, rows: int) -> DataFrame:
    """At most `rows` (doc_id, label) that are not held out: those with the smallest hash of the id.

    Rows without an id or with a label other than 0 or 1 are left out; ids labelled more
    than once count once, as the larger label.
    """
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    own = own.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & (fold("doc_id", HELD_OUT_PARTS) != 0))
    own = own.groupBy("doc_id").agg(F.max("label").alias("label"))
    return own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def sampled_features(docs: DataFrame, sample: DataFrame, extract: Callable, schema: str) -> DataFrame:
    """extract(batches of (text, label)) of the sampled documents; as many rows as the sample has."""
    sample = F.broadcast(sample)  # at most `rows` pairs
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.join(sample, "doc_id").select("text", "label").mapInArrow(extract, schema)
