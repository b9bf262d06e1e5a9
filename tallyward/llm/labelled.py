"""Labelled rows for fitting: a bounded sample of documents with their labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import fold

#: Fold that is not fitted on: crc32(doc_id as text) mod ``modulus`` equal to ``held``.
Fold = tuple[int, int]


def sample(docs: DataFrame, labels: DataFrame, column: str, held: Fold, rows: int) -> DataFrame:
    """(doc_id, text, label) of at most ``rows`` labelled ids outside the held fold, the
    ones with the smallest hash of their id; one row each, of several texts of an id the least. Labels
    other than 0 and 1 are not used; of several labels of an id the mean, rounded, counts."""
    label = F.col(column).cast("int")
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), label.alias("label"))
    known = known.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & (fold("doc_id", held[0]) != held[1]))
    known = known.groupBy("doc_id").agg(F.round(F.avg("label")).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)  # bounded, so it may be broadcast
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))
