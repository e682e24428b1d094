"""Bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ndspark.llm.common import cut, fold


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, learn: Column | None = None) -> DataFrame:
    """doc_id, text, y of at most ``rows`` labelled documents, by the order of a hash of their ids.

    Only rows whose crc32(doc_id) mod 3 is not 1 are learned from, unless learn says otherwise. A document
    with several labels counts as 1 if one of them is; of rows that share an id the least text is taken. The
    sample is written once to the shared folder.
    """
    able = (fold(F.col("doc_id"), 3) != 1) if learn is None else learn
    known = labels.where(able & F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).cast("double").alias("y"))
    ids = docs.select("doc_id").where(F.col("doc_id").isNotNull() & able).distinct()
    chosen = known.join(ids, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # at most ``rows`` ids and numbers, which is what bounds the broadcast
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return cut(found.groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("doc_id", "text", "y"))
