"""Bounded samples of labelled documents, for fitting models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import held_out


def bounded_sample(rows: DataFrame, id_col: str, class_col: str, per_class: int) -> DataFrame:
    """About ``per_class`` rows of each class at most: those whose hashed id is
    below the class's share.  The same rows on every run, from all of the
    table, and no class passes through one task."""
    counts = {r[class_col]: r["count"] for r in rows.groupBy(class_col).count().collect()}
    if not counts:
        return rows.limit(0)
    share = F.lit(0.0)
    for value, n in counts.items():
        share = F.when(F.col(class_col) == value, min(1.0, per_class / n)).otherwise(share)
    return rows.where(F.pmod(F.xxhash64(id_col), F.lit(1 << 32)) < share * float(1 << 32))


def labelled_documents(docs: DataFrame, labels: DataFrame, label_col: str, per_class: int,
                       id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id") -> DataFrame:
    """label (0 or 1), text of a bounded sample of the labelled documents that
    are not held out.  The sample of the labels is small, so it is what gets sent to
    the documents; of documents that share an id one is taken (the least
    text), so that the sample is as bounded as the labels."""
    known = labels.select(F.col(label_id).alias("label_id"), F.col(label_col).alias("label")) \
        .where("label IN (0, 1) AND label_id IS NOT NULL").where(~held_out("label_id")).distinct()
    picked = bounded_sample(known, "label_id", "label", per_class)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .join(F.broadcast(picked), F.col("doc_id") == F.col("label_id")) \
        .groupBy("doc_id", "label").agg(F.min("text").alias("text"))
