"""Labelled rows for fitting: folds by a checksum of the id, samples of a bounded size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_fold(doc_id: str, folds: int, fold: int) -> Column:
    """crc32 of the id as text, mod folds, is fold (a null id: false)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, most: int, folds: int, held_out: int) -> DataFrame:
    """text and y of at most ``most`` labelled rows a class, none of them in the held-out fold.

    Drawn by a hash of the id, so reruns agree. Their ids, bounded by ``most``, are
    broadcast to the documents, which are read once and not shuffled. Of rows that share
    an id one text is drawn, the first by a hash of the text, so the sample stays bounded;
    a null text is an empty one.
    """
    ids = labels.where(~in_fold("doc_id", folds, held_out) & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    ids = ids.groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    order = [F.xxhash64("doc_id", F.lit(3)), F.col("doc_id")]
    drawn = ids.where("y = 0").orderBy(*order).limit(most).unionByName(ids.where("y = 1").orderBy(*order).limit(most))
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(drawn), "doc_id")
    one = rows.groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t"))
    return one.select("doc_id", "t.text", "y")


def scored(rows: DataFrame, folds: int, held_out: int, threshold: float = 0.7) -> DataFrame:
    """doc_id, score to doc_id, held_out, score, predicted."""
    return rows.select(
        "doc_id", in_fold("doc_id", folds, held_out).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
