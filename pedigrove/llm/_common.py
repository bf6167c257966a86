"""Shared helpers: shared-folder tables, batch sizes, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import new_path

#: One word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage: df as a Parquet table in the shared folder, read again."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_batches(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of few rows, so that what is made of long texts at a time stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest reachable id of each node of an undirected graph, by alternating large and small stars.

    edges: two long columns (a, b), no nulls. Returns (node, component) for every
    node that has an edge to another one. Each round is two aggregations and joins
    over the edges, written to the shared folder; nothing is gathered on the driver
    but a count and a checksum. Self-loops and repeated edges are harmless.
    """

    def stars(e: DataFrame) -> DataFrame:
        # Large star: each node hangs its larger neighbours on its smallest one.
        both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # Small star: a node's smaller neighbours, and itself, hang on the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(low, "a")
        return hung.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b"))).distinct()

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())

    e = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    last = mark(e)
    for _ in range(max_rounds):
        e = written(stars(e), "stars")
        now = mark(e)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("connected components did not settle")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
