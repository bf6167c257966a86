"""Stage tables with a manifest: what was counted while a stage was written, checked before it is read; reruns of single chromosomes."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .readers import FOLDER, FOLDER_NAME
from .writers import sorted_rows

#: Beside a stage's data; Spark's readers pass over names that begin with an underscore.
NAME = "_manifest"


def manifest(spark: SparkSession, path: str) -> dict:
    """What a stage says of itself: schema, folders (rows each), metrics, and whether it is whole. An error if there is none."""
    try:
        rows = spark.read.text(f"{path}/{NAME}").collect()
    except Exception as e:
        raise ValueError(f"stage {path} has no manifest: it was not written whole") from e
    return json.loads(rows[0][0])


def _put(spark: SparkSession, path: str, told: dict) -> None:
    spark.createDataFrame([(json.dumps(told),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{NAME}")


def _on_disk(spark: SparkSession, path: str, schema: T.StructType) -> dict[str, int]:
    """Rows of each folder, from the files' footers: no column is read."""
    return {r[0]: r[1] for r in spark.read.schema(schema).parquet(path).groupBy(FOLDER).count().collect()}


def write_checked(df: DataFrame, path: str, chrom: str = "#CHROM", chroms: list[str] | None = None, metrics: dict[str, Column] | None = None, ordered: bool = False) -> dict:
    """Writes a stage, a folder a chromosome, and its manifest; returns the manifest.

    Rows and ``metrics`` (aggregates) are observed while the rows are written, and held
    against the rows of the written files' footers, so the stage is not computed again.
    chroms: rewrite those chromosomes only, from df's rows of them; all other folders stay as
    they are. The manifest says that the stage is being written until all is done: a
    stage that broke off is refused by :func:`read_checked`. ordered: range-partitioned and
    sorted by position, as :func:`pedigrove.sources.write_sorted` does.
    """
    spark, kept = df.sparkSession, {}
    if chroms is not None:
        df = df.where(F.col(f"`{chrom}`").isin(*chroms))
        kept = {k: v for k, v in manifest(spark, path)["folders"].items() if k not in {f"{FOLDER_NAME}{c}" for c in chroms}}
    seen = Observation()
    df = df.withColumn(FOLDER, F.concat(F.lit(FOLDER_NAME), F.coalesce(F.col(f"`{chrom}`").cast("string"), F.lit("null"))))
    told = {"schema": df.schema.jsonValue(), "folders": kept, "metrics": {}, "whole": False}
    if chroms is not None:
        _put(spark, path, told)
    # Large chromosomes are spread over tasks, small ones share one.
    rows = sorted_rows(df, (FOLDER, chrom, "POS0")) if ordered else df.hint("rebalance", FOLDER)
    # Observed behind the exchange: a range exchange runs what is before it once more for its sample.
    rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.collect_set(FOLDER).alias("folders"), *[v.alias(k) for k, v in (metrics or {}).items()])
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static" if chroms is None else "dynamic").partitionBy(FOLDER).parquet(path)
    counted = seen.get
    # A rewritten chromosome that has no rows now leaves its old folder; it is not in the manifest and is not read.
    there = _on_disk(spark, path, df.schema) if counted["rows"] else {}
    found = {k: there.get(k, 0) for k in counted["folders"]}
    if sum(found.values()) != counted["rows"]:
        raise ValueError(f"stage {path}: {counted['rows']} rows went in, {sum(found.values())} are there")
    told |= {"folders": kept | found, "metrics": {k: counted[k] for k in metrics or {}}, "whole": True}
    _put(spark, path, told)
    return told


def check_stage(spark: SparkSession, path: str) -> dict:
    """The manifest, if the stage is whole and each folder has the rows that it says; else an error that names what is not."""
    told = manifest(spark, path)
    if not told["whole"]:
        raise ValueError(f"stage {path} was not written whole")
    there = _on_disk(spark, path, T.StructType.fromJson(told["schema"])) if told["folders"] else {}
    bad = {k: (n, there.get(k, 0)) for k, n in told["folders"].items() if there.get(k, 0) != n}
    if bad:
        raise ValueError(f"stage {path} is damaged: " + "; ".join(f"{k.removeprefix(FOLDER_NAME)} has {b} of {a} rows" for k, (a, b) in sorted(bad.items())[:25]))
    return told


def read_checked(spark: SparkSession, path: str, chroms: list[str] | None = None) -> DataFrame:
    """A stage written by :func:`write_checked`, checked before; of some chromosomes only if asked (their folders)."""
    told = check_stage(spark, path)
    folders = [f for f in told["folders"] if chroms is None or f.removeprefix(FOLDER_NAME) in chroms]
    rows = spark.read.schema(T.StructType.fromJson(told["schema"])).parquet(path)
    return rows.where(F.col(FOLDER).isin(*folders) if folders else F.lit(False)).drop(FOLDER)
