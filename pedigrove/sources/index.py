"""Reads of a sorted table by regions through a linear index, and score tables in buckets of their keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import FOLDER, FOLDER_NAME, read_stage

#: Positions a bin of the index, and ranges that a chromosome's regions are put together to.
BIN, RANGES = 1 << 14, 64
NAME = "_index"


def write_index(spark: SparkSession, path: str, keys=("#CHROM", "POS0", "END")) -> None:
    """Beside a sorted table: for each bin of a chromosome, the smallest start of the records that reach into it.

    A record that begins long before a region is found by it, so a region needs a lower
    bound of starts and its own end, which row groups in order of start can be held against.
    """
    c, s, e = (F.col(f"`{k}`") for k in keys)
    rows = read_stage(spark, path).where((e > s) & c.isNotNull()).select(c.alias("c"), s.alias("s"), e.alias("e"))
    # The bin of its start speaks for all short records; only what reaches on has more bins.
    rows = rows.select("c", "s", F.explode(F.sequence(F.floor(F.col("s") / BIN), F.floor((F.col("e") - 1) / BIN))).alias("bin"))
    rows.groupBy("c", "bin").agg(F.min("s").alias("start")).write.mode("overwrite").parquet(f"{path}/{NAME}")


def region_ranges(spark: SparkSession, path: str, regions: DataFrame, region_keys=("chrom", "start", "end")) -> list[tuple[str, int, int]]:
    """chromosome, least and greatest start (exclusive) that records of the regions can have: RANGES a chromosome at most."""
    from ..operators.intervals import united_regions

    return _ranges(spark, path, united_regions(regions, region_keys))


def _ranges(spark: SparkSession, path: str, united: DataFrame) -> list[tuple[str, int, int]]:
    from ..operators.intervals import _kept, in_order

    united = united.select(F.col("_c").alias("chrom"), F.col("_s").alias("lo"), F.col("_e").alias("hi"))
    index = spark.read.parquet(f"{path}/{NAME}").select(F.col("c").cast("string").alias("_c"), F.col("bin").alias("_bin"), F.col("start").alias("_start"))
    lower = united.join(index, (F.col("chrom").cast("string") == F.col("_c")) & (F.floor(F.col("lo") / BIN) == F.col("_bin")), "left")
    # Written once: its places are counted in several steps.
    lower = _kept(lower.select("chrom", F.least("lo", "_start").alias("lo"), "hi"), "lower")
    placed = in_order(lower, "chrom", "lo", ("hi",))
    sizes = lower.groupBy("chrom").agg(F.count("*").alias("n")).withColumnRenamed("chrom", "_c")
    part = F.floor((F.col("place") - 1) * RANGES / F.greatest(F.col("n"), F.lit(RANGES)))
    found = placed.join(sizes, F.col("chrom") == F.col("_c")).groupBy("chrom", part.alias("part")).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    ranges: list[tuple[str, int, int]] = []
    for c, lo, hi in sorted(tuple(r) for r in found.select("chrom", "lo", "hi").collect()):
        if ranges and ranges[-1][0] == c and lo <= ranges[-1][2]:
            ranges[-1] = (c, ranges[-1][1], max(hi, ranges[-1][2]))
        else:
            ranges.append((c, lo, hi))
    return ranges


def read_regions(spark: SparkSession, path: str, regions: DataFrame, keys=("#CHROM", "POS0", "END"), region_keys=("chrom", "start", "end")) -> DataFrame:
    """The records of a sorted, indexed table (see :func:`pedigrove.sources.write_sorted`, :func:`write_index`) that overlap a region.

    The regions are united once. They become folders and ranges of starts, which reach the
    scan: row groups and pages beside them are not read. What is read is then held against
    the united regions themselves. No region: no record.
    """
    from ..operators.intervals import meets_united, united_regions

    table = spark.read.parquet(path)
    united = united_regions(regions, region_keys)
    ranges = _ranges(spark, path, united)
    if not ranges:
        return table.drop(FOLDER).limit(0)
    chrom, start = F.col(f"`{keys[0]}`"), F.col(f"`{keys[1]}`")
    of: dict[str, list] = {}
    for c, lo, hi in ranges:
        of.setdefault(c, []).append((start >= lo) & (start < hi))
    near = [(chrom == c) & reduce(lambda a, b: a | b, parts) for c, parts in of.items()]
    table = table.where(F.col(FOLDER).isin(*sorted({f"{FOLDER_NAME}{c}" for c in of})))
    table = table.where(reduce(lambda a, b: a | b, near)).drop(FOLDER)
    return meets_united(table, united, keys)


def write_bucketed(df: DataFrame, name: str, path: str, keys, buckets: int) -> DataFrame:
    """A lookup table in buckets of its keys, sorted in each, registered under a name; returned as it is read.

    A join by those keys (:func:`pedigrove.operators.annotate_exact`) moves the other side
    only, however large this one is: write it once, look up in it many times.
    """
    (df.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).mode("overwrite").saveAsTable(name))
    return df.sparkSession.table(name)
