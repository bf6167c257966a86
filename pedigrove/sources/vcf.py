"""Variant call files: calls as the long genotype table, sites with INFO, packed annotations by the fields that the header names."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import info_value, without_key
from .lines import files_of, read_heads, read_lines

#: Bytes of sample names up to which they are broadcast; more are joined as Spark plans it.
BROADCAST_BYTES = 64 << 20


def _field(i: int) -> Column:
    return F.get("p", F.lit(i))


def _rows(spark: SparkSession, files: list[str], **options) -> DataFrame:
    """path, p: the tab-separated fields of every record."""
    lines = read_lines(spark, files, **options).where(~F.col("value").startswith("#") & (F.col("value") != ""))
    return lines.select("path", F.split("value", "\t").alias("p"))


def vcf_samples(spark: SparkSession, path) -> DataFrame:
    """path, position (from 0), SAMPLE: the sample columns of each file."""
    heads = _headers(spark, files_of(spark, path))
    return heads.select("path", F.posexplode(F.slice(F.split("value", "\t"), 10, 1 << 30)).alias("position", "SAMPLE"))


def _headers(spark: SparkSession, files: list[str]) -> DataFrame:
    return read_heads(spark, files).where(F.col("value").startswith("#CHROM\t"))


def vcf_header(spark: SparkSession, path) -> list[str]:
    """Column names of a VCF, from the #CHROM line of its first file."""
    row = _headers(spark, files_of(spark, path)[:1]).first()
    if row is None:
        raise ValueError("no #CHROM line")
    return row["value"].split("\t")


def _with_names(spark: SparkSession, rows: DataFrame, files: list[str]) -> DataFrame:
    """Adds names, the sample columns of the row's own file. Equal headers are kept once."""
    heads = _headers(spark, files).select("path", F.slice(F.split("value", "\t"), 10, 1 << 30).alias("names"), F.xxhash64("value").alias("header"), F.length("value").alias("size"))
    found = heads.select("path", "header", "size").collect()  # a short row a file, as Spark's own list of them
    of_file = {r["path"]: r["header"] for r in found}
    if gone := [f for f in files if f not in of_file]:
        raise ValueError(f"no #CHROM line in {gone[:5]}")
    lists = heads.groupBy("header").agg(F.first("names").alias("names"))
    known = F.broadcast(spark.createDataFrame(list(of_file.items()), "path string, header long"))
    if sum({r["header"]: r["size"] for r in found}.values()) <= BROADCAST_BYTES:
        lists = F.broadcast(lists)
    return rows.join(known, "path").join(lists, "header").drop("path", "header")


def read_vcf(spark: SparkSession, path, samples: list[str] | None = None, **options) -> DataFrame:
    """Multi-sample VCFs as the long genotype table (without FAMILY), one row a site and sample.

    A sample's column is that of the file's own header, so files may order samples
    differently. POS0 = POS - 1, END = POS0 + length of REF, ALT as it stands. GT, GQ, DP,
    AD are taken from each call by the names in FORMAT; absent ones are '.'. A record
    with more or fewer calls than its header has samples is an error. Block-gzip
    files are read in splits (``split_bytes``). Meant as an ingest step: write the
    result with :func:`pedigrove.sources.write_stage` and query that.
    """
    files = files_of(spark, path)
    rows = _with_names(spark, _rows(spark, files, **options), files)
    format_ = F.split(_field(8), ":")
    # Zero where FORMAT does not name it; found once a record, not once a call.
    places = {k: F.coalesce(F.array_position(format_, k), F.lit(0)).cast("int") for k in ("GT", "GQ", "DP", "AD")}
    calls = F.slice("p", 10, 1 << 30)
    whole = F.when(F.size(calls) == F.size("names"), calls).otherwise(
        F.raise_error(F.concat(F.lit("record with "), F.size(calls).cast("string"), F.lit(" calls for "), F.size("names").cast("string"), F.lit(" samples: "), _field(0), F.lit(":"), _field(1)))
    )
    pairs = F.arrays_zip(F.col("names").alias("SAMPLE"), whole.alias("call"))
    if samples is not None:
        pairs = F.filter(pairs, lambda x: x["SAMPLE"].isin(*samples))
    rows = rows.select(
        _field(0).alias("#CHROM"), _field(1).cast("long").alias("POS"), _field(3).alias("REF"), _field(4).alias("ALT"), *[v.alias(f"at_{k}") for k, v in places.items()], F.explode(pairs).alias("c")
    )
    rows = rows.select("*", F.col("c.SAMPLE").alias("SAMPLE"), F.split("c.call", ":").alias("value"))
    named = lambda k: F.coalesce(F.when(F.col(f"at_{k}") > 0, F.get("value", F.col(f"at_{k}") - 1)), F.lit("."))
    return rows.select(
        "#CHROM", (F.col("POS") - 1).alias("POS0"), (F.col("POS") - 1 + F.length("REF")).alias("END"), "POS", "REF", "ALT", "SAMPLE",
        named("GT").alias("GT"), F.split(named("GQ"), ",")[0].alias("GQ"), F.split(named("DP"), ",")[0].alias("DP"), named("AD").alias("AD"),
    )


def read_sites(spark: SparkSession, path, **options) -> DataFrame:
    """#CHROM, POS0, END, POS, REF, ALT, ID, QUAL, FILTER, INFO: the sites of VCFs; calls, if there are some, are not looked at.

    END = POS0 + length of REF, the one rule on both sides of the final join; see
    :func:`pedigrove.operators.end_differences` for records whose INFO says otherwise.
    """
    return _rows(spark, files_of(spark, path), **options).select(*_SITE())


def _SITE() -> list[Column]:
    pos0 = _field(1).cast("long") - 1
    site = [_field(0).alias("#CHROM"), pos0.alias("POS0"), (pos0 + F.length(_field(3))).alias("END"), _field(1).cast("long").alias("POS"), _field(3).alias("REF"), _field(4).alias("ALT")]
    return site + [_field(i).alias(n) for i, n in ((2, "ID"), (5, "QUAL"), (6, "FILTER"), (7, "INFO"))]


def packed_fields(spark: SparkSession, path, key: str = "CSQ") -> dict[tuple[str, ...], list[str]]:
    """Field lists that headers declare for a packed INFO key, each with its files: ##INFO=<ID=key,... Format: a|b|c">."""
    return _declared(spark, files_of(spark, path), key)


def _declared(spark: SparkSession, files: list[str], key: str) -> dict[tuple[str, ...], list[str]]:
    told = read_heads(spark, files).where(F.col("value").startswith(f"##INFO=<ID={key},")).collect()
    found = {r["path"]: m[1] for r in told if (m := re.search(r"Format:\s*([^\">]+)", r["value"]))}
    if gone := [f for f in files if f not in found]:
        raise ValueError(f"no fields of {key} in the header of {gone[:5]}")
    lists: dict[tuple[str, ...], list[str]] = {}
    for f in files:
        lists.setdefault(tuple(x.strip() for x in found[f].split("|")), []).append(f)
    return lists


def read_packed_annotations(spark: SparkSession, path, key: str = "CSQ", prefix: str | None = None, cut: bool = True, **options) -> DataFrame:
    """The variant table of annotated VCFs: one row a consequence of a site.

    #CHROM, POS0, END, POS, REF, ALT, ID, QUAL, INFO, then a string column for each field
    that the header declares for the key, named prefix (the key) + field; files may
    declare other fields or another order, columns are matched by name and null where a
    file has none. Empty fields are empty texts, '.' stays. Sites without the key go.
    cut: the key is cut out of INFO wherever it stands; else INFO stays as it is, and
    :func:`pedigrove.operators.strip_info_tail` cuts its tail. A field list that names a
    field twice is an error. :func:`pedigrove.operators.clean_annotation_columns` takes
    the prefix off.
    """
    prefix = key if prefix is None else prefix
    out = None
    for fields, files in _declared(spark, files_of(spark, path), key).items():
        if twice := sorted({f for f in fields if fields.count(f) > 1}):
            raise ValueError(f"fields declared twice for {key}: {twice}")
        rows = _rows(spark, files, **options).select(*_SITE()).drop("FILTER")
        rows = rows.withColumn("_packed", info_value("INFO", key, anchored=True)).where("_packed is not null")
        if cut:
            rows = rows.withColumn("INFO", without_key("INFO", key))
        rows = rows.withColumn("_one", F.explode(F.split("_packed", ","))).withColumn("_parts", F.split("_one", r"\|"))
        rows = rows.select(*[c for c in rows.columns if c[0] != "_"], *[F.get("_parts", F.lit(i)).alias(f"{prefix}{f}") for i, f in enumerate(fields)])
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out
