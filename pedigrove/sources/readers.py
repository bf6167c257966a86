"""Readers: text to typed tables. Schemas are explicit; nothing is inferred."""

from __future__ import annotations

import re
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CONSTRAINT, GENE_POSTERIOR, GENOTYPES, VALUED_INTERVALS

# Names of a pedigree's header row, in lower case.
FAMILY_NAMES = ("fam", "famid", "family", "familyid")
SAMPLE_NAMES = ("iid", "sample", "sampleid")

#: A sorted table's folders: a column that is always text, so that a chromosome 1 is not read as a number.
FOLDER, FOLDER_NAME = "_chromosome", "chrom-"


def _strip(text):
    """Without white space of any kind at the ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def _strings(spark: SparkSession, path, **options) -> DataFrame:
    # No quote character: text is taken as it stands.
    return spark.read.options(sep="\t", quote="", **options).csv(path)


def read_tsv(spark: SparkSession, path, schema: T.StructType | None = None, **options) -> DataFrame:
    """A tab-separated file with a header: all columns strings, or those of a schema (by position)."""
    if schema is None:
        return _strings(spark, path, header=True, inferSchema=False, **options)
    return spark.read.schema(schema).options(sep="\t", quote="", header=True, **options).csv(path)


def _by_name(spark: SparkSession, path, schema: T.StructType, null: str | None = None, lenient: bool = False) -> DataFrame:
    """Columns of a schema, picked by name from a file that may have more; a null text is null in all columns.

    Text that is not of a column's type is an error that names the column and the text, as
    in a strict cast; lenient makes it null.
    """
    raw = _strings(spark, path, header=True, inferSchema=False, **({"nullValue": null} if null else {}))
    if gone := [f.name for f in schema if f.name not in raw.columns]:
        raise ValueError(f"missing columns: {gone}")

    def typed(f: T.StructField):
        text = F.col(f"`{f.name}`")
        value = text.try_cast(f.dataType)
        if not lenient and not isinstance(f.dataType, T.StringType):
            value = F.when(text.isNotNull() & value.isNull(), F.raise_error(F.concat(F.lit(f"{f.name} is no {f.dataType.simpleString()}: "), text)).cast(f.dataType)).otherwise(value)
        return value.alias(f.name)

    return raw.select(*map(typed, schema))


def read_constraint(spark: SparkSession, path, lenient: bool = False) -> DataFrame:
    return _by_name(spark, path, CONSTRAINT, "NA", lenient)


def read_gene_posterior(spark: SparkSession, path, lenient: bool = False) -> DataFrame:
    return _by_name(spark, path, GENE_POSTERIOR, lenient=lenient)


def read_valued_intervals(spark: SparkSession, path, lenient: bool = False) -> DataFrame:
    return _by_name(spark, path, VALUED_INTERVALS, lenient=lenient)


def read_genotypes(spark: SparkSession, path) -> DataFrame:
    """Long genotype table; '.' stays text."""
    return read_tsv(spark, path, GENOTYPES)


def read_bed(spark: SparkSession, path) -> DataFrame:
    """Headerless intervals, first three columns; what is no number is an error."""
    raw = _strings(spark, path, header=False)
    return raw.select(F.col("_c0").alias("chrom"), F.col("_c1").cast("long").alias("start"), F.col("_c2").cast("long").alias("end"))


def read_bed_strict(spark: SparkSession, path, contigs: DataFrame | None = None, contig: str = "contig") -> DataFrame:
    """Intervals with every line checked, chromosomes as the contigs name them.

    Blank lines, comments, track and browser lines are skipped. Fewer than three columns
    are an error; lines of a contig that is not known are left out with a warning,
    whatever their numbers; of the others, no whole number or end <= start are errors,
    as is a file that leaves nothing.
    """
    from ..operators.intervals import normalize_chrom

    text = F.col("value")
    lines = spark.read.text(path).where((_strip(text) != "") & ~text.startswith("#") & ~text.startswith("track") & ~text.startswith("browser"))
    part = F.split(F.col("value"), "\t")
    rows = lines.select(F.size(part).alias("n"), F.get(part, F.lit(0)).alias("chrom"), F.get(part, F.lit(1)).try_cast("long").alias("start"), F.get(part, F.lit(2)).try_cast("long").alias("end"))
    if contigs is not None:
        rows = normalize_chrom(rows, contigs, "chrom", contig, "named")
    else:
        rows = rows.withColumn("named", F.col("chrom"))
    bad = F.when(F.col("n") < 3, "columns").when(F.col("named").isNull(), "contig").when(F.col("start").isNull() | F.col("end").isNull(), "numbers")
    rows = rows.withColumn("bad", bad.when(F.col("end") <= F.col("start"), "order"))
    found = rows.agg(
        *[F.count_if(F.coalesce(F.col("bad") == b, F.lit(False))).alias(b) for b in ("columns", "contig", "numbers", "order")],
        F.count_if(F.col("bad").isNull()).alias("usable"),
    ).first()
    if found["columns"] or found["numbers"] or found["order"]:
        raise ValueError(f"regions: {found['columns']} lines with fewer than 3 columns, {found['numbers']} without whole numbers, {found['order']} with end <= start")
    if found["contig"]:
        warnings.warn(f"{found['contig']} regions on unknown contigs were left out", stacklevel=2)
    if not found["usable"]:
        raise ValueError("no usable regions")
    return rows.where("bad is null").select(F.col("named").alias("chrom"), "start", "end")


def read_pedigree(spark: SparkSession, path, keep: str = "error") -> DataFrame:
    """family, sample: first two columns of a pedigree split at white space.

    Blank lines, comments, lines of one column and a header row (both names known) are
    skipped. A sample in two families is an error; keep='last' takes the later line: of
    several files that of the path given later (within a folder or pattern, of the
    later name), and within a file the later line, whatever the files' sizes.
    """
    lines = spark.read.text(path)
    # Spark packs files by size, so a row's number tells no order; the file and the place in it do.
    files = [f for p in ([path] if isinstance(path, str) else path) for f in sorted(spark.read.text(p).inputFiles())]
    rank = spark.createDataFrame(list({re.sub("^file:/+", "file:///", f): i for i, f in enumerate(files)}.items()), "path string, file int")
    uri = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:///")
    lines = lines.select(_strip(F.col("value")).alias("text"), "value", uri.alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    lines = lines.where(~F.col("value").startswith("#"))
    part = F.split("text", r"\s+")
    rows = lines.where(F.size(part) >= 2)
    rows = rows.select(part[0].alias("family"), part[1].alias("sample"), "path", "block", "line")
    rows = rows.where(~(F.lower("family").isin(*FAMILY_NAMES) & F.lower("sample").isin(*SAMPLE_NAMES)))
    if keep == "last":
        rows = rows.join(F.broadcast(rank), "path")  # a short row a file
        rows = rows.groupBy("sample").agg(F.max_by("family", F.struct("file", "block", "line")).alias("family"))
    else:
        twice = rows.groupBy("sample").agg(F.countDistinct("family").alias("n")).where("n > 1").orderBy("sample").limit(25).collect()
        if twice:
            raise ValueError(f"samples in two families: {', '.join(r['sample'] for r in twice)}")
        rows = rows.select("family", "sample").distinct()
    return rows.select("family", "sample")


def input_paths(chroms: str, pattern: str) -> dict[str, str]:
    """Chromosome to path for a comma list and a pattern with {chrom}."""
    return {c: pattern.replace("{chrom}", c) for c in (x.strip() for x in chroms.split(",")) if c}


def read_stage(spark: SparkSession, path: str, chroms: list[str] | None = None, chrom: str = "#CHROM") -> DataFrame:
    """A stage's Parquet table, of some chromosomes only if asked (folders of a sorted table are pruned).

    Columns have the types that they were written with.
    """
    df = spark.read.parquet(path)
    if chroms is not None:
        df = df.where(F.col(f"`{chrom}`").isin(*chroms))
        if FOLDER in df.columns:
            df = df.where(F.col(FOLDER).isin(*[f"{FOLDER_NAME}{c}" for c in chroms]))
    return df.drop(FOLDER)


