"""Writers: Parquet between stages, text for exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .readers import FOLDER, FOLDER_NAME

#: What orders rows of one chromosome and start.
TIES = ("END", "REF", "ALT_specific", "FAMILY", "SAMPLE", "allele_num")


def write_stage(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), mode: str = "errorifexists") -> None:
    """One Parquet table a stage; an empty result still has its schema."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_tsv(df: DataFrame, path: str, null: str = ".", mode: str = "errorifexists", **options) -> None:
    """Tab-separated text with a header; nulls as a text, values unquoted."""
    df.write.mode(mode).options(sep="\t", header=True, nullValue=null, emptyValue="", quote="", **options).csv(path)


def write_bed(df: DataFrame, path: str, keys=("chrom", "start", "end"), header: bool = False, mode: str = "errorifexists") -> None:
    """The three interval columns, in order of position."""
    rows = df.select(*[F.col(f"`{k}`") for k in keys])
    rows.orderBy(*[F.col(f"`{k}`") for k in keys]).write.mode(mode).options(sep="\t", header=header).csv(path)


def sorted_rows(df: DataFrame, keys, ties=TIES, partitions: int | None = None) -> DataFrame:
    """Range-partitioned and sorted by the keys, then by what ties there are."""
    by = [F.col(f"`{k}`") for k in (*keys, *ties) if k in df.columns]
    return (df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)).sortWithinPartitions(*by)


def write_sorted(df: DataFrame, path: str, keys=("#CHROM", "POS0"), ties=TIES, partitions: int | None = None, mode: str = "errorifexists") -> None:
    """Range-partitioned and sorted by position, then by what ties there are, in a folder a chromosome.

    Row groups' minima and maxima serve as the index. The chromosome stays a column of
    the files, of its own type; :func:`pedigrove.sources.read_stage` reads the table.
    """
    df = df.withColumn(FOLDER, F.concat(F.lit(FOLDER_NAME), F.col(f"`{keys[0]}`").cast("string")))
    # By folder first, as the writer asks for: it would sort anew otherwise.
    sorted_rows(df, (FOLDER, *keys), ties, partitions).write.mode(mode).partitionBy(FOLDER).parquet(path)
