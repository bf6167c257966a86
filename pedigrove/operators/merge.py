"""Joining genotypes with annotations, ordering, and checks between stages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ceil_div, info_value
from ..schemas import INTERVAL, MERGE_KEYS

GENOTYPE_COLUMNS = ("SAMPLE", "GT", "GQ", "DP", "AD", "FAMILY")


def _q(name: str):
    return F.col(f"`{name}`")


def require_columns(df: DataFrame, names) -> None:
    if gone := [n for n in names if n not in df.columns]:
        raise ValueError(f"missing columns: {gone}")


def drop_genotypes(df: DataFrame, columns=GENOTYPE_COLUMNS) -> DataFrame:
    """Sites only; no row is filtered."""
    return df.drop(*columns)


def merge_annotations(resolved: DataFrame, variants: DataFrame, keys=MERGE_KEYS, suffix: str = "_var") -> DataFrame:
    """Inner join on site and allele; variants' other columns that clash get the suffix. Null keys never match.

    Names that differ in case only clash too, unless spark.sql.caseSensitive is on.
    """
    require_columns(resolved, keys)
    require_columns(variants, keys)
    exact = resolved.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    fold = str if exact else str.lower
    taken = set(map(fold, resolved.columns))
    clash = {c: f"{c}{suffix}" for c in variants.columns if fold(c) in taken and c not in keys}
    return resolved.join(variants.withColumnsRenamed(clash), list(keys)).select(
        *map(_q, resolved.columns), *[_q(clash.get(c, c)) for c in variants.columns if c not in keys]
    )


def end_differs(info: str = "INFO", pos0: str = "POS0", ref: str = "REF"):
    """Whether INFO tells an END other than POS0 + length of REF (symbolic and structural records): the two rules do not meet in a join then."""
    told = info_value(info, "END", anchored=True).try_cast("long")
    return F.coalesce(told != _q(pos0) + F.length(_q(ref)), F.lit(False))


def end_differences(sites: DataFrame, chrom: str = "#CHROM", info: str = "INFO", pos0: str = "POS0", ref: str = "REF") -> DataFrame:
    """chrom, sites, differing: how many records of a chromosome have an INFO/END of their own (see :func:`end_differs`)."""
    return sites.groupBy(_q(chrom).alias("chrom")).agg(F.count("*").alias("sites"), F.count_if(end_differs(info, pos0, ref)).alias("differing"))


def position_sort(df: DataFrame, keys=INTERVAL[:2], ties=("END", "REF", "ALT_specific", "FAMILY", "SAMPLE", "allele_num")) -> DataFrame:
    """By chromosome (binary text order) and numeric start, then by what ties there are."""
    return df.orderBy(*[_q(c) for c in (*keys, *ties) if c in df.columns])


def union_stages(parts: list[DataFrame]) -> DataFrame:
    """All rows of all parts, by column name."""
    return reduce(DataFrame.unionByName, parts)


def stage_reconcile(regions: DataFrame, stages: dict[str, DataFrame], size: int, chrom: str = "chrom", chunk: str = "chunk", strict: bool = False) -> DataFrame:
    """chrom, expected, a column a stage, agrees: chunks that ceil(regions / size) asks for and distinct ones that each stage has.

    Chromosomes of any side are listed. strict: raise with the number of all that
    disagree, each stage's counts and the first 25 chromosomes.
    """
    out = regions.groupBy(_q(chrom).alias("chrom")).agg(ceil_div(F.count("*"), size).alias("expected"))
    for name, rows in stages.items():
        out = out.join(rows.groupBy(_q(chrom).alias("chrom")).agg(F.countDistinct(_q(chunk)).alias(name)), "chrom", "full")
    counts = ["expected", *stages]
    out = out.select("chrom", *[F.coalesce(_q(c), F.lit(0)).cast("long").alias(c) for c in counts])
    out = out.withColumn("agrees", reduce(lambda a, b: a & b, [F.col("expected") == _q(c) for c in stages], F.lit(True)))
    if strict:
        bad = out.where("not agrees")
        if first := bad.orderBy("chrom").limit(25).collect():
            n = bad.count() if len(first) == 25 else len(first)
            told = "; ".join(f"{r.chrom}: " + ", ".join(f"{s} {r[s]}" for s in stages) + f" of {r.expected} chunks" for r in first)
            raise ValueError(f"{n} chromosomes disagree: {told}" + (f" ... (+{n - 25} more)" if n > 25 else ""))
    return out
