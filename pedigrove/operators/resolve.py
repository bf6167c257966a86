"""Allele resolution: one row per family member and active allele."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import alleles_in_gt, alt_indices, alt_of_call, carrier, depth_of, is_missing_gt, is_multiallelic_het
from ..schemas import SITE
from .merge import require_columns

ADDED = ("allele_num", "ALT_specific", "carrier", "AD_ref", "AD_alt", "sample_is_multiallelic_het", "family_has_multiallelic_het", "alleles_in_gt", "is_missing_gt")


def _q(name: str):
    return F.col(f"`{name}`")


def resolve_alleles(df: DataFrame, key_cols=SITE, family: str = "FAMILY", sample: str = "SAMPLE", gt: str = "GT", alt: str = "ALT", ad: str = "AD", lenient: bool = False) -> DataFrame:
    """Member x active allele: the alleles seen in any member's call at the site (also in half-missing calls).

    One shuffle by (site, family): a window gathers the distinct calls of a family and
    the members are exploded over their alleles. Families without an active allele give
    no rows; rows with a null key go. Without ALT or AD columns the columns from them
    are null. An AD or ALT that is too short is an error unless lenient.
    """
    require_columns(df, [family, sample, gt])
    keys = [c for c in key_cols if c in df.columns]
    if not keys:
        raise ValueError(f"none of the key columns {list(key_cols)}")
    keys.append(family)
    for k in keys:
        df = df.where(_q(k).isNotNull())
    group = Window.partitionBy(*map(_q, keys))
    rows = df.withColumn("sample_is_multiallelic_het", is_multiallelic_het(_q(gt)))
    rows = rows.withColumn("family_has_multiallelic_het", F.coalesce(F.bool_or("sample_is_multiallelic_het").over(group), F.lit(False)))
    rows = rows.withColumn("_active", F.array_distinct(F.flatten(F.collect_set(alt_indices(_q(gt))).over(group))))
    rows = rows.withColumn("allele_num", F.explode(F.transform("_active", lambda x: x.cast("int"))))
    n, null = F.col("allele_num"), F.lit(None).cast("string")
    rows = rows.withColumns(
        {
            "ALT_specific": alt_of_call(_q(alt), n, lenient) if alt in df.columns else null,
            "carrier": carrier(_q(gt), n),
            "AD_ref": depth_of(_q(ad), F.lit(0), lenient) if ad in df.columns else null,
            "AD_alt": depth_of(_q(ad), n, lenient) if ad in df.columns else null,
            "alleles_in_gt": alleles_in_gt(_q(gt)),
            "is_missing_gt": is_missing_gt(_q(gt)),
        }
    )
    return rows.select(*[_q(c) for c in df.columns if c not in ADDED], *ADDED)
