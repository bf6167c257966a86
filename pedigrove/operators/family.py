"""Family expansion: genotypes of all members of families in which somebody carries an ALT allele."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import is_carrier_call
from ..schemas import SITE
from .intervals import KEYS, region_semi_join


def _q(name: str):
    return F.col(f"`{name}`")


def with_family(genotypes: DataFrame, pedigree: DataFrame, sample: str = "SAMPLE", family: str = "FAMILY") -> DataFrame:
    """Adds each sample's family; samples without one go (see :func:`require_known_samples`)."""
    known = pedigree.select(F.col("sample").alias("_sample"), F.col("family").alias(family)).distinct()
    return genotypes.drop(family).join(known, _q(sample) == F.col("_sample")).drop("_sample")


def family_expand(genotypes: DataFrame, pedigree: DataFrame | None = None, regions: DataFrame | None = None, site=SITE, sample: str = "SAMPLE", gt: str = "GT", family: str = "FAMILY", keys=KEYS, region_keys=("chrom", "start", "end")) -> DataFrame:
    """Every member's genotype at the sites where a member of the family is a carrier.

    genotypes: one row a (site, sample). Without a pedigree it has the family already.
    regions: only records that overlap one. The carriers' (site, family) pairs are
    narrowed first, so the wide rows meet only them; where the site holds the records'
    coordinates it is the carriers alone that are held against the regions. Rows with a
    null in a site column or without a family match none and go.
    """
    at = [c for c in site if c in genotypes.columns]
    narrow = set(keys) <= set(at)
    rows = genotypes if regions is None or narrow else region_semi_join(genotypes, regions, keys, region_keys)
    rows = rows if pedigree is None else with_family(rows, pedigree, sample, family)
    at.append(family)
    hit = rows.where(is_carrier_call(_q(gt))).select(*map(_q, at)).distinct()
    if regions is not None and narrow:
        hit = region_semi_join(hit, regions, keys, region_keys, among=genotypes)
    return rows.join(hit, at, "left_semi").select(*map(_q, rows.columns))


def missing_samples(called: DataFrame, pedigree: DataFrame, sample: str = "sample") -> DataFrame:
    """Called samples that the pedigree does not have."""
    return called.select(_q(sample)).distinct().join(pedigree.select(F.col("sample").alias("_s")), _q(sample) == F.col("_s"), "left_anti")


def extra_samples(called: DataFrame, pedigree: DataFrame, sample: str = "sample") -> DataFrame:
    """Samples of the pedigree that were not called."""
    return pedigree.select(F.col("sample").alias(sample)).distinct().join(called.select(_q(sample).alias("_s")), _q(sample) == F.col("_s"), "left_anti")


def _told(samples: DataFrame, sample: str) -> tuple[int, str]:
    """How many samples, and the first 25 of them as text."""
    first = [str(r[0]) for r in samples.orderBy(sample).limit(25).collect()]
    n = samples.count() if len(first) == 25 else len(first)
    return n, ", ".join(first) + (f" ... (+{n - 25} more)" if n > 25 else "")


def require_known_samples(called: DataFrame, pedigree: DataFrame, sample: str = "sample") -> None:
    """Raises with the number of called samples that the pedigree does not have and the first 25 of them."""
    n, names = _told(missing_samples(called, pedigree, sample), sample)
    if n:
        raise ValueError(f"{n} samples not in the pedigree: {names}")


def warn_of_extra_samples(called: DataFrame, pedigree: DataFrame, sample: str = "sample") -> None:
    """Warns of the number of the pedigree's samples that were not called and the first 25 of them."""
    n, names = _told(extra_samples(called, pedigree, sample), sample)
    if n:
        warnings.warn(f"{n} samples of the pedigree were not called: {names}", stacklevel=2)
