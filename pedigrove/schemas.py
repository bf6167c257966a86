"""Explicit schemas of the genomic tables and the shared column names."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()


def table(**columns) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


#: Half-open, 0-based interval of a record.
INTERVAL = ("#CHROM", "POS0", "END")
SITE = ("#CHROM", "POS0", "END", "POS", "REF", "ALT")
MERGE_KEYS = ("#CHROM", "POS0", "END", "REF", "ALT_specific")

GENOTYPES = table(**{"#CHROM": S, "POS0": L, "END": L, "POS": L, "REF": S, "ALT": S, "SAMPLE": S, "GT": S, "GQ": S, "DP": S, "AD": S, "FAMILY": S})
PEDIGREE = table(family=S, sample=S)
BED = table(chrom=S, start=L, end=L)
CONSTRAINT = table(**{"gene": S, "transcript": S, "canonical": B, "lof.pLI": D, "lof.oe_ci.upper": D})
GENE_POSTERIOR = table(ensg=S, obs_lof=L, exp_lof=D, prior_mean=D, post_mean=D, post_lower_95=D, post_upper_95=D)
VALUED_INTERVALS = table(chrom=S, start=L, end=L, z=D, oe=D)
SEVERITY_RANKS = table(term=S, rank=T.IntegerType())
