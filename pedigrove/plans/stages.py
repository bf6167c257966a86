"""The three entries: annotate variants, expand and resolve genotypes, join and write. Stages meet as Parquet tables."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as op
from .. import sources
from ..schemas import INTERVAL


@dataclass
class Resources:
    """Annotation tables; a None is skipped."""

    constraint: DataFrame | None = None
    posterior: DataFrame | None = None
    windows: DataFrame | None = None
    regions: dict[str, DataFrame] | None = None


def annotate(variants: DataFrame, resources: Resources) -> DataFrame:
    """Split variants (all strings) to the annotated table: clean names, per-allele fields, region counts, window means, gene and transcript values."""
    df = op.per_allele_fields(op.strip_info_tail(op.clean_annotation_columns(variants)))
    df = df.withColumns({c: df[f"`{c}`"].cast("long") for c in INTERVAL[1:]})
    for name, regions in (resources.regions or {}).items():
        df = op.overlap_count(df, regions, name)
    if resources.windows is not None:
        df = op.overlap_mean(df, resources.windows, {"z": "constraint_z_1kb_mean", "oe": "constraint_oe_1kb_mean"})
    if resources.posterior is not None:
        df = op.gene_posterior(df, resources.posterior)
    if resources.constraint is not None:
        df = op.constraint_by_gene(op.constraint_by_transcript(df, resources.constraint), resources.constraint)
    return df


def run_annotation(spark: SparkSession, variants: DataFrame, resources: Resources, out: str, chroms: list[str] | None = None) -> None:
    """Writes out/annotated once and derives out/consequential and both region sets from it; warns of records with an END of their own.

    chroms: rewrite those chromosomes only, as in the other runs.
    """
    rows = variants if chroms is None else variants.where(F.col("`#CHROM`").isin(*chroms))
    annotated = annotate(rows, resources)
    told = sources.write_checked(annotated, f"{out}/annotated", chroms=chroms, metrics={"end_differs": F.count_if(op.end_differs())})
    if n := told["metrics"]["end_differs"]:
        warnings.warn(f"{n} records have an INFO/END other than POS0 + length of REF; they are joined by the latter", stacklevel=2)
    annotated = sources.read_checked(spark, f"{out}/annotated", chroms)
    sources.write_checked(op.impact_filter(annotated), f"{out}/consequential", chroms=chroms)
    sources.write_checked(op.merge_intervals(annotated), f"{out}/regions", chroms=chroms)
    sources.write_checked(op.merge_intervals(sources.read_checked(spark, f"{out}/consequential", chroms)), f"{out}/consequential_regions", chroms=chroms)


def run_families(spark: SparkSession, genotypes: DataFrame, pedigree: DataFrame, regions: DataFrame, out: str, chunk_size: int = 1000, chroms: list[str] | None = None) -> None:
    """Checks the samples (written to out/samples, so that genotypes are scanned for them once), then writes out/chunks (regions, numbered), out/families (expanded) and out/resolved."""
    if chroms is not None:
        genotypes, regions = (df.where(F.col("`#CHROM`").isin(*chroms)) for df in (genotypes, regions))
    sources.write_stage(genotypes.select(genotypes["SAMPLE"].alias("sample")).distinct(), f"{out}/samples", mode="overwrite")
    called = sources.read_stage(spark, f"{out}/samples")
    op.require_known_samples(called, pedigree)
    op.warn_of_extra_samples(called, pedigree)
    sources.write_checked(op.chunk_numbers(regions, chunk_size, INTERVAL), f"{out}/chunks", chroms=chroms)
    op.stage_reconcile(regions, {"chunks": sources.read_checked(spark, f"{out}/chunks", chroms)}, chunk_size, INTERVAL[0], strict=True)
    sources.write_checked(op.family_expand(genotypes, pedigree, regions, region_keys=INTERVAL), f"{out}/families", chroms=chroms)
    sources.write_checked(op.resolve_alleles(sources.read_checked(spark, f"{out}/families", chroms)), f"{out}/resolved", chroms=chroms)


def run_merge(spark: SparkSession, out: str, chroms: list[str] | None = None) -> None:
    """Reconciles the stages before, joins out/resolved with out/consequential, writes out/final by position and reconciles that too."""
    reconcile(spark, out, final=False)
    resolved, variants = (sources.read_checked(spark, f"{out}/{t}", chroms) for t in ("resolved", "consequential"))
    sources.write_checked(op.merge_annotations(resolved, variants), f"{out}/final", chroms=chroms, ordered=True)
    reconcile(spark, out)


#: Stage, stage that it is made of, and whether it must have all of that one's chromosomes or may have fewer.
STEPS = (
    ("consequential", "annotated", False), ("regions", "annotated", True), ("consequential_regions", "consequential", True), ("chunks", "consequential_regions", True),
    ("families", "consequential_regions", False), ("resolved", "families", True), ("final", "resolved", False), ("final", "consequential", False),
)
#: Stages with as many rows of each chromosome as the one that they are made of.
SAME_ROWS = (("chunks", "consequential_regions"),)


def reconcile(spark: SparkSession, out: str, final: bool = True) -> dict[str, dict[str, int]]:
    """Rows of each stage's chromosomes, from the manifests; raises with all that disagrees.

    Each stage must be whole, its files' rows those that were counted when it was written,
    and its chromosomes those of the stage that it is made of, or some of them where rows may
    go. No stage is read: manifests and the files' footers tell. final: the final table is
    there and is looked at too.
    """
    wrong, rows = [], {}
    for name in dict.fromkeys(x for step in STEPS for x in step[:2]):
        if name == "final" and not final:
            continue
        try:
            rows[name] = sources.check_stage(spark, f"{out}/{name}")["folders"]
        except ValueError as e:
            wrong.append(str(e))
    shown = lambda names: ", ".join(sorted(n.removeprefix(sources.readers.FOLDER_NAME) for n in names)[:25])
    for name, of, all_of in STEPS:
        if name in rows and of in rows:
            if more := rows[name].keys() - rows[of].keys():
                wrong.append(f"{name} has chromosomes that {of} has not: {shown(more)}")
            if all_of and (gone := rows[of].keys() - rows[name].keys()):
                wrong.append(f"{name} has lost chromosomes of {of}: {shown(gone)}")
    wrong += [f"{name} has other numbers of rows than {of}" for name, of in SAME_ROWS if name in rows and of in rows and rows[name] != rows[of]]
    if wrong:
        raise ValueError(f"stages of {out}: " + "; ".join(wrong))
    return rows


def run_all(spark: SparkSession, genotypes: DataFrame, variants: DataFrame, pedigree: DataFrame, resources: Resources, out: str, chroms: list[str] | None = None) -> DataFrame:
    """From genotypes, split variants and a pedigree to the final table. chroms: of an earlier run, redo those chromosomes and leave all others as they are."""
    run_annotation(spark, variants, resources, out, chroms)
    run_families(spark, genotypes, pedigree, sources.read_checked(spark, f"{out}/consequential_regions", chroms), out, chroms=chroms)
    run_merge(spark, out, chroms)
    return sources.read_checked(spark, f"{out}/final")
