"""Operators: DataFrame to DataFrame, column names as arguments."""

from .annotate import (
    annotate_exact,
    clean_annotation_columns,
    constraint_by_gene,
    constraint_by_transcript,
    gene_posterior,
    impact_filter,
    per_allele_fields,
    severity_at_least,
    split_packed,
    strip_info_tail,
)
from .family import extra_samples, family_expand, missing_samples, require_known_samples, warn_of_extra_samples
from .intervals import (
    chunk_numbers,
    cut_bins,
    in_order,
    interval_lengths,
    limb_places,
    merge_intervals,
    nearest_interval,
    normalize_chrom,
    overlap_count,
    overlap_join,
    overlap_labels,
    overlap_mean,
    region_semi_join,
)
from .merge import drop_genotypes, end_differences, end_differs, merge_annotations, position_sort, require_columns, stage_reconcile, union_stages
from .resolve import resolve_alleles

__all__ = [
    "annotate_exact", "chunk_numbers", "clean_annotation_columns", "constraint_by_gene", "constraint_by_transcript", "cut_bins", "drop_genotypes",
    "end_differences", "end_differs", "extra_samples", "family_expand", "gene_posterior", "impact_filter", "in_order", "interval_lengths", "limb_places", "merge_annotations", "merge_intervals", "missing_samples",
    "nearest_interval", "normalize_chrom", "overlap_count", "overlap_join", "overlap_labels", "overlap_mean", "per_allele_fields",
    "position_sort", "region_semi_join", "require_columns", "require_known_samples", "resolve_alleles", "severity_at_least",
    "split_packed", "stage_reconcile", "strip_info_tail", "union_stages", "warn_of_extra_samples",
]
