"""Readers and writers of genomic text and Parquet tables."""

from . import lines
from .index import read_regions, region_ranges, write_bucketed, write_index
from .lines import write_block_gzip
from .manifest import check_stage, manifest, read_checked, write_checked
from .readers import (
    input_paths,
    read_bed,
    read_bed_strict,
    read_constraint,
    read_gene_posterior,
    read_genotypes,
    read_pedigree,
    read_stage,
    read_tsv,
    read_valued_intervals,
)
from .scratch import new_path, shared_dir
from .vcf import packed_fields, read_packed_annotations, read_sites, read_vcf, vcf_header, vcf_samples
from .writers import write_bed, write_sorted, write_stage, write_tsv

__all__ = [
    "check_stage", "input_paths", "manifest", "new_path", "packed_fields", "read_bed", "read_bed_strict", "read_checked", "read_constraint", "read_gene_posterior", "read_genotypes", "read_packed_annotations",
    "read_pedigree", "read_regions", "read_sites", "read_stage", "read_tsv", "read_valued_intervals", "read_vcf", "region_ranges", "shared_dir", "vcf_header", "vcf_samples", "write_bed", "write_block_gzip", "write_bucketed", "write_checked", "write_index",
    "write_sorted", "write_stage", "write_tsv",
]
