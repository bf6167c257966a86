"""Registered queries over the driver's tables, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fn
from .. import operators as op
from .. import sources
from .mappings import view, with_views

SITE = ("chrom", "pos0", "end_", "ref", "alt")
IV = ("chrom", "start_", "end_")


def family_expand(spark: SparkSession, d: str) -> DataFrame:
    return op.family_expand(view(spark, d, "geno"), site=SITE, sample="sample", gt="gt", family="family")


def _resolved(spark: SparkSession, d: str) -> DataFrame:
    return op.resolve_alleles(family_expand(spark, d), SITE, "family", "sample", "gt", "alt", "ad")


def resolve_alleles(spark: SparkSession, d: str) -> DataFrame:
    return _resolved(spark, d)


def info_per_allele(spark: SparkSession, d: str) -> DataFrame:
    rows = op.strip_info_tail(view(spark, d, "info"), "CSQ", "info")
    return op.per_allele_fields(rows, ("AC", "AQ", "MLEAC"), "info", "alt", "allele_num")


def interval_overlap(spark: SparkSession, d: str) -> DataFrame:
    regions = view(spark, d, "rg").select(F.col("chrom").alias("rchrom"), F.col("start_").alias("rstart"), F.col("end_").alias("rend"))
    return op.overlap_join(view(spark, d, "iv"), regions, IV, ("rchrom", "rstart", "rend")).drop("rchrom")


def overlap_count(spark: SparkSession, d: str) -> DataFrame:
    return op.overlap_count(view(spark, d, "iv"), view(spark, d, "rg"), "n", IV, IV)


def overlap_mean(spark: SparkSession, d: str) -> DataFrame:
    """Windows with doubles, as real ones have them; eighths, whose sums any engine has exactly."""
    windows = view(spark, d, "rg").withColumns({"z": F.col("z").cast("double") / 8, "oe": -F.col("z").cast("double") / 1024})
    return op.overlap_mean(view(spark, d, "iv"), windows, {"z": "z_mean", "oe": "oe_mean"}, IV, IV)


def overlap_labels(spark: SparkSession, d: str) -> DataFrame:
    found = op.overlap_labels(view(spark, d, "iv"), view(spark, d, "rg"), "symbol", "symbols", IV, IV)
    return found.withColumn("symbols", F.array_join("symbols", ","))


def overlap_types(spark: SparkSession, d: str) -> DataFrame:
    """A few labels whose features pile up: a span meets each once."""
    found = op.overlap_labels(view(spark, d, "iv"), view(spark, d, "types"), "label", "labels", IV, IV)
    return found.withColumn("labels", F.array_join("labels", ","))


def merge_intervals(spark: SparkSession, d: str) -> DataFrame:
    return op.merge_intervals(view(spark, d, "iv"), IV)


def region_semi_join(spark: SparkSession, d: str) -> DataFrame:
    return op.region_semi_join(view(spark, d, "iv"), view(spark, d, "rg"), IV, IV)


def nearest_interval(spark: SparkSession, d: str) -> DataFrame:
    return op.nearest_interval(view(spark, d, "iv"), view(spark, d, "rg"), "symbol", IV, IV)


def gene_constraint(spark: SparkSession, d: str) -> DataFrame:
    constraint = view(spark, d, "cons").withColumnsRenamed({"pli": "lof.pLI", "oe": "lof.oe_ci.upper"})
    return op.constraint_by_gene(view(spark, d, "ann"), constraint, "symbol")


def transcript_lookup(spark: SparkSession, d: str) -> DataFrame:
    constraint = view(spark, d, "cons").withColumnsRenamed({"pli": "lof.pLI", "oe": "lof.oe_ci.upper"})
    return op.constraint_by_transcript(view(spark, d, "ann"), constraint, "feature")


def gene_posterior(spark: SparkSession, d: str) -> DataFrame:
    return op.gene_posterior(view(spark, d, "ann"), view(spark, d, "post"), "symbol")


def exact_lookup(spark: SparkSession, d: str) -> DataFrame:
    on = {"chrom": "chrom", "pos0": "pos0", "ref": "ref", "alt_specific": "alt"}
    return op.annotate_exact(view(spark, d, "ann"), view(spark, d, "scores"), on, {"score": "score"}).withColumn("score", F.col("score").cast("double"))


def bucketed_lookup(spark: SparkSession, d: str) -> DataFrame:
    """The same lookup against a score table in buckets of its keys, which is not moved."""
    path = sources.new_path(spark, "scores")
    scores = sources.write_bucketed(view(spark, d, "scores"), f"scores_{path[-32:]}", path, ("chrom", "pos0", "ref", "alt"), 16)
    on = {"chrom": "chrom", "pos0": "pos0", "ref": "ref", "alt_specific": "alt"}
    return op.annotate_exact(view(spark, d, "ann"), scores, on, {"score": "score"}).withColumn("score", F.col("score").cast("double"))


def impact_filter(spark: SparkSession, d: str) -> DataFrame:
    return op.impact_filter(view(spark, d, "ann"), "impact")


def severity_filter(spark: SparkSession, d: str) -> DataFrame:
    return op.severity_at_least(view(spark, d, "ann"), view(spark, d, "ranks"), consequence="consequence")


def packed_split(spark: SparkSession, d: str) -> DataFrame:
    return op.split_packed(view(spark, d, "pk"), "csq", ["brand", "type", "x", "y", "more"], "csq_")


def merge_annotations(spark: SparkSession, d: str) -> DataFrame:
    resolved = _resolved(spark, d).withColumnRenamed("ALT_specific", "alt_specific")
    return op.merge_annotations(resolved, impact_filter(spark, d), ("chrom", "pos0", "end_", "ref", "alt_specific"))


def missing_samples(spark: SparkSession, d: str) -> DataFrame:
    return op.missing_samples(view(spark, d, "called"), view(spark, d, "ped"))


def extra_samples(spark: SparkSession, d: str) -> DataFrame:
    return op.extra_samples(view(spark, d, "called"), view(spark, d, "ped"))


def chunk_numbers(spark: SparkSession, d: str) -> DataFrame:
    return op.chunk_numbers(view(spark, d, "iv"), 50, IV)


def stage_reconcile(spark: SparkSession, d: str) -> DataFrame:
    """Three stages' chunks against the regions; some of one chromosome's are missing from the second, all of another's from the third."""
    regions = view(spark, d, "iv")
    chunks = op.chunk_numbers(regions, 100, IV)
    stages = {"scattered": chunks, "queried": chunks.where("not (chrom = 'A' and chunk % 7 = 3)"), "gathered": chunks.where("chrom <> 'N'")}
    return op.stage_reconcile(regions, stages, 100)


def chrom_normalize(spark: SparkSession, d: str) -> DataFrame:
    return op.normalize_chrom(view(spark, d, "chroms"), view(spark, d, "contigs"))


def position_sort(spark: SparkSession, d: str) -> DataFrame:
    """The order of the rows as a column: each row's place on its chromosome."""
    ties = ("end_", "ref", "family", "sample", "gt", "ad")
    rows = op.in_order(view(spark, d, "geno"), "chrom", "pos0", ties)
    return op.position_sort(rows, ("chrom", "pos0"), ties)


def chunk_union(spark: SparkSession, d: str) -> DataFrame:
    rows = view(spark, d, "geno")
    return op.union_stages([rows.where(F.col("chrom") == c) for c in ("chr1", "chr2", "chr3")])


def drop_genotypes(spark: SparkSession, d: str) -> DataFrame:
    return op.drop_genotypes(view(spark, d, "geno"), ("sample", "gt", "ad", "family"))


def family_region_expand(spark: SparkSession, d: str) -> DataFrame:
    """Expansion within regions only, families from a pedigree."""
    geno, pedigree = view(spark, d, "geno").drop("family"), view(spark, d, "geno").select("family", "sample")
    regions = spark.read.parquet(f"{d}/orders.parquet").select(F.concat(F.lit("chr"), (F.col("o_orderkey") % 3 + 1).cast("string")).alias("chrom"), F.col("o_orderkey").alias("start"), (F.col("o_orderkey") + 2).alias("end"))
    return op.family_expand(geno, pedigree, regions, SITE, "sample", "gt", "family", ("chrom", "pos0", "end_")).select("chrom", "pos0", "sample", "gt", "family")


def genotype_text(spark: SparkSession, d: str) -> DataFrame:
    """Call, depth and quality text from numbers."""
    rows = spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", "l_linenumber", F.array(F.col("l_linenumber") % 3 - 1, F.col("l_linenumber") % 2).alias("call"), (F.col("l_orderkey") % 2 == 0).alias("phased"))
    return rows.select("l_orderkey", "l_linenumber", fn.gt_text("call", "phased").alias("gt"), fn.format_text("call").alias("ad"), fn.first_text("call").alias("dp"))


def _text(spark: SparkSession, rows: DataFrame, above: list[str], name: str) -> str:
    """A text file's folder: the lines above in a file of their own, then a line a row."""
    path = sources.new_path(spark, name)
    head = spark.createDataFrame([(x,) for x in above], "value string").coalesce(1)
    head.unionByName(rows.select("value")).write.text(path)
    return path


def _vcf_header(names: list[str], *above: str) -> list[str]:
    return ["##fileformat=VCFv4.2", *above, "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", *names])]


def vcf_read(spark: SparkSession, d: str) -> DataFrame:
    """Orders as sites and their lines as samples, in block-gzip VCFs of two kinds: samples in order, and in reverse with other FORMAT fields."""
    numbers = list(range(1, 8))
    wide = view(spark, d, "calls").groupBy("l_orderkey").pivot("l_linenumber", numbers).agg(F.max("call"))
    chrom = F.concat(F.lit("chr"), (F.col("l_orderkey") % 3 + 1).cast("string"))
    site = [chrom, F.col("l_orderkey").cast("string"), F.lit("."), F.lit("AT"), F.lit("A,ATT"), F.lit("."), F.lit("."), F.lit(".")]
    paths = []
    for fields, order in (("GT:AD:DP", numbers), ("GT:AD:GQ", numbers[::-1])):
        rows = wide.where((F.col("l_orderkey") % 2 == 0) == F.lit(fields == "GT:AD:DP"))
        lines = rows.select(F.concat_ws("\t", *site, F.lit(fields), *[F.coalesce(F.col(str(i)), F.lit("./.")) for i in order]))
        paths.append(sources.new_path(spark, "vcf"))
        sources.write_block_gzip(lines, paths[-1], _vcf_header(["FORMAT", *[f"S{i}" for i in order]]), ".vcf.gz")
    return sources.read_vcf(spark, paths, split_bytes=1 << 16)


def packed_read(spark: SparkSession, d: str) -> DataFrame:
    """Parts as annotated sites in block-gzip VCFs, whose headers declare the fields, in another order for every third part."""
    at = ["p_partkey", F.lit("."), F.lit("A"), F.lit("C,G"), F.lit("."), F.lit(".")]
    rows = view(spark, d, "pk").select(F.concat(F.lit("chr"), (F.col("p_partkey") % 3 + 1).cast("string")).alias("chrom"), F.col("p_partkey").cast("string").alias("p_partkey"), "csq")
    paths = []
    for fields, own in (("Allele|Consequence|IMPACT|Extra|SYMBOL", "chrom <> 'chr1'"), ("IMPACT|Allele|Consequence", "chrom = 'chr1'")):
        info = F.concat(F.lit("AC=1,2;CSQ="), F.regexp_replace("csq", "[ ;]", "_"), F.lit(";DP=9"))
        lines = rows.where(own).select(F.concat_ws("\t", "chrom", *at, info))
        paths.append(sources.new_path(spark, "annotated"))
        told = f'##INFO=<ID=CSQ,Number=.,Type=String,Description="Consequence annotations. Format: {fields}">'
        sources.write_block_gzip(lines, paths[-1], _vcf_header([], told), ".vcf.gz")
    return op.clean_annotation_columns(sources.read_packed_annotations(spark, paths, split_bytes=1 << 14))


def bed_read(spark: SparkSession, d: str) -> DataFrame:
    """Regions as a BED and back."""
    path = sources.new_path(spark, "bed")
    sources.write_bed(view(spark, d, "iv"), path, IV)
    return sources.read_bed(spark, path)


def bed_strict_read(spark: SparkSession, d: str) -> DataFrame:
    """Regions among lines that the strict reader skips, chromosomes named as the contigs are."""
    lines = view(spark, d, "iv").select(F.concat_ws("\t", "chrom", "start_", "end_", F.lit("more")).alias("value"))
    path = _text(spark, lines, ["track name=x", "browser position", "# comment", "", " \t\t ", "X9\tno\tnumbers", "X9\t5\t2"], "bed")
    contigs = spark.createDataFrame([("chrA",), ("N",), ("chrR",)], "contig string")
    return sources.read_bed_strict(spark, path, contigs)


def pedigree_read(spark: SparkSession, d: str) -> DataFrame:
    """Families of customers among lines that the reader skips."""
    lines = view(spark, d, "ped").select(F.concat("family", F.lit("\t "), "sample", F.lit(" 0 0\t")).alias("value"))
    return sources.read_pedigree(spark, _text(spark, lines, ["FamID\tIID\tx", "#F1\tS1", "", "\t", "lonely"], "ped"))


def tsv_read(spark: SparkSession, d: str) -> DataFrame:
    path = sources.new_path(spark, "tsv")
    sources.write_tsv(view(spark, d, "pk").withColumn("quoted", F.lit('"q')), path)
    return sources.read_tsv(spark, path)


def _genotypes(spark: SparkSession, d: str) -> DataFrame:
    names = ["#CHROM", "POS0", "END", "POS", "REF", "ALT", "SAMPLE", "GT", "GQ", "DP", "AD", "FAMILY"]
    return view(spark, d, "genotypes").toDF(*names)


def genotype_tsv(spark: SparkSession, d: str) -> DataFrame:
    """The long genotype table as text, '.' for what is absent, and back."""
    path = sources.new_path(spark, "genotypes")
    sources.write_tsv(_genotypes(spark, d), path)
    return sources.read_genotypes(spark, path)


def constraint_read(spark: SparkSession, d: str) -> DataFrame:
    path = sources.new_path(spark, "constraint")
    rows = view(spark, d, "cons").withColumnsRenamed({"pli": "lof.pLI", "oe": "lof.oe_ci.upper"}).withColumn("more", F.lit(1))
    sources.write_tsv(rows, path, null="NA")
    return sources.read_constraint(spark, path).withColumnsRenamed({"lof.pLI": "pli", "lof.oe_ci.upper": "oe"})


def posterior_read(spark: SparkSession, d: str) -> DataFrame:
    path = sources.new_path(spark, "posterior")
    sources.write_tsv(view(spark, d, "post").withColumn("more", F.lit("x")), path)
    return sources.read_gene_posterior(spark, path)


def windows_read(spark: SparkSession, d: str) -> DataFrame:
    """Valued windows from compressed text with further columns."""
    path = sources.new_path(spark, "windows")
    rows = view(spark, d, "rg").select("chrom", F.col("start_").alias("start"), F.col("end_").alias("end"), F.lit(0).alias("more"), F.col("z").cast("double").alias("z"), (F.col("z") / 8).alias("oe"))
    sources.write_tsv(rows, path, compression="gzip")
    return sources.read_valued_intervals(spark, path)


def sorted_table(spark: SparkSession, d: str) -> DataFrame:
    """The position-sorted table, read back by chromosome; a chromosome 1 stays text."""
    path = sources.new_path(spark, "final")
    sources.write_sorted(_genotypes(spark, d), path)
    return sources.read_stage(spark, path, ["1", "2", "3"])


def region_read(spark: SparkSession, d: str) -> DataFrame:
    """Records of the sorted table that overlap regions, by its index; regions at the first hundredth of the parts, long ones among the records."""
    path = sources.new_path(spark, "indexed")
    rows = _genotypes(spark, d).withColumn("END", F.col("END") + F.when(F.col("POS0") % 97 == 0, 500).otherwise(0))
    sources.write_sorted(rows, path)
    sources.write_index(spark, path)
    regions = view(spark, d, "geno").where("pos0 % 100 = 3").select(F.expr("substr(chrom, 4, 9)").alias("chrom"), F.col("pos0").alias("start"), (F.col("pos0") + 2).alias("end"))
    return sources.read_regions(spark, path, regions)


def stage_paths(spark: SparkSession, d: str) -> DataFrame:
    """One table a chromosome, written as stages and read as one from a list and a pattern."""
    folder, rows = sources.new_path(spark, "stages"), _genotypes(spark, d)
    paths = sources.input_paths("1, 2,3", folder + "/{chrom}/genotypes")
    for chrom, path in paths.items():
        sources.write_stage(rows.where(F.col("`#CHROM`") == chrom), path)
    return spark.read.parquet(*paths.values())


def clean_columns(spark: SparkSession, d: str) -> DataFrame:
    rows = view(spark, d, "info").withColumnsRenamed({"info": "(null)", "alt": "CSQALT", "allele_num": "CSQALLELE_NUM"})
    rows = op.clean_annotation_columns(rows)
    op.require_columns(rows, ("INFO", "ALT", "ALLELE_NUM"))
    return rows


def optional_columns(spark: SparkSession, d: str) -> DataFrame:
    """Alleles resolved from genotypes without ALT and AD."""
    return op.resolve_alleles(family_expand(spark, d).drop("alt", "ad"), SITE, "family", "sample", "gt", "alt", "ad")


def first_missing(spark: SparkSession, d: str) -> DataFrame:
    """What the error about missing samples names: the first 25."""
    return missing_samples(spark, d).orderBy("sample").limit(25)


QUERIES = {
    f.__name__: f
    for f in (
        family_expand, resolve_alleles, info_per_allele, interval_overlap, overlap_count, overlap_mean, overlap_labels, overlap_types, merge_intervals,
        region_semi_join, nearest_interval, gene_constraint, transcript_lookup, gene_posterior, exact_lookup, bucketed_lookup, impact_filter, severity_filter,
        packed_split, merge_annotations, missing_samples, extra_samples, chunk_numbers, stage_reconcile, chrom_normalize, position_sort,
        chunk_union, drop_genotypes, family_region_expand, genotype_text, vcf_read, packed_read, bed_read, bed_strict_read, pedigree_read, tsv_read, genotype_tsv,
        constraint_read, posterior_read, windows_read, sorted_table, region_read, stage_paths, clean_columns, optional_columns, first_missing,
    )
}

_EXPANDED = """, hit AS (
  SELECT DISTINCT chrom, pos0, end_, ref, alt, family FROM geno WHERE regexp_matches(gt, '[1-9]') AND NOT contains(gt, '.')),
expanded AS MATERIALIZED (SELECT geno.* FROM geno SEMI JOIN hit USING (chrom, pos0, end_, ref, alt, family))"""

_RESOLVED = _EXPANDED + """, seen AS MATERIALIZED (SELECT *, regexp_extract_all(gt, '[1-9][0-9]*') alts FROM expanded),
active AS (SELECT DISTINCT chrom, pos0, family, CAST(unnest(alts) AS INTEGER) allele_num FROM seen),
flags AS (SELECT chrom, pos0, family, bool_or(len(alts) > 1 AND len(list_distinct(alts)) > 1) family_has_multiallelic_het FROM seen GROUP BY ALL),
resolved AS (
  SELECT s.chrom, s.pos0, s.end_, s.ref, s.alt, s.sample, s.family, s.gt, s.ad, a.allele_num, string_split(s.alt, ',')[a.allele_num] alt_specific,
    CASE WHEN contains(s.gt, '.') THEN NULL WHEN list_contains(s.alts, CAST(a.allele_num AS VARCHAR)) THEN 1 ELSE 0 END carrier,
    CASE WHEN s.ad <> '.' THEN string_split(s.ad, ',')[1] END AD_ref, CASE WHEN s.ad <> '.' THEN string_split(s.ad, ',')[a.allele_num + 1] END AD_alt,
    len(s.alts) > 1 AND len(list_distinct(s.alts)) > 1 sample_is_multiallelic_het, f.family_has_multiallelic_het,
    array_to_string(s.alts, ',') alleles_in_gt, contains(s.gt, '.') is_missing_gt
  FROM seen s JOIN active a USING (chrom, pos0, family) JOIN flags f USING (chrom, pos0, family))"""

_OVER = "i.chrom = r.chrom AND i.start_ < r.end_ AND r.start_ < i.end_"

SQL = {
    "family_expand": with_views("geno") + _EXPANDED + " SELECT * FROM expanded",
    "resolve_alleles": with_views("geno") + _RESOLVED + ' SELECT * EXCLUDE (alt_specific), alt_specific AS "ALT_specific" FROM resolved',
    "info_per_allele": with_views("info") + """, s AS (
  SELECT *, regexp_replace(info, ';CSQ.*', '') stripped, coalesce(TRY_CAST(allele_num AS INTEGER), 1) n FROM info), p AS (SELECT *, CASE WHEN n >= 1 THEN n ELSE -1 END k FROM s)
SELECT l_orderkey, l_linenumber, stripped AS info, alt, allele_num, string_split(alt, ',')[k] AS "ALT_specific",
  coalesce(string_split(nullif(regexp_extract(stripped, 'AC=([^;]+)', 1), ''), ',')[k], 'NA') AS "AC", 'NA' AS "AQ",
  coalesce(string_split(nullif(regexp_extract(stripped, 'MLEAC=([^;]+)', 1), ''), ',')[k], 'NA') AS "MLEAC" FROM p""",
    "interval_overlap": with_views("iv", "rg") + f" SELECT i.chrom, i.start_, i.end_, r.start_ rstart, r.end_ rend FROM iv i JOIN rg r ON {_OVER}",
    "overlap_count": with_views("iv", "rg") + f" SELECT i.chrom, i.start_, i.end_, count(r.start_) n FROM iv i LEFT JOIN rg r ON {_OVER} GROUP BY ALL",
    "overlap_mean": with_views("iv", "rg") + f" SELECT i.chrom, i.start_, i.end_, sum(r.z / 8.0e0) / nullif(count(r.z), 0) z_mean, sum(-r.z / 1024.0e0) / nullif(count(r.z), 0) oe_mean FROM iv i LEFT JOIN rg r ON {_OVER} GROUP BY ALL",
    "overlap_labels": with_views("iv", "rg") + f" SELECT i.chrom, i.start_, i.end_, coalesce(string_agg(DISTINCT r.symbol, ',' ORDER BY r.symbol), '') symbols FROM iv i LEFT JOIN rg r ON {_OVER} GROUP BY ALL",
    "overlap_types": with_views("iv", "types") + f" SELECT i.chrom, i.start_, i.end_, coalesce(string_agg(DISTINCT r.label, ',' ORDER BY r.label), '') labels FROM iv i LEFT JOIN types r ON {_OVER} GROUP BY ALL",
    "merge_intervals": with_views("iv") + """, m AS (
  SELECT *, max(end_) OVER (PARTITION BY chrom ORDER BY start_, end_ ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) reach FROM iv),
n AS (SELECT *, sum(CASE WHEN reach IS NULL OR start_ > reach + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY start_, end_ ROWS UNBOUNDED PRECEDING) island FROM m)
SELECT chrom, min(start_) start_, max(end_) end_ FROM n GROUP BY chrom, island""",
    "region_semi_join": with_views("iv", "rg") + f" SELECT * FROM iv i WHERE EXISTS (SELECT 1 FROM rg r WHERE {_OVER})",
    "nearest_interval": with_views("iv", "rg") + f""", g AS (SELECT chrom, start_, end_, symbol FROM rg),
o AS (SELECT i.chrom, i.start_, i.end_, 0 d, r.start_ gs, r.symbol FROM iv i JOIN g r ON {_OVER}),
le AS (SELECT chrom, end_, min(struct_pack(gs := start_, symbol := symbol)) b FROM g GROUP BY ALL), ri AS (SELECT chrom, start_, min(symbol) symbol FROM g GROUP BY ALL),
l AS (SELECT i.chrom, i.start_, i.end_, i.start_ - le.end_ d, le.b.gs gs, le.b.symbol symbol FROM iv i ASOF JOIN le ON i.chrom = le.chrom AND i.start_ >= le.end_),
r AS (SELECT i.chrom, i.start_, i.end_, ri.start_ - i.end_ d, ri.start_ gs, ri.symbol FROM iv i ASOF JOIN ri ON i.chrom = ri.chrom AND i.end_ <= ri.start_),
b AS (SELECT chrom, start_, end_, min(struct_pack(d := d, gs := gs, symbol := symbol)) b FROM (SELECT * FROM o UNION ALL SELECT * FROM l UNION ALL SELECT * FROM r) GROUP BY ALL)
SELECT i.chrom, i.start_, i.end_, b.b.symbol nearest_symbol, CAST(b.b.d AS BIGINT) nearest_distance FROM iv i LEFT JOIN b USING (chrom, start_, end_)""",
    "gene_constraint": with_views("ann", "cons") + """, c AS (SELECT gene, max(pli) a, min(oe) b, max(pli) FILTER (WHERE canonical) c, min(oe) FILTER (WHERE canonical) d FROM cons GROUP BY gene)
SELECT ann.*, c.a AS "gnomad_lof_pLI_max", c.b AS gnomad_lof_oe_ci_upper_min, c.c AS "gnomad_lof_pLI_canonical", c.d AS gnomad_lof_oe_ci_upper_canonical FROM ann LEFT JOIN c ON symbol = gene""",
    "transcript_lookup": with_views("ann", "cons") + ' SELECT ann.*, pli AS "gnomad_lof_pLI_tx", oe AS gnomad_lof_oe_ci_upper_tx FROM ann LEFT JOIN cons ON feature = transcript',
    "gene_posterior": with_views("ann", "post") + """ SELECT ann.*, obs_lof AS genebayes_obs_lof, exp_lof AS genebayes_exp_lof, prior_mean AS genebayes_prior_mean, post_mean AS genebayes_post_mean,
  post_lower_95 AS genebayes_post_lower_95, post_upper_95 AS genebayes_post_upper_95 FROM ann LEFT JOIN post ON symbol = ensg""",
    "exact_lookup": with_views("ann", "scores") + " SELECT ann.*, CAST(score AS DOUBLE) score FROM ann LEFT JOIN scores s ON s.chrom = ann.chrom AND s.pos0 = ann.pos0 AND s.ref = ann.ref AND s.alt = alt_specific",
    "bucketed_lookup": with_views("ann", "scores") + " SELECT ann.*, CAST(score AS DOUBLE) score FROM ann LEFT JOIN scores s ON s.chrom = ann.chrom AND s.pos0 = ann.pos0 AND s.ref = ann.ref AND s.alt = alt_specific",
    "impact_filter": with_views("ann") + " SELECT * FROM ann WHERE impact IN ('HIGH', 'MODERATE')",
    "severity_filter": with_views("ann", "ranks") + " SELECT * FROM ann WHERE (SELECT max(rank) FROM ranks WHERE list_contains(string_split(consequence, '&'), term)) >= 4",
    "packed_split": with_views("pk") + """, s AS (SELECT p_partkey, string_split(unnest(string_split(csq, ',')), '|') p FROM pk)
SELECT p_partkey, p[1] csq_brand, p[2] csq_type, p[3] csq_x, p[4] csq_y, p[5] csq_more FROM s""",
    "merge_annotations": with_views("geno", "ann") + _RESOLVED + """
SELECT r.*, a.allele_num AS allele_num_var, a.symbol, a.feature, a.impact, a.consequence FROM resolved r
JOIN ann a ON a.chrom = r.chrom AND a.pos0 = r.pos0 AND a.end_ = r.end_ AND a.ref = r.ref AND a.alt_specific = r.alt_specific WHERE impact IN ('HIGH', 'MODERATE')""",
    "missing_samples": with_views("called", "ped") + " SELECT sample FROM called EXCEPT SELECT sample FROM ped",
    "extra_samples": with_views("called", "ped") + " SELECT sample FROM ped EXCEPT SELECT sample FROM called",
    "chunk_numbers": with_views("iv") + " SELECT *, CAST((row_number() OVER (PARTITION BY chrom ORDER BY start_, end_) - 1) // 50 AS BIGINT) chunk FROM iv",
    "stage_reconcile": with_views("iv") + """, k AS (SELECT chrom, (row_number() OVER (PARTITION BY chrom ORDER BY start_, end_) - 1) // 100 k FROM iv),
c AS (SELECT chrom, CAST(ceil(count(*) / 100.0) AS BIGINT) expected, count(DISTINCT k) scattered, count(DISTINCT k) FILTER (WHERE NOT (chrom = 'A' AND k % 7 = 3)) queried,
  count(DISTINCT k) FILTER (WHERE chrom <> 'N') gathered FROM k GROUP BY chrom)
SELECT *, expected = scattered AND expected = queried AND expected = gathered agrees FROM c""",
    "chrom_normalize": with_views("chroms", "contigs") + """ SELECT o_orderkey, chrom, coalesce((SELECT contig FROM contigs WHERE contig = chrom), (SELECT contig FROM contigs WHERE contig = 'chr' || chrom),
  (SELECT contig FROM contigs WHERE chrom LIKE 'chr%' AND contig = substr(chrom, 4))) contig_name FROM chroms""",
    "position_sort": with_views("geno") + " SELECT *, CAST(row_number() OVER (PARTITION BY chrom ORDER BY pos0, end_, ref, family, sample, gt, ad) AS BIGINT) place FROM geno",
    "chunk_union": with_views("geno") + " SELECT * FROM geno",
    "drop_genotypes": with_views("geno") + " SELECT chrom, pos0, end_, ref, alt FROM geno",
    "family_region_expand": with_views("geno") + """, reg AS (SELECT DISTINCT concat('chr', CAST(o_orderkey % 3 + 1 AS VARCHAR)) chrom, o_orderkey s, o_orderkey + 2 e FROM orders),
kept AS (SELECT g.* FROM geno g WHERE EXISTS (SELECT 1 FROM reg WHERE reg.chrom = g.chrom AND g.pos0 < e AND s < g.end_))
SELECT chrom, pos0, sample, gt, family FROM kept g WHERE EXISTS (
  SELECT 1 FROM kept h WHERE h.chrom = g.chrom AND h.pos0 = g.pos0 AND h.family = g.family AND regexp_matches(h.gt, '[1-9]') AND NOT contains(h.gt, '.'))""",
    "genotype_text": """
SELECT l_orderkey, l_linenumber, concat(CASE WHEN l_linenumber % 3 = 0 THEN '.' ELSE CAST(l_linenumber % 3 - 1 AS VARCHAR) END, CASE WHEN l_orderkey % 2 = 0 THEN '|' ELSE '/' END, CAST(l_linenumber % 2 AS VARCHAR)) gt,
  concat(CAST(l_linenumber % 3 - 1 AS VARCHAR), ',', CAST(l_linenumber % 2 AS VARCHAR)) ad, CAST(l_linenumber % 3 - 1 AS VARCHAR) dp FROM lineitem""",
    "vcf_read": with_views("calls") + """, site AS (SELECT DISTINCT l_orderkey o FROM calls),
c AS (SELECT o, k, string_split(coalesce(call, './.'), ':') p FROM site CROSS JOIN range(1, 8) t(k) LEFT JOIN calls ON l_orderkey = o AND l_linenumber = k)
SELECT concat('chr', CAST(o % 3 + 1 AS VARCHAR)) "#CHROM", o - 1 "POS0", o + 1 "END", o "POS", 'AT' "REF", 'A,ATT' "ALT", concat('S', CAST(k AS VARCHAR)) "SAMPLE",
  p[1] "GT", CASE WHEN o % 2 = 1 THEN coalesce(p[3], '.') ELSE '.' END "GQ", CASE WHEN o % 2 = 0 THEN coalesce(p[3], '.') ELSE '.' END "DP", coalesce(p[2], '.') "AD" FROM c""",
    "packed_read": with_views("pk") + """, s AS (SELECT p_partkey k, p_partkey % 3 = 0 one, string_split(unnest(string_split(regexp_replace(csq, '[ ;]', '_', 'g'), ',')), '|') p FROM pk)
SELECT concat('chr', CAST(k % 3 + 1 AS VARCHAR)) "#CHROM", k - 1 "POS0", k "END", k "POS", 'A' "REF", 'C,G' "ALT", '.' "ID", '.' "QUAL", 'AC=1,2;DP=9' "INFO",
  p[CASE WHEN one THEN 2 ELSE 1 END] "Allele", p[CASE WHEN one THEN 3 ELSE 2 END] "Consequence", p[CASE WHEN one THEN 1 ELSE 3 END] "IMPACT",
  CASE WHEN NOT one THEN p[4] END "Extra", CASE WHEN NOT one THEN p[5] END "SYMBOL" FROM s""",
    "bed_read": with_views("iv") + ' SELECT chrom, start_ "start", end_ "end" FROM iv',
    "bed_strict_read": with_views("iv") + """ SELECT CASE chrom WHEN 'N' THEN 'N' ELSE 'chr' || chrom END chrom, start_ "start", end_ "end" FROM iv""",
    "pedigree_read": with_views("ped") + " SELECT DISTINCT family, sample FROM ped",
    "tsv_read": with_views("pk") + """ SELECT CAST(p_partkey AS VARCHAR) p_partkey, csq, '"q' quoted FROM pk""",
    "genotype_tsv": with_views("geno", "genotypes") + """ SELECT chrom "#CHROM", pos0 "POS0", end0 "END", pos "POS", ref "REF", alt "ALT", sample "SAMPLE", gt "GT", gq "GQ", dp "DP", coalesce(ad, '.') "AD", family "FAMILY" FROM genotypes""",
    "constraint_read": with_views("cons") + " SELECT * FROM cons",
    "posterior_read": with_views("post") + " SELECT * FROM post",
    "windows_read": with_views("rg") + ' SELECT chrom, start_ "start", end_ "end", CAST(z AS DOUBLE) z, z / 8.0e0 oe FROM rg',
    "sorted_table": with_views("geno", "genotypes") + """ SELECT chrom "#CHROM", pos0 "POS0", end0 "END", pos "POS", ref "REF", alt "ALT", sample "SAMPLE", gt "GT", gq "GQ", dp "DP", ad "AD", family "FAMILY" FROM genotypes""",
    "region_read": with_views("geno", "genotypes") + """, g AS (SELECT chrom "#CHROM", pos0 "POS0", end0 + CASE WHEN pos0 % 97 = 0 THEN 500 ELSE 0 END "END", pos "POS", ref "REF", alt "ALT", sample "SAMPLE", gt "GT", gq "GQ", dp "DP", ad "AD", family "FAMILY" FROM genotypes),
reg AS (SELECT DISTINCT chrom c, pos0 s, pos0 + 2 e FROM genotypes WHERE pos0 % 100 = 3)
SELECT * FROM g WHERE EXISTS (SELECT 1 FROM reg WHERE c = "#CHROM" AND "POS0" < e AND s < "END")""",
    "stage_paths": with_views("geno", "genotypes") + """ SELECT chrom "#CHROM", pos0 "POS0", end0 "END", pos "POS", ref "REF", alt "ALT", sample "SAMPLE", gt "GT", gq "GQ", dp "DP", ad "AD", family "FAMILY" FROM genotypes""",
    "clean_columns": with_views("info") + ' SELECT l_orderkey, l_linenumber, info "INFO", alt "ALT", allele_num "ALLELE_NUM" FROM info',
    "optional_columns": with_views("geno") + _RESOLVED + """
SELECT chrom, pos0, end_, ref, sample, family, gt, allele_num, CAST(NULL AS VARCHAR) AS "ALT_specific", carrier, CAST(NULL AS VARCHAR) AS "AD_ref", CAST(NULL AS VARCHAR) AS "AD_alt",
  sample_is_multiallelic_het, family_has_multiallelic_het, alleles_in_gt, is_missing_gt FROM resolved""",
    "first_missing": with_views("called", "ped") + " SELECT sample FROM (SELECT sample FROM called EXCEPT SELECT sample FROM ped) ORDER BY sample LIMIT 25",
}
