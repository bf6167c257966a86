"""Stages with manifests: reconciliation of a run, damage, breaks, reruns of single chromosomes."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from pedigrove import operators as op
from pedigrove import sources
from pedigrove.plans import stages

GT = "`#CHROM` string, POS0 long, END long, POS long, REF string, ALT string, SAMPLE string, GT string, AD string"


def inputs(spark, alt="C"):
    sites = [(c, p) for c in ("chr1", "chr2", "7") for p in (10, 20)]
    genotypes = spark.createDataFrame([(c, p, p + 1, p + 1, "A", alt, s, "0/1" if s == "S1" else "0/0", "1,2") for c, p in sites for s in ("S1", "S2")], GT)
    variants = spark.createDataFrame([(c, p, p + 1, p + 1, "A", alt, f"AC=1;END={p + 1 + (c == '7')}", "1", "HIGH" if p == 10 else "LOW") for c, p in sites], "`#CHROM` string, POS0 long, END long, POS long, REF string, ALT string, INFO string, ALLELE_NUM string, IMPACT string")
    pedigree = spark.createDataFrame([("F1", "S1"), ("F1", "S2")], "family string, sample string")
    return genotypes, variants, pedigree, stages.Resources()


def rows(df):
    return sorted((r["#CHROM"], r.POS0, r.SAMPLE, r.ALT_specific) for r in df.collect())


def test_run_rerun_and_damage(spark, tmp_path):
    out = str(tmp_path / "out")
    genotypes, variants, pedigree, resources = inputs(spark)
    with pytest.warns(UserWarning, match="2 records have an INFO/END"):
        first = stages.run_all(spark, genotypes, variants, pedigree, resources, out)
    assert rows(first) == sorted((c, 10, s, "C") for c in ("chr1", "chr2", "7") for s in ("S1", "S2"))
    told = stages.reconcile(spark, out)
    assert told["annotated"] == {"chrom-chr1": 2, "chrom-chr2": 2, "chrom-7": 2} and told["final"] == {"chrom-chr1": 2, "chrom-chr2": 2, "chrom-7": 2}
    assert {r.chrom: (r.sites, r.differing) for r in op.end_differences(variants).collect()} == {"chr1": (2, 0), "chr2": (2, 0), "7": (2, 2)}

    # Only chr2 is redone: with another allele, and from inputs that have the others changed too.
    files = lambda c: {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{out}/*/_chromosome=chrom-{c}/*")}
    before = files("chr1") | files("7")
    genotypes, variants, *_ = inputs(spark, alt="G")
    again = stages.run_all(spark, genotypes, variants, pedigree, resources, out, chroms=["chr2"])
    assert rows(again) == sorted((c, 10, s, "G" if c == "chr2" else "C") for c in ("chr1", "chr2", "7") for s in ("S1", "S2"))
    assert files("chr1") | files("7") == before and rows(sources.read_checked(spark, f"{out}/final", ["chr2"])) == [("chr2", 10, "S1", "G"), ("chr2", 10, "S2", "G")]
    # A chromosome without rows goes, though its folder is left.
    stages.run_all(spark, genotypes, variants.where("`#CHROM` <> 'chr2'"), pedigree, resources, out, chroms=["chr2"])
    assert {r[0] for r in rows(sources.read_checked(spark, f"{out}/final"))} == {"chr1", "7"}

    # Files that are gone are noticed by the footers' counts.
    for f in glob.glob(f"{out}/resolved/_chromosome=chrom-7/*.parquet"):
        os.rename(f, f"{tmp_path}/{os.path.basename(f)}")
    with pytest.raises(ValueError, match="resolved is damaged: 7 has 0 of 2 rows"):
        stages.run_merge(spark, out)
    with pytest.raises(ValueError, match="damaged"):
        sources.read_checked(spark, f"{out}/resolved")


def test_a_stage_that_loses_a_chromosome_is_named(spark, tmp_path, monkeypatch):
    resolve = op.resolve_alleles
    monkeypatch.setattr(op, "resolve_alleles", lambda df: resolve(df).where("`#CHROM` <> 'chr2'"))
    with pytest.raises(ValueError, match="resolved has lost chromosomes of families: chr2"), pytest.warns(UserWarning):
        stages.run_all(spark, *inputs(spark), str(tmp_path / "out"))


def test_a_stage_half_written_is_refused(spark, tmp_path):
    path = str(tmp_path / "stage")
    df = spark.createDataFrame([("1", 5), ("2", 6), (None, 7)], "`#CHROM` string, POS0 long")
    assert sources.write_checked(df, path, metrics={"most": F.max("POS0")})["metrics"] == {"most": 7}
    assert sorted(map(str, map(tuple, sources.read_checked(spark, path).collect()))) == sorted(map(str, [("1", 5), ("2", 6), (None, 7)]))
    broken = df.withColumn("POS0", F.when(F.col("POS0") == 6, F.raise_error(F.lit("broke off")).cast("long")).otherwise(F.col("POS0")))
    with pytest.raises(Exception, match="broke off"):
        sources.write_checked(broken, path, chroms=["2"])
    with pytest.raises(ValueError, match="not written whole"):
        sources.read_checked(spark, path)
    sources.write_checked(df.withColumn("POS0", F.lit(9).cast("long")), path, chroms=["2"])
    assert {(r[0], r[1]) for r in sources.read_checked(spark, path).collect()} == {("1", 5), ("2", 9), (None, 7)}
    with pytest.raises(ValueError, match="no manifest"):
        sources.read_checked(spark, str(tmp_path / "none"))
    empty = str(tmp_path / "empty")
    sources.write_checked(df.limit(0), empty, ordered=True)
    assert sources.read_checked(spark, empty).isEmpty() and sources.read_checked(spark, empty).columns == df.columns


def test_region_reads_skip_row_groups(spark, tmp_path):
    """One hundredth of the positions in 30 regions: the ranges touch under a twentieth of the row groups; records that begin far before a region are found."""
    import pyarrow.parquet as pq

    path = str(tmp_path / "t")
    df = spark.range(200_000).select((F.col("id") % 2 + 1).cast("string").alias("#CHROM"), (F.col("id") * 50).alias("POS0"), (F.col("id") * 50 + F.when(F.col("id") == 7777, 3_000_000).otherwise(1)).alias("END"), F.sha2(F.col("id").cast("string"), 256).alias("REF"))
    spark.conf.set("parquet.block.size", 1 << 15)
    spark.conf.set("parquet.block.size.row.check.min", 100)
    try:
        sources.write_sorted(df, path, partitions=8)
    finally:
        spark.conf.unset("parquet.block.size")
    sources.write_index(spark, path)
    regions = spark.createDataFrame([("1", 5_000_000 + i * 3000, 5_000_000 + i * 3000 + 50) for i in range(30)] + [("2", 1_000_000, 1_000_010)], "chrom string, start long, end long")
    got = sources.read_regions(spark, path, regions)
    want = op.region_semi_join(df, regions)
    assert sorted((r["#CHROM"], r.POS0) for r in got.collect()) == sorted((r["#CHROM"], r.POS0) for r in want.collect())
    assert "PushedFilters" in got._jdf.queryExecution().executedPlan().toString()
    ranges = sources.region_ranges(spark, path, regions)
    total = touched = 0
    for f in glob.glob(f"{path}/_chromosome=*/*.parquet"):
        told, chrom = pq.ParquetFile(f).metadata, f.split("chrom-")[1].split("/")[0]
        at = [i for i in range(told.num_columns) if told.row_group(0).column(i).path_in_schema == "POS0"][0]
        for g in range(told.num_row_groups):
            low, high = told.row_group(g).column(at).statistics.min, told.row_group(g).column(at).statistics.max
            total += 1
            touched += any(c == chrom and lo <= high and low < hi for c, lo, hi in ranges)
    assert total > 100 and touched < 0.05 * total
    assert sources.read_regions(spark, path, regions.limit(0)).isEmpty()


def test_ranges_that_touch_are_one(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(20_000).select(F.lit("1").alias("#CHROM"), F.col("id").alias("POS0"), (F.col("id") + 1).alias("END"), F.lit("A").alias("REF"))
    sources.write_sorted(df, path)
    sources.write_index(spark, path)
    regions = spark.range(200).select(F.lit("1").alias("chrom"), (F.col("id") * 100).alias("start"), (F.col("id") * 100 + 2).alias("end"))
    assert sources.region_ranges(spark, path, regions) == [("1", 0, 19_902)]
    assert sources.read_regions(spark, path, regions).count() == 400


def test_bucketed_lookup_moves_one_side(spark, tmp_path):
    scores = spark.range(3000).selectExpr("concat('c', id % 3) as chrom", "id as pos", "id / 2 as score")
    table = sources.write_bucketed(scores, "scores_of_a_test", str(tmp_path / "scores"), ("chrom", "pos"), 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = op.annotate_exact(spark.createDataFrame([("c1", 1), ("c1", 2), (None, 4)], "chrom string, pos long"), table, {"chrom": "chrom", "pos": "pos"}, {"score": "s"})
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert {(r.chrom, r.pos, r.s) for r in out.collect()} == {("c1", 1, 0.5), ("c1", 2, None), (None, 4, None)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table scores_of_a_test")
    scan = plan.index("Bucketed: true")
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange" not in plan[plan.rindex("Sort [", 0, scan) : scan]
