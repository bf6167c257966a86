import pytest

from pedigrove import sources
from pedigrove.plans import stages


def put(path, text):
    path.write_text(text)
    return str(path)


def test_bed_strict(spark, tmp_path):
    contigs = spark.createDataFrame([("chr1",), ("2",)], "contig string")
    ok = put(tmp_path / "a.bed", "track x\nbrowser y\n#c\n\n1\t0\t5\nchr2\t3\t4\nchr9\t1\t2\n")
    with pytest.warns(UserWarning):
        assert sorted(tuple(r) for r in sources.read_bed_strict(spark, ok, contigs).collect()) == [("2", 3, 4), ("chr1", 0, 5)]
    unknown_first = put(tmp_path / "u.bed", " \t\t\nchr9\tno\tnumber\nchr9\t5\t2\n1\t0\t5\n")
    with pytest.warns(UserWarning, match="2 regions"):
        assert [tuple(r) for r in sources.read_bed_strict(spark, unknown_first, contigs).collect()] == [("chr1", 0, 5)]
    for i, bad in enumerate(("1\t0\n", "1\ta\t5\n", "1\t5\t5\n", "#only\n")):
        with pytest.raises(ValueError):
            sources.read_bed_strict(spark, put(tmp_path / f"b{i}.bed", bad), contigs)


def test_pedigree(spark, tmp_path):
    path = put(tmp_path / "p.ped", "FAM IID x\n#c\n\nF1 S1 0\nF1\tS2\nlonely\nF2 S3\n")
    assert sorted(tuple(r) for r in sources.read_pedigree(spark, path).collect()) == [("F1", "S1"), ("F1", "S2"), ("F2", "S3")]
    blank = put(tmp_path / "r.ped", "F1 S1\n\t\n\tF2 S2\t\n \n")
    assert sorted(tuple(r) for r in sources.read_pedigree(spark, blank).collect()) == [("F1", "S1"), ("F2", "S2")]
    twice = put(tmp_path / "q.ped", "F1 S1\nF2 S1\n")
    with pytest.raises(ValueError):
        sources.read_pedigree(spark, twice)
    assert sources.read_pedigree(spark, twice, keep="last").first().family == "F2"


def test_pedigree_of_several_files(spark, tmp_path):
    """The later of the given paths decides, whatever the sizes; within one the later line; within a folder the later name."""
    small, large = put(tmp_path / "z.ped", "F1 S1\nF2 S1\n"), put(tmp_path / "a.ped", "F3 S1\n" + "".join(f"G{i} T{i}\n" for i in range(20000)))
    family = lambda path: sources.read_pedigree(spark, path, keep="last").where("sample = 'S1'").first().family
    assert [family(p) for p in ([small, large], [large, small], str(tmp_path), small)] == ["F3", "F2", "F2", "F2"]


def test_numbers_are_strict(spark, tmp_path):
    c = put(tmp_path / "c.tsv", "gene\ttranscript\tcanonical\tlof.pLI\tlof.oe_ci.upper\ng\tt\ttrue\tabc\tNA\n")
    with pytest.raises(Exception, match="lof.pLI is no double: abc"):
        sources.read_constraint(spark, c).collect()
    assert sources.read_constraint(spark, c, lenient=True).first()["lof.pLI"] is None
    w = put(tmp_path / "w.tsv", "chrom\tstart\tend\tz\toe\n1\t1.5\t3\t1\t1\n")
    with pytest.raises(Exception, match="start is no bigint: 1.5"):
        sources.read_valued_intervals(spark, w).collect()
    p = put(tmp_path / "p.tsv", "ensg\tobs_lof\texp_lof\tprior_mean\tpost_mean\tpost_lower_95\tpost_upper_95\ng\t1\t\tx\t1\t1\t1\n")
    with pytest.raises(Exception, match="prior_mean is no double: x"):
        sources.read_gene_posterior(spark, p).collect()


def test_typed_tables(spark, tmp_path):
    c = put(tmp_path / "c.tsv", "gene\ttranscript\tcanonical\tmore\tlof.pLI\tlof.oe_ci.upper\ng\tt\ttrue\t\"q\t0.5\tNA\n")
    r = sources.read_constraint(spark, c).first()
    assert (r["gene"], r["canonical"], r["lof.pLI"], r["lof.oe_ci.upper"]) == ("g", True, 0.5, None)
    assert sources.read_tsv(spark, c).first()["more"] == '"q'


VCF = """##x
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2\tS3
chr1\t11\t.\tA\tC,G\t.\t.\t.\tGT:AD:DP:GQ\t1/2:1,9,8:18:99\t0/0:20,0,0:20:50\t0/1
chr1\t50\t.\tAT\tA\t.\t.\t.\tGT\t0/0\t0/0\t./.
"""


def test_whole_run(spark, tmp_path):
    genotypes = sources.read_vcf(spark, put(tmp_path / "g.vcf", VCF))
    r = genotypes.where("SAMPLE = 'S1' and POS0 = 10").first()
    assert (r.END, r.GT, r.AD, r.DP, r.GQ) == (11, "1/2", "1,9,8", "18", "99") and genotypes.where("SAMPLE = 'S3' and POS0 = 10").first().AD == "."
    assert genotypes.where("POS0 = 49").first().END == 51
    variants = sources.read_tsv(spark, put(tmp_path / "v.tsv", "#CHROM\tPOS0\tEND\tPOS\tREF\tALT\t(null)\tCSQALLELE_NUM\tCSQIMPACT\nchr1\t10\t11\t11\tA\tC,G\tAC=3,5;CSQ=z\t1\tHIGH\nchr1\t10\t11\t11\tA\tC,G\tAC=3,5;CSQ=z\t2\tLOW\n"))
    pedigree = spark.createDataFrame([("F1", "S1"), ("F1", "S2"), ("F2", "S3")], "family string, sample string")
    regions = spark.createDataFrame([("chr1", 0, 100)], "chrom string, start long, end long")
    out = stages.run_all(spark, genotypes, variants, pedigree, stages.Resources(regions={"segDups": regions}), str(tmp_path / "out"))
    got = sorted((r.SAMPLE, r.FAMILY, r.ALT_specific, r.carrier, r.AC, r.segDups, r.ALT_var) for r in out.collect())
    assert got == [("S1", "F1", "C", 1, "3", 1, "C,G"), ("S2", "F1", "C", 0, "3", 1, "C,G"), ("S3", "F2", "C", 1, "3", 1, "C,G")]
    sources.write_tsv(out, str(tmp_path / "tsv"))
    sources.write_bed(regions, str(tmp_path / "bed"))
    assert sources.read_bed(spark, str(tmp_path / "bed")).first().end == 100
    assert sources.read_checked(spark, str(tmp_path / "out" / "final"), ["chr1"]).count() == 3
    rows = [("1", 5, 7, "b"), ("1", 5, 6, "z"), ("1", 5, 6, "a"), ("10", 1, 2, "a"), ("2", 9, 10, "a"), (None, 1, 2, "a")]
    sources.write_sorted(spark.createDataFrame(rows, "`#CHROM` string, POS0 long, END long, REF string"), str(tmp_path / "sorted"), partitions=1)
    back = sources.read_stage(spark, str(tmp_path / "sorted"))
    assert back.schema["#CHROM"].dataType.simpleString() == "string" and sorted(map(str, map(tuple, back.collect()))) == sorted(map(str, rows))
    assert [tuple(r) for r in sources.read_stage(spark, str(tmp_path / "sorted"), ["1"]).collect()] == sorted(r for r in rows if r[0] == "1")
    assert sources.input_paths("chr1, chr2", "x/{chrom}.vcf") == {"chr1": "x/chr1.vcf", "chr2": "x/chr2.vcf"}
