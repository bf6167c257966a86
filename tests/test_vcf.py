"""Variant call files: several headers, wide cohorts, packed annotations, and block gzip read in splits."""

import gzip
import json
import random
import time

import pytest
from pyspark.sql import functions as F

from pedigrove import operators as op
from pedigrove import sources
from pedigrove.plans import stages
from pedigrove.sources import lines

HEAD = "##fileformat=VCFv4.2\n"
COLUMNS = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"


def put(path, text):
    path.write_text(text)
    return str(path)


def blocks(text: bytes, size: int = 100) -> bytes:
    return b"".join(lines.packed(text[i : i + size]) for i in range(0, len(text), size)) + lines.END


def test_samples_are_those_of_each_file(spark, tmp_path):
    a = put(tmp_path / "a b.vcf", f"{HEAD}{COLUMNS}\tFORMAT\tA\tB\nchr1\t5\t.\tA\tC\t.\t.\t.\tGT:GQ\t0/0:9\t0/1:8,7\n")
    b = put(tmp_path / "b.vcf", f"{HEAD}{COLUMNS}\tFORMAT\tB\tA\tC\nchr2\t5\t.\tAT\tC\t.\t.\t.\tDP:GT:AD\t7:0/1:1,2\t8:0/0\t.\n")
    c = str(tmp_path / "c.vcf.gz")
    with gzip.open(c, "wt") as f:
        f.write(f"{HEAD}{COLUMNS}\nchr3\t5\t.\tA\tC\t.\t.\tEND=9\n")
    rows = {(r["#CHROM"], r.SAMPLE): (r.POS0, r.END, r.GT, r.GQ, r.DP, r.AD) for r in sources.read_vcf(spark, [a, b, c]).collect()}
    assert rows == {("chr1", "A"): (4, 5, "0/0", "9", ".", "."), ("chr1", "B"): (4, 5, "0/1", "8", ".", "."), ("chr2", "B"): (4, 6, "0/1", ".", "7", "1,2"), ("chr2", "A"): (4, 6, "0/0", ".", "8", "."), ("chr2", "C"): (4, 6, ".", ".", ".", ".")}
    assert {r.SAMPLE for r in sources.read_vcf(spark, [a, b], samples=["C", "x"]).collect()} == {"C"}
    assert sorted((r.position, r.SAMPLE) for r in sources.vcf_samples(spark, b).collect()) == [(0, "B"), (1, "A"), (2, "C")]
    assert sources.read_sites(spark, [a, b, c]).where("`#CHROM` = 'chr3'").first().INFO == "END=9" and sources.vcf_header(spark, a)[-2:] == ["A", "B"]
    ragged = put(tmp_path / "r.vcf", f"{HEAD}{COLUMNS}\tFORMAT\tA\tB\nchr1\t5\t.\tA\tC\t.\t.\t.\tGT\t0/0\n")
    with pytest.raises(Exception, match="record with 1 calls for 2 samples: chr1:5"):
        sources.read_vcf(spark, ragged).collect()
    with pytest.raises(ValueError, match="no #CHROM line"):
        sources.read_vcf(spark, [a, put(tmp_path / "n.vcf", "##x\n")])


def test_wide_cohorts_plan_fast(spark, tmp_path):
    names = [f"SAMPLE_{i}" for i in range(12519)]
    calls = ["0/1" if i % 1000 == 7 else "0/0" for i in range(len(names))]
    path = put(tmp_path / "w.vcf", f"{HEAD}{COLUMNS}\tFORMAT\t" + "\t".join(names) + "\n" + "".join(f"chr1\t{p}\t.\tA\tC\t.\t.\t.\tGT\t" + "\t".join(calls) + "\n" for p in range(1, 6)))
    sources.read_vcf(spark, path)._jdf.queryExecution().executedPlan()  # compiled once
    began = time.time()
    rows = sources.read_vcf(spark, path)
    rows._jdf.queryExecution().executedPlan()
    assert time.time() - began < 2
    assert rows.count() == 5 * len(names)
    assert {r.SAMPLE for r in rows.where("GT = '0/1' and POS = 3").collect()} == {f"SAMPLE_{i}" for i in range(7, len(names), 1000)}


CSQ = '##INFO=<ID=CSQ,Number=.,Type=String,Description="Consequence annotations from a caller. Format: Allele|Consequence|IMPACT|ALLELE_NUM">\n'


def test_packed_annotations(spark, tmp_path):
    a = put(tmp_path / "a.vcf", HEAD + CSQ + COLUMNS + "\tFORMAT\tS\nchr1\t11\trs1\tA\tC,G\t50\tPASS\tAC=3,5;CSQ=C|missense_variant|MODERATE|1,G||LOW|2;DP=7\tGT\t0/1\nchr1\t20\t.\tA\tC\t.\t.\tAC=1\tGT\t0/1\nchr1\t30\t.\tAT\tC\t.\t.\tCSQ=C|x\tGT\t0/1\n")
    b = put(tmp_path / "b.vcf", HEAD + CSQ.replace("Allele|Consequence|IMPACT|ALLELE_NUM", "SYMBOL|Allele") + COLUMNS + "\nchr2\t5\t.\tA\tC\t.\t.\tXCSQ=n;CSQ=G1|C\n")
    rows = sources.read_packed_annotations(spark, [a, b])
    assert rows.columns == ["#CHROM", "POS0", "END", "POS", "REF", "ALT", "ID", "QUAL", "INFO", "CSQAllele", "CSQConsequence", "CSQIMPACT", "CSQALLELE_NUM", "CSQSYMBOL"]
    assert sorted(map(str, map(tuple, rows.collect()))) == sorted(
        map(str, [
            ("chr1", 10, 11, 11, "A", "C,G", "rs1", "50", "AC=3,5;DP=7", "C", "missense_variant", "MODERATE", "1", None), ("chr1", 10, 11, 11, "A", "C,G", "rs1", "50", "AC=3,5;DP=7", "G", "", "LOW", "2", None),
            ("chr1", 29, 31, 30, "AT", "C", ".", ".", ".", "C", "x", None, None, None), ("chr2", 4, 5, 5, "A", "C", ".", ".", "XCSQ=n", "C", None, None, None, "G1"),
        ])
    )
    whole = sources.read_packed_annotations(spark, a, cut=False).first()
    assert whole.INFO.endswith(";DP=7") and op.strip_info_tail(sources.read_packed_annotations(spark, a, cut=False)).first().INFO == "AC=3,5"
    assert sources.packed_fields(spark, a) == {("Allele", "Consequence", "IMPACT", "ALLELE_NUM"): sources.lines.files_of(spark, a)}
    with pytest.raises(ValueError, match="no fields of ANN"):
        sources.read_packed_annotations(spark, a, key="ANN")
    with pytest.raises(ValueError, match="declared twice"):
        sources.read_packed_annotations(spark, put(tmp_path / "t.vcf", HEAD + CSQ.replace("IMPACT", "Allele") + COLUMNS + "\n"))


def test_run_from_two_call_files(spark, tmp_path):
    """The whole chain from calls and annotated calls, both in several block-gzip files."""
    calls, annotated = str(tmp_path / "calls"), str(tmp_path / "annotated")
    for names, sites in ((["S1", "S2", "S3"], [("chr1", 11, "1/2", "0/0", "0/1"), ("chr1", 50, "0/0", "0/0", "0/0")]), (["S3", "S1", "S2"], [("chr2", 7, "0/0", "0/1", "0/0")])):
        rows = spark.createDataFrame([("\t".join([s[0], str(s[1]), ".", "A", "C,G", ".", ".", ".", "GT", *s[2:]]),) for s in sites], "value string")
        sources.write_block_gzip(rows, calls, [HEAD.strip(), COLUMNS + "\tFORMAT\t" + "\t".join(names)], ".vcf.gz")
    rows = spark.createDataFrame([("chr1\t11\t.\tA\tC,G\t.\t.\tAC=3,5;CSQ=C|missense_variant|MODERATE|1,G|x|LOW|2",), ("chr2\t7\t.\tA\tC,G\t.\t.\tAC=1,0;CSQ=C|stop_gained|HIGH|1",)], "value string")
    sources.write_block_gzip(rows.repartition(2), annotated, [HEAD.strip(), CSQ.strip(), COLUMNS], ".vcf.gz")
    pedigree = spark.createDataFrame([("F1", "S1"), ("F1", "S2"), ("F2", "S3")], "family string, sample string")
    out = stages.run_all(spark, sources.read_vcf(spark, calls), sources.read_packed_annotations(spark, annotated), pedigree, stages.Resources(), str(tmp_path / "out"))
    got = sorted((r["#CHROM"], r.SAMPLE, r.ALT_specific, r.carrier, r.AC, r.Consequence) for r in out.collect())
    assert got == [("chr1", "S1", "C", 1, "3", "missense_variant"), ("chr1", "S2", "C", 0, "3", "missense_variant"), ("chr1", "S3", "C", 1, "3", "missense_variant"), ("chr2", "S1", "C", 1, "1", "stop_gained"), ("chr2", "S2", "C", 0, "1", "stop_gained")]


@pytest.mark.parametrize("ending", ["\n", ""])
def test_block_gzip_splits(spark, tmp_path, ending):
    """Any split size gives the lines of the plain text: long lines over many blocks, lines that end where a block does, empty ones."""
    rng = random.Random(3)
    rows = [("x" * rng.choice([0, 1, 7, 98, 99, 100, 450])) + f"é{i}" for i in range(200)] + ["", "y" * 99, "z" * 99]
    text = ("\n".join(rows) + ending).encode()
    data = blocks(text)
    path = tmp_path / "t.gz"
    path.write_bytes(data)
    assert lines.kind_of(str(path)) == "blocks" and gzip.decompress(data) == text
    with open(path, "rb") as f:
        for step in (1, 50, 333, 1000, len(data), 10 * len(data)):
            got = [x for at in range(0, len(data), step) for piece in lines.split_text(f, at, at + step, len(data)) for x in lines._texts(piece)]
            assert got == rows
    read = lines.read_lines(spark, [f"file://{path}"], 1000)
    assert [r.value for r in read.collect()] == rows and read.rdd.getNumPartitions() > 5


def test_block_gzip_that_looks_like_more(tmp_path):
    """Bytes inside a block that look like the start of one are not taken for one; damage is an error."""
    text = b"\n".join([lines.END, lines.packed(b"not\na block\n")[:30], b"a\x1f\x8b\x08\x04" * 40, b"last"]) + b"\n"
    stored = b"".join(lines.packed(random.Random(i).randbytes(300).replace(b"\n", b"") + text) for i in range(20))
    path = tmp_path / "t.gz"
    path.write_bytes(stored)
    whole = gzip.decompress(stored)
    with open(path, "rb") as f:
        for step in (37, 500, 5000):
            assert b"".join(p for at in range(0, len(stored), step) for p in lines.split_text(f, at, at + step, len(stored))) == whole
    bad = bytearray(blocks(b"some text\n" * 50))
    bad[60] ^= 255
    path.write_bytes(bad)
    with open(path, "rb") as f, pytest.raises(Exception):
        list(lines.split_text(f, 0, 1 << 20, len(bad)))


def test_write_block_gzip(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.range(5000).select(F.concat_ws("\t", "id", F.sha2(F.col("id").cast("string"), 512)))
    sources.write_block_gzip(rows.repartition(3), path, ["#top"])
    files = lines.files_of(spark, path)
    assert len(files) == 3 and all(lines.kind_of(f) == "blocks" for f in files)
    got = [r.value for r in lines.read_lines(spark, files, 50_000).collect()]
    assert got.count("#top") == 3 and sorted(x for x in got if x != "#top") == sorted(r[0] for r in rows.collect())
    assert [r.value for r in lines.read_heads(spark, files).collect()] == ["#top"] * 3
    assert sources.read_tsv(spark, path).count() == 5000  # Spark reads them too


def test_small_splits_of_much_text_are_put_together(tmp_path):
    """Each byte is in one split; there are no more tasks than asked for, but for one a file."""
    paths = [str(tmp_path / x) for x in "ab"]
    for path, size in zip(paths, (3_000_001, 10)):
        with open(path, "wb") as f:
            f.write(bytes(size))
    splits = lines.BlockReader({"paths": json.dumps(paths), "split_bytes": "1024"}).partitions()
    of = [s for s in splits if s.path == paths[0]]
    assert len(splits) <= lines.MOST_SPLITS + 2 and [s.end for s in of[:-1]] == [s.start for s in of[1:]]
    assert of[0].start == 0 and of[-1].end >= 3_000_001 and len(splits) - len(of) == 1
    assert len(lines.BlockReader({"paths": json.dumps(paths), "split_bytes": "100000"}).partitions()) == 32
