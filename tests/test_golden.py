"""Golden cases of the operators' semantics, and properties."""

import pytest
from pyspark.sql import functions as F

from pedigrove import functions as fn
from pedigrove import operators as op

SITE = ("site",)


def calls(spark):
    ped = {"S1": "F1", "S2": "F1", "S3": "F1", "S4": "F2", "S5": "F3"}
    table = {
        "a": ("C", ["0/1", "0/0", "./.", "0/0", "0/0"]), "b": ("C", ["./1", "0/0", "0/0", "0/0", "0/0"]), "c": ("C,G", ["1/2", "0/0", "0/1", "2|2", "0/0"]),
        "d": ("C", ["0/0", "0/0", "0/0", "0/0", "./."]), "e": ("C", ["0/1", "./1", "0/0", "0/0", "0/0"]),
    }
    depth = {("c", "S1"): "1,9,8", ("c", "S2"): "20,0,0", ("c", "S3"): "."}
    rows = [(site, alt, s, gt, depth.get((site, s), "5,5,5"), ped[s]) for site, (alt, gts) in table.items() for s, gt in zip(ped, gts)]
    return spark.createDataFrame(rows, "site string, ALT string, SAMPLE string, GT string, AD string, FAMILY string")


def test_family_expand(spark):
    got = {(r.site, r.SAMPLE) for r in op.family_expand(calls(spark), site=SITE).collect()}
    assert got == {(s, x) for s, xs in {"a": "123", "c": "1234", "e": "123"}.items() for x in (f"S{i}" for i in xs)}


def test_resolve(spark):
    rows = op.resolve_alleles(calls(spark).where("site in ('c', 'e', 'd')"), SITE).collect()
    got = {(r.site, r.SAMPLE, r.allele_num): (r.ALT_specific, r.carrier, r.AD_ref, r.AD_alt, r.alleles_in_gt, r.sample_is_multiallelic_het) for r in rows}
    assert got["c", "S1", 1] == ("C", 1, "1", "9", "1,2", True) and got["c", "S1", 2] == ("G", 1, "1", "8", "1,2", True)
    assert got["c", "S2", 1] == ("C", 0, "20", "0", "", False) and got["c", "S3", 2] == ("G", 0, None, None, "1", False)
    assert got["e", "S2", 1][1] is None and got["e", "S2", 1][4] == "1"
    assert all(r.family_has_multiallelic_het == (r.site == "c" and r.FAMILY == "F1") for r in rows)
    assert not any(r.site == "d" for r in rows)


def test_resolve_optional_and_required_columns(spark):
    bare = op.resolve_alleles(calls(spark).drop("ALT", "AD"), SITE)
    assert bare.where("ALT_specific is not null or AD_ref is not null or AD_alt is not null").isEmpty()
    with pytest.raises(ValueError):
        op.resolve_alleles(calls(spark).drop("GT"), SITE)
    with pytest.raises(ValueError):
        op.resolve_alleles(calls(spark), ("other",))


@pytest.mark.parametrize(
    "info, number, alt, ac, aq",
    [
        ("AC=3,5;AQ=40,50;CSQ=x", "1", "C", "3", "40"), ("AC=3,5;AQ=40,50;CSQ=x", "2", "G", "5", "50"), ("AC=3,5;AQ=40,50;CSQ=x", ".", "C", "3", "40"),
        ("AC=3,5;AQ=40,50;CSQ=x", "3", None, "NA", "NA"), ("AC=3,5;AQ=40,50;CSQ=x", "0", "G", "5", "50"), ("MLEAC=7;DP=9", "1", "C", "7", "NA"),
        ("CSQ=x;AC=3,5", "1", "C", "3", "NA"),
    ],
)
def test_per_allele_fields(spark, info, number, alt, ac, aq):
    df = spark.createDataFrame([("C,G", info, number)], "ALT string, INFO string, ALLELE_NUM string")
    r = op.per_allele_fields(op.strip_info_tail(df)).first()
    assert (r.ALT_specific, r.AC, r.AQ) == (alt, ac, aq)
    assert r.INFO == (info if info.startswith("CSQ") else info.replace(";CSQ=x", ""))
    assert op.per_allele_fields(df).columns == ["ALT", "ALT_specific", "INFO", "AC", "AF", "AQ", "MLEAC", "MLEAF", "ALLELE_NUM"]
    if info.startswith("MLEAC"):
        assert op.per_allele_fields(df, anchored=True).first().AC == "NA"


def intervals(spark, rows, names="chrom string, start long, end long"):
    return spark.createDataFrame(rows, names)


def test_touching_does_not_overlap(spark):
    v = intervals(spark, [("1", 10, 11)])
    near = intervals(spark, [("1", 0, 10)])
    over = intervals(spark, [("1", 0, 11), ("1", 5, 20), ("2", 0, 99)])
    k = ("chrom", "start", "end")
    assert op.overlap_count(v, near, "n", k).first().n == 0 and op.overlap_count(v, over, "n", k).first().n == 2
    assert op.overlap_mean(v, near.withColumn("z", F.lit(1.0)), {"z": "m"}, k).first().m is None
    z = intervals(spark, [("1", 14, 15, None), ("1", 12, 13, 4.0)], "chrom string, start long, end long, z double")
    assert op.overlap_mean(intervals(spark, [("1", 10, 15)]), z, {"z": "m"}, k).first().m == 4.0


def test_merge_intervals(spark):
    k = ("chrom", "start", "end")

    def merged(rows, **more):
        return sorted((r.start, r.end) for r in op.merge_intervals(intervals(spark, [("1", *r) for r in rows]), k, **more).collect())

    assert merged([(0, 10), (5, 12), (12, 13)]) == [(0, 13)]
    assert merged([(0, 10), (11, 12)]) == [(0, 12)] and merged([(0, 10), (12, 13)]) == [(0, 10), (12, 13)]
    rows = [(i * 7 % 1000, i * 7 % 1000 + i % 13 + 1) for i in range(300)]
    once = merged(rows)
    assert once == merged(once) and all(a[1] + 1 < b[0] for a, b in zip(once, once[1:]))


def test_overlap_join_equals_plain_join(spark):
    import random

    rng = random.Random(1)
    make = lambda n, longest: [(rng.choice("ab"), s := rng.randrange(3000), s + rng.randrange(0, longest)) for _ in range(n)]
    a, b = make(200, 30), make(150, 30) + [("a", 0, 3000), ("b", 10, 2500)]
    want = sorted((x, y) for x in a for y in b if x[0] == y[0] and x[1] < y[2] and y[1] < x[2] and x[2] > x[1] and y[2] > y[1])
    left, right = intervals(spark, a), intervals(spark, b, "c string, s long, e long")
    own, other = ("chrom", "start", "end"), ("c", "s", "e")
    told = op.interval_lengths(left, right, own, other)
    assert told.longest == 3000 and 20 < told.usual < 30 and op.interval_lengths(left.limit(0), right.limit(0), own, other) == type(told)(1, 1)
    for width, lengths in ((None, None), (3, None), (1000, None), (None, told), (None, type(told)(2, 9))):  # whatever the lengths say
        got = op.overlap_join(left, right, own, other, width, lengths=lengths)
        assert sorted(((r[0], r[1], r[2]), (r[3], r[4], r[5])) for r in got.collect()) == want


@pytest.mark.parametrize("rows_a_bin", [1, 7, 2048])
def test_nearest_equals_brute_force(spark, monkeypatch, rows_a_bin):
    """Short and long genes, touching and repeated ones, equal spans; nulls and empty intervals have no neighbour and are none."""
    import random

    from pedigrove.operators import intervals as iv

    monkeypatch.setattr(iv, "BIN_ROWS", rows_a_bin)
    monkeypatch.setattr(iv, "EDGE_ROWS", 1)
    rng = random.Random(2)
    genes = [("1", s := rng.randrange(2000), s + rng.randrange(1, 40), f"g{i % 9}") for i in range(40)]
    genes += [("1", s := rng.randrange(1500), s + rng.randrange(100, 500), f"h{i}") for i in range(3)] + genes[:3]
    genes += [("1", 700, 700, "empty"), ("1", None, 700, "null"), (None, 1, 2000, "nowhere"), ("3", 5, 9, None)]
    spans = [("1", s := rng.randrange(2100), s + rng.randrange(1, 9)) for _ in range(80)] + [("2", 1, 2), ("3", 9, 11), ("3", 1, 5), ("3", 1, 5)]
    spans += [("1", 5, 5), ("1", None, 5), (None, 5, 9)] + [("1", genes[0][2], genes[0][2] + 3), ("1", genes[1][1] - 2, genes[1][1])]
    got = op.nearest_interval(intervals(spark, spans), intervals(spark, genes, "chrom string, start long, end long, symbol string"), keys=("chrom", "start", "end")).collect()
    assert sorted(map(str, ((r.chrom, r.start, r.end) for r in got))) == sorted(map(str, spans))
    good = [g for g in genes if None not in g[:3] and g[1] < g[2]]
    for r in got:
        asked = [g for g in good if g[0] == r.chrom and r.start is not None and r.start < r.end]
        best = min(((max(g[1] - r.end, r.start - g[2], 0), g[1], g[3]) for g in asked), default=None)
        assert (r.nearest_distance, r.nearest_symbol) == ((best[0], best[2]) if best else (None, None))


@pytest.mark.parametrize("rows_a_bin", [1, 3, 2048])
def test_counts_and_means_by_scan(spark, monkeypatch, rows_a_bin):
    """Whole numbers by running sums in bins of few rows against all pairs; touching ends, equal spans, nulls, long regions."""
    import random

    from pedigrove.operators import intervals as iv

    monkeypatch.setattr(iv, "BIN_ROWS", rows_a_bin)
    monkeypatch.setattr(iv, "EDGE_ROWS", 1)
    rng = random.Random(4)
    spans = [(rng.choice("ab"), s := rng.randrange(300), s + rng.randrange(0, 12)) for _ in range(120)] + [("c", 1, 2), ("a", 0, 400)]
    regions = [(rng.choice("ab"), s := rng.randrange(300), s + rng.randrange(0, 20), rng.choice([None, 3, -7, 10])) for _ in range(150)] + [("a", 0, 300, 5), ("b", 10, 250, None), (None, 1, 5, 1)]
    left, right = intervals(spark, spans), intervals(spark, regions, "chrom string, start long, end long, z long")
    k = ("chrom", "start", "end")
    over = lambda r: [g for g in regions if g[0] == r[0] and r[1] < g[2] and g[1] < r[2] and r[2] > r[1] and g[2] > g[1]]
    got = op.overlap_mean(op.overlap_count(left, right, "n", k), right, {"z": "m"}, k).collect()
    assert len(got) == len(spans)
    for r in got:
        z = [g[3] for g in over(r) if g[3] is not None]
        assert r.n == len(over(r)) and r.m == (sum(z) / len(z) if z else None)
    places = op.in_order(left, "chrom", "start", ("end",)).collect()
    for c in "abc":
        mine = sorted((r.place, r.start, r.end) for r in places if r.chrom == c)
        assert [p for p, *_ in mine] == list(range(1, len(mine) + 1)) and [x[1:] for x in mine] == sorted(x[1:] for x in mine)


@pytest.mark.parametrize("rows_a_bin", [1, 5])
def test_merge_in_small_bins(spark, monkeypatch, rows_a_bin):
    import random

    from pedigrove.operators import intervals as iv

    rng = random.Random(6)
    rows = [(rng.choice("ab"), s := rng.randrange(3000), s + rng.randrange(-1, 30)) for _ in range(300)] + [("a", 100, 900), ("a", None, 3), (None, 3, 4)]
    k = ("chrom", "start", "end")
    want = op.merge_intervals(intervals(spark, rows), k).collect()
    monkeypatch.setattr(iv, "BIN_ROWS", rows_a_bin)
    monkeypatch.setattr(iv, "EDGE_ROWS", 1)
    assert sorted(op.merge_intervals(intervals(spark, rows), k).collect()) == sorted(want)
    places = op.in_order(intervals(spark, rows), "chrom", "start", ("end",)).collect()
    for c in ("a", "b", None):
        mine = sorted(r.place for r in places if r.chrom == c)
        assert mine == list(range(1, len(mine) + 1))
        assert [(r.start or -1, r.end) for r in sorted(places, key=lambda r: r.place) if r.chrom == c] == sorted((r[1] or -1, r[2]) for r in rows if r[0] == c)


def test_bins_follow_rows_not_positions(spark):
    """One far outlier, and many rows on three positions: no bin has more than three times the rows aimed at, where ties may be split."""
    from pedigrove.operators import intervals as iv

    even = spark.range(200_000).selectExpr("'1' as c", "id % 20000 as p", "id as tie").unionByName(spark.createDataFrame([("1", 3_000_000_000, 0)], "c string, p long, tie long"))
    piled = spark.range(100_000).selectExpr("'2' as c", "id % 3 as p", "id as tie")
    for rows in (even, piled, even.unionByName(piled)):
        sizes = [r["count"] for r in iv._binned(rows, "c", ("p", "tie")).groupBy("c", "bin").count().collect()]
        assert max(sizes) <= 3 * iv.BIN_ROWS and len(sizes) <= 2 * (rows.count() / iv.BIN_ROWS + 2)
    bins = iv._binned(piled, "c", ("p", "tie")).groupBy("bin").agg(F.min(F.struct("p", "tie")).alias("a"), F.max(F.struct("p", "tie")).alias("b")).orderBy("bin").collect()
    assert all(x.b < y.a for x, y in zip(bins, bins[1:]))
    # Positions at both ends of a long, and none, keep their order.
    far = [(p, i) for i, p in enumerate([None, -(1 << 62), -(1 << 61), -5, 0, 3, 1 << 61, 1 << 62])]
    placed = op.in_order(spark.createDataFrame([("1", p, i) for p, i in far[::-1]], "c string, p long, tie long"), "c", "p", ("tie",))
    assert [r.tie for r in sorted(placed.collect(), key=lambda r: r.place)] == [i for _, i in far]
    # Given bins are used as they are.
    k = ("c", "p", "tie")
    some = even.withColumn("tie", F.col("p") + 1 + F.col("tie") % 3)
    bins = op.cut_bins(some.select(*k).distinct(), "c", ("p", "tie"))
    assert sorted(op.merge_intervals(some, k, bins=bins).collect()) == sorted(op.merge_intervals(some, k).collect())


def test_means_of_doubles_are_exact(spark):
    """Values of any size, infinities, NaN and nulls against fractions; no pair of intervals is joined."""
    import math
    import random
    import re
    from fractions import Fraction

    rng = random.Random(7)
    odd = [None, float("nan"), 0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, 0.1, -0.3, 1e-300]
    regions = [("a", s := rng.randrange(400), s + rng.randrange(1, 30), rng.choice(odd) if rng.random() < 0.3 else rng.uniform(-3, 3) * 10 ** rng.randrange(-20, 20)) for _ in range(300)]
    regions += [("a", 450, 460, float("inf")), ("a", 455, 470, float("-inf")), ("a", 440, 452, 2.5), ("b", 0, 10, 0.1), ("b", 0, 10, 0.2), ("b", 5, 10, 0.3)]
    spans = [("a", s := rng.randrange(480), s + rng.randrange(1, 9)) for _ in range(150)] + [("b", 1, 2), ("b", 6, 7), ("b", 20, 21), ("a", 450, 452), ("a", 456, 458), ("a", 465, 466)]
    df = op.overlap_mean(intervals(spark, spans), intervals(spark, regions, "chrom string, start long, end long, z double"), {"z": "m"}, ("chrom", "start", "end"))
    for r in df.collect():
        z = [g[3] for g in regions if g[0] == r.chrom and r.start < g[2] and g[1] < r.end and g[3] is not None and not math.isnan(g[3])]
        if any(map(math.isinf, z)):
            assert str(r.m) == str(sum(x for x in z if math.isinf(x)))
        elif z:
            total = sum(map(Fraction, z), Fraction(0))
            want = float(total) / len(z) if abs(total) < 2**1023 else None
            assert want is None or abs(Fraction(r.m) - Fraction(want)) <= abs(Fraction(want)) * Fraction(1, 10**15) + Fraction(1, 2**1074)
        else:
            assert r.m is None
    tidy = df.where("chrom = 'b'").collect()
    assert {(r.start, r.m) for r in tidy} == {(1, (0.1 + 0.2) / 2), (6, float(Fraction(0.1) + Fraction(0.2) + Fraction(0.3)) / 3), (20, None)}
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Join" in line and re.search(r"\b(start|end|s|e)#\d+L? [<>]", line)]


def test_labels_meet_a_span_once_an_island(spark):
    features = spark.range(2000).selectExpr("'1' as chrom", "id % 50 as start", "id % 50 + 60 as end", "concat('L', id % 3) as label")
    features = features.unionByName(spark.createDataFrame([("1", 500, 510, None), ("1", 505, 506, "x"), (None, 1, 2, "y")], "chrom string, start long, end long, label string"))
    k = ("chrom", "start", "end")
    spans = intervals(spark, [("1", i, i + 5) for i in range(100)] + [("1", 504, 506), ("2", 1, 2), ("1", 502, 503)])
    got = {(r.chrom, r.start): r.labels for r in op.overlap_labels(spans, features, "label", "labels", k).collect()}
    assert all(got["1", i] == ["L0", "L1", "L2"] for i in range(100)) and got["1", 504] == ["x"] and got["2", 1] == got["1", 502] == []


def test_labels_of_all_lengths_equal_brute_force(spark, monkeypatch):
    """Labels with one feature and with many, islands and rows of all lengths, rows repeated; no pair is a row of the plan."""
    import random
    import re

    from pedigrove.operators import intervals as iv

    rng = random.Random(5)
    features = [(rng.choice("ab"), s := rng.randrange(100_000), s + rng.choice([1, 5, 40, 40, 3000, 30_000]), rng.choice([f"U{i}", f"U{i}", f"M{i % 7}"])) for i in range(300)] + [("a", 5, 5, "z"), ("a", None, 9, "z"), (None, 1, 99, "z"), ("b", 1, 99_999, None)]
    rows = [(rng.choice("abc"), s := rng.randrange(-50, 110_000), s + rng.choice([1, 1, 1, 2, 30, 900, 50_000])) for _ in range(500)] + [("b", 7, 7), ("a", 9, 2), (None, 1, 2), ("a", None, 2)]
    rows += rows[:5]
    df = intervals(spark, rows).withColumn("more", F.lit(1))
    table = spark.createDataFrame(features, "rc string, rs long, re long, name string")
    good = [g for g in features if None not in g and g[2] > g[1]]
    valid = lambda r: None not in r and r[2] > r[1]
    want = sorted((str(r), sorted({g[3] for g in good if valid(r) and g[0] == r[0] and r[1] < g[2] and g[1] < r[2]})) for r in rows)
    k = ("chrom", "start", "end")
    for most in (iv.BROADCAST_ROWS, 0):
        monkeypatch.setattr(iv, "BROADCAST_ROWS", most)
        got = op.overlap_labels(df, table, "name", "labels", k, ("rc", "rs", "re"))
        assert got.columns == [*df.columns, "labels"] and sorted((str((r.chrom, r.start, r.end)), r.labels) for r in got.collect()) == want
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert not [line for line in plan.splitlines() if "Join" in line and re.search(r"\b(start|end|_s|_e)#\d+L? [<>]", line)]
    assert [r.labels for r in op.overlap_labels(df, table.limit(0), "name", "labels", k, ("rc", "rs", "re")).limit(2).collect()] == [[], []]


def test_region_semi_join_equals_brute_force(spark):
    import random

    rng = random.Random(8)
    regions = [(rng.choice("ab"), s := rng.randrange(100_000), s + rng.choice([1, 5, 40, 3000])) for _ in range(60)] + [("a", 5, 5), ("a", None, 9), (None, 1, 99)]
    records = [(rng.choice("abc"), s := rng.randrange(-50, 110_000), s + rng.choice([1, 1, 1, 2, 30, 900, 70_000])) for _ in range(3000)] + [("a", 0, 10**9), ("b", 7, 7), ("a", 9, 2), (None, 1, 2), ("a", None, 2)]
    records += records[:5]
    k = ("chrom", "start", "end")
    df = intervals(spark, records).withColumn("more", F.lit(1))
    got = op.region_semi_join(df, intervals(spark, regions, "rc string, rs long, re long"), k, ("rc", "rs", "re"))
    good = [g for g in regions if None not in g and g[2] > g[1]]
    want = [r for r in records if None not in r and r[2] > r[1] and any(g[0] == r[0] and r[1] < g[2] and g[1] < r[2] for g in good)]
    assert sorted((r.chrom, r.start, r.end) for r in got.collect()) == sorted(want) and got.columns == df.columns
    assert op.region_semi_join(df, intervals(spark, []), k).isEmpty()


def test_many_regions_are_not_broadcast(spark):
    """A small file of regions whose bins are many: their rows are counted."""
    records = spark.range(2000).select(F.lit("a").alias("chrom"), (F.col("id") * 7).alias("start"), (F.col("id") * 7 + F.when(F.col("id") == 9, 400).otherwise(1)).alias("end"))
    regions = spark.range(250_000).select(F.lit("a").alias("chrom"), (F.col("id") * 3).alias("start"), (F.col("id") * 3 + 1).alias("end"))
    got = op.region_semi_join(records, regions, ("chrom", "start", "end"))
    assert sorted(r.start for r in got.collect()) == sorted(i * 7 for i in range(2000) if i == 9 or i * 7 % 3 == 0)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan


def test_region_semi_join_modes(spark):
    k = ("chrom", "start", "end")
    v, rg = intervals(spark, [("1", 5, 30), ("1", 50, 51)]), intervals(spark, [("1", 0, 10), ("1", 20, 40)])
    assert op.region_semi_join(v, rg, k).count() == 1 and op.region_semi_join(v, rg, k, how="inner").count() == 2


def test_nan_constraint_counts_as_null(spark):
    c = spark.createDataFrame([("g", "t", True, float("nan"), 1.0), ("g", "u", False, 0.5, 2.0)], "gene string, transcript string, canonical boolean, `lof.pLI` double, `lof.oe_ci.upper` double")
    r = op.constraint_by_gene(spark.createDataFrame([("g",), ("h",)], "SYMBOL string"), c).orderBy("SYMBOL").collect()
    assert (r[0].gnomad_lof_pLI_max, r[0].gnomad_lof_pLI_canonical, r[0].gnomad_lof_oe_ci_upper_min) == (0.5, None, 1.0) and r[1].gnomad_lof_pLI_max is None


def test_repeated_transcripts_are_spread(spark, monkeypatch):
    """One transcript on both sides: its rows out are the work of several tasks, none is lost; a row without a match stays."""
    from pedigrove.operators import annotate

    monkeypatch.setattr(annotate, "OUT_ROWS", 5000)
    df = spark.range(300).select("id", F.when(F.col("id") == 0, None).otherwise("T").alias("Feature")).coalesce(1)
    c = spark.range(100).select(F.when(F.col("id") >= 0, "T").alias("transcript"), F.col("id").cast("double").alias("lof.pLI"), F.lit(1.0).alias("lof.oe_ci.upper")).coalesce(1)
    got = op.constraint_by_transcript(df, c)
    assert sorted((r.id, r.gnomad_lof_pLI_tx or 0.0) for r in got.collect()) == sorted([(0, 0.0)] + [(i, float(j)) for i in range(1, 300) for j in range(100)])
    assert got.groupBy(F.spark_partition_id()).count().agg(F.count("*"), F.max("count")).first()[0] > 2 and got.columns == ["id", "Feature", "gnomad_lof_pLI_tx", "gnomad_lof_oe_ci_upper_tx"]


def test_zeros_in_low_limbs_are_not_summed(spark):
    from pedigrove.operators.intervals import limb_places

    z = spark.createDataFrame([(0.125, 70_000.0), (3.5, None), (0.0, float("inf"))], "a double, b double")
    assert len(limb_places(z, ("a", "b")).places) == 1 and len(limb_places(z.selectExpr("a + 0.1d as a"), ("a",)).places) > 1


def test_merge_keeps_only_matching_alleles(spark):
    keys = "`#CHROM` string, POS0 long, END long, REF string, ALT_specific string"
    left = spark.createDataFrame([("1", 0, 1, "A", "C", "x"), ("1", 0, 1, "A", "G", "y")], f"{keys}, ALT string")
    right = spark.createDataFrame([("1", 0, 1, "A", "C", "z", "HIGH"), ("1", 0, 1, "A", "G", "z", "LOW")], f"{keys}, ALT string, IMPACT string")
    got = op.merge_annotations(left, op.impact_filter(right)).collect()
    assert [(r.ALT_specific, r.ALT, r.ALT_var) for r in got] == [("C", "x", "z")]
    with pytest.raises(ValueError):
        op.merge_annotations(left.drop("REF"), right)
    with pytest.raises(ValueError):
        op.impact_filter(left)


def test_clean_names_and_clash(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`(null)` int, CSQIMPACT int, CSQ int")
    assert op.clean_annotation_columns(df).columns == ["INFO", "IMPACT", "CSQ"]
    with pytest.raises(ValueError):
        op.clean_annotation_columns(df.withColumn("IMPACT", F.lit(1)))


def test_samples_and_reconcile(spark):
    called, ped = spark.createDataFrame([("a",), ("b",)], "sample string"), spark.createDataFrame([("F", "b"), ("F", "c")], "family string, sample string")
    assert [r.sample for r in op.missing_samples(called, ped).collect()] == ["a"] and [r.sample for r in op.extra_samples(called, ped).collect()] == ["c"]
    with pytest.raises(ValueError, match="1 samples not in the pedigree: a$"):
        op.require_known_samples(called, ped)
    with pytest.warns(UserWarning, match="1 samples of the pedigree were not called: c$"):
        op.warn_of_extra_samples(called, ped)
    with pytest.raises(ValueError, match=r"30 samples .*: s10, .* s34 \.\.\. \(\+5 more\)"):
        op.require_known_samples(spark.createDataFrame([(f"s{i}",) for i in range(10, 40)], "sample string"), ped)
    regions = intervals(spark, [("1", i, i + 1) for i in range(5)])
    chunks = op.chunk_numbers(regions, 2)
    assert op.stage_reconcile(regions, {"x": chunks, "y": chunks}, 2, strict=True).first().agrees
    with pytest.raises(ValueError, match="1 chromosomes disagree: 1: x 3, y 2 of 3 chunks"):
        op.stage_reconcile(regions, {"x": chunks, "y": chunks.where("chunk < 2")}, 2, strict=True)
    other = intervals(spark, [("9", 1, 2)]).withColumn("chunk", F.lit(0))
    assert [tuple(r) for r in op.stage_reconcile(regions, {"x": other}, 2).orderBy("chrom").collect()] == [("1", 3, 0, False), ("9", 0, 1, False)]


def test_text_of_calls(spark):
    df = spark.createDataFrame([([0, 1], True, [3, None], []), ([-1, 2], False, None, [7]), ([1], False, [], None), ([], None, [5], [None])], "a array<int>, p boolean, d array<int>, q array<int>")
    got = [tuple(r) for r in df.select(fn.gt_text("a", "p"), fn.format_text("d"), fn.first_text("q")).collect()]
    assert got == [("0|1", "3,.", "."), ("./2", ".", "7"), ("1", ".", "."), (".", "5", ".")]


def test_empty_tables(spark):
    v = intervals(spark, [])
    k = ("chrom", "start", "end")
    assert op.overlap_count(v, v, "n", k).isEmpty() and op.merge_intervals(v, k).isEmpty() and op.resolve_alleles(calls(spark).limit(0), SITE).isEmpty()
