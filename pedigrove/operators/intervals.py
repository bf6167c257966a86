"""Interval operators on half-open intervals [start, end): overlap joins, counts, means, union, nearest.

Overlap is a.start < b.end and b.start < a.end on equal chromosome names; touching ends
do not overlap. Intervals with a null or with end <= start overlap nothing.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import new_path

KEYS = ("#CHROM", "POS0", "END")
#: Bins of an interval at its level, about, before the next level takes it.
FACTOR = 16
#: Rows aimed at in a bin of a scan, parts of a bin with many rows at most, and sampled rows that stand for a bin.
BIN_ROWS, MOST_BINS, EDGE_ROWS = 2048, 1024, 24
#: Rows up to which a derived table may be broadcast.
BROADCAST_ROWS = 1 << 19
#: Bits of a limb of an exact sum: 2**33 of them can be added in a long.
LIMB = 30


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


@dataclass
class Lengths:
    """What the bins of a pair join follow from: a usual length of intervals and the longest one, of both sides."""

    usual: int
    longest: int


def interval_lengths(left: DataFrame, right: DataFrame, keys=KEYS, right_keys=KEYS) -> Lengths:
    """The larger 90th percentile of lengths and the largest length of two tables (one aggregate over both)."""
    of = lambda df, k, side: df.select(F.lit(side).alias("side"), (_q(k[2]) - _q(k[1])).alias("length")).where("length > 0")
    sides = of(left, keys, 0).unionAll(of(right, right_keys, 1)).groupBy("side").agg(F.percentile_approx("length", 0.9).alias("usual"), F.max("length").alias("longest"))
    row = sides.agg(F.max("usual"), F.max("longest")).first()
    return Lengths(int(row[0] or 1), int(row[1] or 1))


def overlap_join(left: DataFrame, right: DataFrame, keys=KEYS, right_keys=KEYS, width: int | None = None, suffix: str = "_right", lengths: Lengths | None = None) -> DataFrame:
    """Pairs of overlapping intervals: left's columns, then right's (renamed by suffix where names clash, in either case).

    Both sides are cut to bins and joined on (chromosome, level, bin), so that neither a
    chromosome nor a long interval is one task's work: an interval's level is that at
    which it spans about FACTOR bins at most, a pair meets at the higher of its two
    levels, in the later of the two first bins. Lower-level intervals are sent up only to
    levels up to that of the longest. lengths: by default :func:`interval_lengths`, which reads
    both sides' coordinates; pass it to start no job here. Pairs are right whatever it says.
    width: of the finest bins, by default the usual length.
    """
    taken = {c.lower() for c in left.columns}
    clash = {c: f"{c}{suffix}" for c in right.columns if c.lower() in taken}
    right = right.withColumnsRenamed(clash)
    right_keys = tuple(clash.get(c, c) for c in right_keys)
    lengths = interval_lengths(left, right, keys, right_keys) if lengths is None else lengths
    widths = [int(width or max(lengths.usual, 1))]
    while widths[-1] * FACTOR < lengths.longest:
        widths.append(widths[-1] * FACTOR)
    top = len(widths) - 1

    def level_of(df, k):
        length = _q(k[2]) - _q(k[1])
        out = F.lit(top)
        for i in reversed(range(top)):
            out = F.when(length <= widths[i + 1], i).otherwise(out)
        return df.where((length > 0) & _q(k[0]).isNotNull()).withColumn("_l", out)

    def bins(df, k, above: bool):
        """At the own level, or at all levels above it."""
        if above:
            df = df.where(F.col("_l") < top).withColumn("_l", F.explode(F.sequence(F.col("_l") + 1, F.lit(top))))
        w = F.element_at(F.array(*[F.lit(x).cast("long") for x in widths]), F.col("_l") + 1) if top else F.lit(widths[0])
        first, last = F.floor(_q(k[1]) / w), F.floor((_q(k[2]) - 1) / w)
        return df.withColumn("_first", first).withColumn("_bin", F.explode(F.sequence(F.col("_first"), last)))

    a, b = level_of(left, keys), level_of(right, right_keys)

    def meet(x, y):
        y = y.withColumnsRenamed({"_first": "_first2", "_bin": "_bin2", "_l": "_l2"})
        on = (_q(keys[0]) == _q(right_keys[0])) & (F.col("_l") == F.col("_l2")) & (F.col("_bin") == F.col("_bin2"))
        on &= (_q(keys[1]) < _q(right_keys[2])) & (_q(right_keys[1]) < _q(keys[2])) & (F.col("_bin") == F.greatest("_first", "_first2"))
        return x.join(y, on).drop("_first", "_bin", "_l", "_first2", "_bin2", "_l2")

    pairs = [meet(bins(a, keys, False), bins(b, right_keys, False))]
    if top:
        pairs += [meet(bins(a, keys, False), bins(b, right_keys, True)), meet(bins(a, keys, True), bins(b, right_keys, False))]
    return reduce(DataFrame.unionByName, pairs)


def _spans(df: DataFrame, keys) -> DataFrame:
    """Distinct coordinates."""
    return df.select(*map(_q, keys)).distinct()


def _kept(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder once: what a scan reads several times."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _attach(df: DataFrame, found: DataFrame, keys) -> DataFrame:
    """found's columns by equal coordinates; df's rows all stay."""
    mine = {c: f"_k{i}" for i, c in enumerate(keys)}
    found = found.withColumnsRenamed(mine)
    # Positions before the chromosome: rows are sorted by a prefix of the first key.
    on = [_q(c) == F.col(mine[c]) for c in (*keys[1:], keys[0])]
    return df.join(found, on, "left").drop(*mine.values())


@dataclass
class Bins:
    """What a chromosome's rows are cut at: a width of positions, and edges within those bins that hold many rows."""

    width: int
    #: _c, _b (chromosome and bin), _edges (array of structs of the ordering columns); None where no bin holds many.
    edges: DataFrame | None = None


def cut_bins(df: DataFrame, chrom: str, by) -> Bins:
    """Bins of about BIN_ROWS rows for rows in order of chromosome and the ``by`` columns, the first of which is the position.

    df is read once: a sample of it, drawn by a hash of chromosome and by, goes to the shared
    folder, and all else is found in that. The width follows from where the middle nine
    tenths of a chromosome's rows lie, so that outliers do not widen it; a bin with more than
    twice the rows is cut again, at every EDGE_ROWS-th of its sampled rows in order of all by
    columns (no more than MOST_BINS times): so rows piled up on few positions are cut apart by the
    columns after it, and only rows equal in all columns stay together. Pass the result to
    the scans as ``bins`` to compute it once for several.
    """
    rate = min(1.0, EDGE_ROWS / BIN_ROWS)
    rows = df.select(_q(chrom).alias("_c"), F.struct(*[_q(c).alias(f"k{i}") for i, c in enumerate(by)]).alias("k"))
    drawn = _kept(rows.where(F.pmod(F.xxhash64("_c", "k"), F.lit(1 << 30)) < rate * (1 << 30)), "drawn")
    per = drawn.groupBy("_c").agg(F.count("*").alias("n"), F.percentile_approx("k.k0", [0.05, 0.95]).alias("p"))
    n, extent = per.agg(F.sum("n"), F.sum((F.get("p", F.lit(1)) - F.get("p", F.lit(0))) / 0.9 + 1)).first()
    width = max(1, int((extent or 1) * EDGE_ROWS / (n or 1)))
    bin_of = Window.partitionBy("_b", "_c")
    drawn = drawn.withColumn("_b", _bin_at(F.col("k.k0"), width)).withColumns({"n": F.count("*").over(bin_of), "i": F.row_number().over(bin_of.orderBy("k"))})
    each = F.greatest(F.lit(EDGE_ROWS), F.ceil(F.col("n") / MOST_BINS))
    drawn = drawn.where((F.col("n") > 2 * EDGE_ROWS) & (F.col("i") % each == 0))
    edges = _kept(drawn.groupBy("_b", "_c").agg(F.array_sort(F.collect_list("k")).alias("_edges")), "edges")
    return Bins(width, None if edges.isEmpty() else edges)


def _bin_at(position: Column, width: int) -> Column:
    """The bin of a position; beyond 2**51 bins either way there is one, and a null's is the first."""
    return F.least(F.greatest(F.floor(position / width), F.lit(-1 << 51)), F.lit(1 << 51))


def _binned(df: DataFrame, chrom: str, by, bins: Bins | None = None) -> DataFrame:
    """Adds bin: a row's place among the bins of its chromosome, in order; a whole number."""
    bins = cut_bins(df, chrom, by) if bins is None else bins
    at = _bin_at(_q(by[0]), bins.width)
    if bins.edges is None:
        return df.withColumn("bin", at)
    # Few rows have edges; where they stand is found by halving. No bin has as many parts as the factor.
    df = df.join(bins.edges, _q(chrom).eqNullSafe(F.col("_c")) & (at == F.col("_b")), "left")
    key = F.struct(*[_q(c).alias(f"k{i}") for i, c in enumerate(by)])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(MOST_BINS.bit_length() + 1))])
    part = F.aggregate(steps, F.lit(0), lambda i, step: F.when(F.get("_edges", i + step - 1) <= key, i + step).otherwise(i))
    return df.withColumn("bin", at * (2 * MOST_BINS) + F.when(F.col("_edges").isNull(), 0).otherwise(part)).drop("_c", "_b", "_edges")


def _overlap_sums(spans: DataFrame, regions: DataFrame, keys, right_keys, values: dict[str, Column]) -> DataFrame:
    """keys, n, and the sum of each value over the overlapping regions, without a pair of them.

    What overlaps [s, e) started before e and did not end up to s. So both are running
    sums along a chromosome: of what starts, read at e, less what ends, read at s. The
    scan is cut in bins with one row a bin carried on. values: whole numbers, exact.
    """
    c, s, e = keys
    rc, rs, re = right_keys
    good = regions.where((_q(re) > _q(rs)) & _q(rc).isNotNull()).withColumns({f"_w{i}": F.coalesce(v, F.lit(0)).cast("long") for i, v in enumerate(values.values())} | {"_w": F.lit(1).cast("long")})
    weights = ["_w", *[f"_w{i}" for i in range(len(values))]]
    # At equal positions: ends (0), then spans (1), then starts (2). Each side is read once; what starts or ends at one place is one event.
    at = lambda kind, pos: F.struct(F.lit(kind).alias("k"), pos.cast("long").alias("pos"))
    both = lambda kinds: F.explode(F.array(*kinds)).alias("x")
    none, zero = F.lit(None).cast("long"), [F.lit(0).cast("long").alias(w) for w in weights]
    events = good.select(_q(rc).alias("c"), both([at(0, _q(re)), at(2, _q(rs))]), *weights).groupBy("c", "x.pos", "x.k").agg(*[F.sum(w).alias(w) for w in weights])
    events = events.select("c", "pos", "k", none.alias("s"), none.alias("e"), *weights)
    asked = spans.where((_q(e) > _q(s)) & _q(c).isNotNull())
    asked = asked.select(_q(c).alias("c"), both([at(1, _q(s)), at(1, _q(e))]), _q(s).cast("long").alias("s"), _q(e).cast("long").alias("e"), *zero)
    asked = asked.select("c", "x.pos", "x.k", "s", "e", *weights)
    # Written once: the bins' sample, the sums of bins and the scan all read it, with only the columns that they need.
    events = _binned(_kept(events.unionByName(asked), "events"), "c", ("pos", "k", "s", "e"))
    # Two scans side by side, so that a row carries each sum once: ends, read where spans start, and starts, read where spans end.
    ending = (F.col("k") == 0) | ((F.col("k") == 1) & (F.col("pos") == F.col("s")))
    events = events.select("c", "pos", "k", "s", "e", "bin", F.when(ending, -1).otherwise(1).alias("t"), *weights)
    before = Window.partitionBy("c", "t").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    carry = events.groupBy("bin", "c", "t").agg(*[F.sum(w).alias(w) for w in weights]).select("c", "bin", "t", *[F.coalesce(F.sum(w).over(before), F.lit(0)).alias(f"{w}_0") for w in weights])
    along = Window.partitionBy("bin", "c", "t").orderBy("pos", "k", "s", "e").rowsBetween(Window.unboundedPreceding, 0)
    ran = events.select("bin", "c", "t", "k", "s", "e", *[F.sum(w).over(along).alias(f"{w}_r") for w in weights]).where("k = 1").join(carry, ["bin", "c", "t"])
    read = [(F.col("t") * (F.col(f"{w}_r") + F.col(f"{w}_0"))).alias(w) for w in weights]
    out = ran.select("s", "e", "c", *read).groupBy("s", "e", "c").agg(*[F.sum(w).alias(w) for w in weights])
    return out.select(F.col("c").alias(c), F.col("s").alias(s), F.col("e").alias(e), F.col("_w").alias("n"), *[F.col(f"_w{i}").alias(name) for i, name in enumerate(values)])


@dataclass
class Limbs:
    """Powers of two of the limbs that hold every finite value of some columns exactly, highest first; whether some are infinite."""

    places: list[int]
    infinite: bool = True


def limb_places(valued: DataFrame, values) -> Limbs:
    """The limbs of the columns' values, the lowest left out where all values have zeros there (two aggregates)."""
    sizes = [F.abs(_q(v).cast("double")) for v in values]
    infinite = F.sum(sum((F.coalesce((x == float("inf")).cast("int"), F.lit(0)) for x in sizes), F.lit(0)))
    sizes = [F.when((x > 0) & (x < float("inf")), x) for x in sizes]
    most, least, found = valued.agg(F.greatest(*[F.max(x) for x in sizes], F.lit(None).cast("double")), F.least(*[F.min(x) for x in sizes], F.lit(None).cast("double")), infinite).first()
    if most is None:
        return Limbs([0], bool(found))
    top, low = math.frexp(most)[1], max(math.frexp(least)[1] - 53, -1074)
    places = list(range(top - LIMB, low, -LIMB)) + [low]
    cut = valued.select(*[_limbs(F.when(F.abs(x) < float("inf"), x), places).alias(f"_l{i}") for i, x in enumerate(_q(v).cast("double") for v in values)])
    used = cut.agg(*[reduce(lambda a, b: a | b, [F.coalesce(F.bool_or(F.get(f"_l{i}", F.lit(j)) != 0), F.lit(False)) for i in range(len(values))]) for j in range(len(places))]).first()
    return Limbs(places[: max([j for j, x in enumerate(used) if x], default=0) + 1], bool(found))


def _scales(places: list[int]) -> Column:
    """Two to the power of each place and of its negative, each as two factors: the smallest powers have no inverse that is a double."""
    powers = lambda p: (F.lit(2.0 ** (p // 2)), F.lit(2.0 ** (p - p // 2)))
    return F.array(*[F.struct(*[x.alias(n) for x, n in zip((*powers(-p), *powers(p)), "abcd")]) for p in places])


def _limbs(value: Column, places: list[int]) -> Column:
    """Whole numbers whose sum, each times two to the power of its place, is the value. All steps are exact in doubles."""

    def cut(state: Column, scale: Column) -> Column:
        scaled = state["rest"] * scale["a"] * scale["b"]
        part = F.when(scaled < 0, F.ceil(scaled)).otherwise(F.floor(scaled)).cast("long")
        return F.struct((state["rest"] - part.cast("double") * scale["c"] * scale["d"]).alias("rest"), F.concat(state["limbs"], F.array(part)).alias("limbs"))

    return F.aggregate(_scales(places), F.struct(value.alias("rest"), F.array().cast("array<bigint>").alias("limbs")), cut, lambda state: state["limbs"])


def _of_limbs(limbs: list[Column], places: list[int]) -> Column:
    """The double of a sum of limbs, right but for the rounding of the last additions: carries go up before, from the lowest limb."""
    gaps = [b - a for a, b in zip(places[1:], places)]

    def carried(state: Column, limb: Column) -> Column:
        total = limb["v"] + state["carry"]
        kept = F.when(limb["size"] > 0, F.pmod(total, limb["size"])).otherwise(total)
        up = F.when(limb["size"] > 0, F.call_function("div", total - kept, limb["size"])).otherwise(F.lit(0).cast("long"))
        return F.struct(up.alias("carry"), F.concat(F.array(kept), state["limbs"]).alias("limbs"))

    rows = [F.struct(v.alias("v"), F.lit(1 << g if g else 0).cast("long").alias("size")) for v, g in zip(limbs, [0, *gaps])]
    start = F.struct(F.lit(0).cast("long").alias("carry"), F.array().cast("array<bigint>").alias("limbs"))
    whole = F.aggregate(F.array(*reversed(rows)), start, carried, lambda state: state["limbs"])
    terms = F.zip_with(whole, _scales(places), lambda v, scale: v.cast("double") * scale["c"] * scale["d"])
    return F.aggregate(terms, F.lit(0.0), lambda total, term: total + term)


def overlap_mean(df: DataFrame, valued: DataFrame, values: dict[str, str], keys=KEYS, right_keys=("chrom", "start", "end"), limbs: Limbs | None = None) -> DataFrame:
    """Adds, for each value column of valued, its mean over the overlapping intervals (null if none; nulls and NaN left out).

    values: column of valued to output column. No overlapping pair is made, whatever the
    columns' type: values are cut to whole limbs of LIMB bits that hold them exactly, and
    the limbs are summed by two scans each, so differences of running sums are exact. A mean
    with infinities is what their sum is. limbs: by default :func:`limb_places`, two
    aggregates over valued.
    """
    limbs = limb_places(valued, values) if limbs is None else limbs
    places = limbs.places
    number = {v: _q(v).cast("double") for v in values}
    finite = {v: F.when(F.abs(x) < float("inf"), x) for v, x in number.items()}
    cut = valued.select(*map(_q, right_keys), *[_limbs(x, places).alias(f"_l{i}") for i, x in enumerate(finite.values())], *[x.alias(f"_v{i}") for i, x in enumerate(number.values())])
    asked = {}
    for i in range(len(values)):
        v = F.col(f"_v{i}")
        asked |= {f"_{j}_{i}": F.get(f"_l{i}", F.lit(j)) for j in range(len(places))}
        asked[f"_n{i}"] = (v.isNotNull() & ~F.isnan(v)).cast("long")
        if limbs.infinite:
            asked |= {f"_up{i}": (v == float("inf")).cast("long"), f"_down{i}": (v == float("-inf")).cast("long")}
    found = _overlap_sums(_spans(df, keys), cut, keys, right_keys, asked)
    means = []
    for i, out in enumerate(values.values()):
        total = _of_limbs([F.col(f"_{j}_{i}") for j in range(len(places))], places)
        if limbs.infinite:
            total = total + F.when(F.col(f"_up{i}") > 0, float("inf")).otherwise(0.0) + F.when(F.col(f"_down{i}") > 0, float("-inf")).otherwise(0.0)
        means.append(F.when(F.col(f"_n{i}") > 0, total / F.col(f"_n{i}")).alias(out))
    return _attach(df, found.select(*map(_q, keys), *means), keys)


def overlap_count(df: DataFrame, regions: DataFrame, out_col: str, keys=KEYS, right_keys=("chrom", "start", "end")) -> DataFrame:
    """Adds the number of overlapping regions, 0 if none. Coordinates are counted once, whatever repeats them; no pair is made."""
    counted = _overlap_sums(_spans(df, keys), regions, keys, right_keys, {}).withColumnRenamed("n", "_n")
    return _attach(df, counted, keys).withColumn(out_col, F.coalesce("_n", F.lit(0).cast("long"))).drop("_n")


def _islands(features: DataFrame, label: str, keys, bins: Bins | None) -> DataFrame:
    """_c, _s, _e, _label: the union of each label's features on a chromosome, written to the shared folder.

    A label with one feature has it as its island; only the others go through the union's scans.
    """
    c, s, e = keys
    good = features.where(_q(label).isNotNull() & _q(c).isNotNull() & (_q(e) > _q(s)))
    by_label = good.select(F.struct(_q(c).alias("c"), _q(label).alias("label")).alias("_of"), _q(s).alias("s"), _q(e).alias("e"))
    flat = lambda df: df.select(F.col("_of.c").alias("_c"), F.col("s").alias("_s"), F.col("e").alias("_e"), F.col("_of.label").alias("_label"))
    per = _kept(by_label.groupBy("_of").agg(F.count("*").alias("n"), F.min("s").alias("s"), F.max("e").alias("e")), "labels")
    single, many = per.where("n = 1"), per.where("n > 1")
    if many.isEmpty():
        return flat(single)
    rest = by_label if single.isEmpty() else by_label.join(many.select("_of"), "_of", "left_semi")
    return _kept(flat(single.select("_of", "s", "e").unionByName(merge_intervals(rest, ("_of", "s", "e"), 0, bins))), "islands")


def overlap_labels(df: DataFrame, features: DataFrame, label: str, out_col: str, keys=KEYS, right_keys=("chrom", "start", "end"), bins: Bins | None = None) -> DataFrame:
    """Adds the sorted distinct labels of the overlapping features as an array (empty if none; null labels are none).

    Features of one label are united first, so a span meets a label once an island of
    it, however many features pile up there. A row then has one key, the bin that it starts
    in at the level of its length, and an island no longer than that level's bins those
    in which something that reaches it can start; a bin's islands are one row with an array, of
    which a row keeps what it overlaps. So no pair is made a row and nothing is
    joined back. Islands of each longer level are looked up in turn at their own
    level. Levels grow by four, so that a bin's islands are not many more than a row's.
    bins: of the features by (chromosome, label), see :func:`merge_intervals`.
    """
    c, s, e = keys
    islands = _islands(features, label, right_keys, bins)
    kind = islands.schema["_label"].dataType
    length, size = _q(e) - _q(s), F.col("_e") - F.col("_s")
    usual, longest = islands.agg(F.percentile_approx(size, 0.9), F.max(size)).first()
    if usual is None:
        return df.withColumn(out_col, F.array().cast(T.ArrayType(kind)))
    mine = df.where((length > 0) & _q(c).isNotNull()).agg(F.percentile_approx(length, 0.9), F.max(length)).first()
    # Bins are as wide as what is usual on either side, or else there would be many an island.
    widths = [max(1, int(usual), int(mine[0] or 1))]
    while widths[-1] < max(longest, mine[1] or 1):
        widths.append(4 * widths[-1])

    def level_of(x: Column) -> Column:
        return reduce(lambda out, i: F.when(x <= widths[i], i).otherwise(out), reversed(range(len(widths) - 1)), F.lit(len(widths) - 1))

    where = (length > 0) & _q(c).isNotNull()
    asked = sorted(r[0] for r in df.where(where).select(level_of(length).alias("l")).distinct().collect()) if len(widths) > 1 and (mine[1] or 1) > widths[0] else [0]
    found = dict(tuple(r) for r in islands.groupBy(level_of(size).alias("l")).count().collect())

    def binned(at: DataFrame, level, width) -> DataFrame:
        """One row a bin: the islands that something in it, no longer than the width, can reach, in order of labels."""
        first, last = F.floor((F.col("_s") - width) / width), F.floor((F.col("_e") - 1) / width)
        at = at.select("_c", level.alias("_l"), F.explode(F.sequence(first, last)).alias("_b"), F.struct("_label", "_s", "_e").alias("x"))
        return at.groupBy("_b", "_c", "_l").agg(F.sort_array(F.collect_list("x")).alias("_at"))

    def looked_up(df: DataFrame, table: DataFrame, level: Column, width: Column, when: Column, rows: int, out: str) -> DataFrame:
        if rows > BROADCAST_ROWS:
            table = table.hint("merge")
        on = when & (F.floor(_q(s) / width) == F.col("_b")) & (_q(c) == F.col("_c")) & (level == F.col("_l"))
        hit = F.filter("_at", lambda x: (x["_s"] < _q(e)) & (_q(s) < x["_e"]))
        return df.join(table, on, "left").select(*map(_q, df.columns), F.transform(hit, lambda x: x["_label"]).alias(out))

    own = level_of(length)
    width_of = lambda l: reduce(lambda out, i: F.when(l == i, F.lit(widths[i]).cast("long")).otherwise(out), reversed(range(len(widths) - 1)), F.lit(widths[-1]).cast("long"))
    up = islands.withColumn("_at_l", F.explode(F.array(*map(F.lit, asked)))).where(level_of(size) <= F.col("_at_l"))
    table = binned(up, F.col("_at_l"), width_of(F.col("_at_l")))
    rows = 3 * sum(n for level, n in found.items() for a in asked if level <= a)
    columns, outs = df.columns, ["_labels"]
    df = looked_up(df, table, own, width_of(own), where, rows, outs[0])
    for level in sorted(found):
        if level > asked[0]:
            outs.append(f"_labels{level}")
            table = binned(islands.where(level_of(size) == level), F.lit(level), F.lit(widths[level]).cast("long"))
            df = looked_up(df, table, F.lit(level), F.lit(widths[level]).cast("long"), where & (own < level), 3 * found[level], outs[-1])
    every = F.concat(*[F.coalesce(_q(o), F.array().cast(T.ArrayType(kind))) for o in outs])
    every = F.array_distinct(every)
    return df.select(*map(_q, columns), (every if len(outs) == 1 else F.sort_array(every)).alias(out_col))


def region_semi_join(records: DataFrame, regions: DataFrame, keys=KEYS, right_keys=("chrom", "start", "end"), how: str = "left_semi", among: DataFrame | None = None) -> DataFrame:
    """Records that overlap a region: once each (left_semi), or once a region (inner), region columns left out.

    For left_semi the regions are united and written to the shared folder, and the records
    are held against them by :func:`meets_united`. among: see there.
    """
    if how == "inner":
        spans = _spans(records, keys)
        hits = overlap_join(spans, regions.select(*map(_q, right_keys)), keys, right_keys, lengths=interval_lengths(records, regions, keys, right_keys))
        hits = hits.select(*[_q(c).alias(f"_k{i}") for i, c in enumerate(keys)])
        on = [_q(c) == F.col(f"_k{i}") for i, c in enumerate(keys)]
        return records.join(hits, on, how).select(*map(_q, records.columns))
    return meets_united(records, united_regions(regions, right_keys), keys, among)


def united_regions(regions: DataFrame, keys=("chrom", "start", "end")) -> DataFrame:
    """_c, _s, _e: the union of regions, written to the shared folder once."""
    return _kept(merge_intervals(regions, keys, 0).select(*[_q(k).alias(n) for k, n in zip(keys, ("_c", "_s", "_e"))]), "regions")


def meets_united(records: DataFrame, united: DataFrame, keys=KEYS, among: DataFrame | None = None) -> DataFrame:
    """Records that overlap one of :func:`united_regions`.

    A record has one key, the bin that it starts in at the level of its length, and a united
    region the bins in which something that reaches it can start, at the levels that the
    records have: so records are neither repeated nor joined back, and are not moved at
    all where the regions are few. The regions' bins are counted from their lengths, as
    size statistics know nothing of them: more than BROADCAST_ROWS are joined by a sort.
    among: a table that has the records' intervals among its own and is read for the levels,
    where the records are costly; by default the records.
    """
    c, s, e = keys
    n, total = united.agg(F.count("*"), F.sum(F.col("_e") - F.col("_s"))).first()
    width = int((total or 0) / max(n, 1)) + 1
    # Levels up to the longest record that there can be.
    widths = [width]
    while widths[-1] < 1 << 40:
        widths.append(widths[-1] * FACTOR)
    length = _q(e) - _q(s)
    level, at = F.lit(len(widths) - 1), F.floor(_q(s) / widths[-1])
    for i in reversed(range(len(widths) - 1)):
        level, at = F.when(length <= widths[i], i).otherwise(level), F.when(length <= widths[i], F.floor(_q(s) / widths[i])).otherwise(at)
    found = sorted(r[0] for r in (records if among is None else among).where(length > 0).select(level.alias("l")).distinct().collect())
    if not n or not found:
        return records.where(F.lit(False))
    reach = F.explode(F.array(*[F.struct(F.lit(i).alias("l"), F.lit(widths[i]).cast("long").alias("w")) for i in found]))
    united = united.withColumn("x", reach).select("_c", "_s", "_e", F.col("x.l").alias("_l"), F.explode(F.sequence(F.floor((F.col("_s") - F.col("x.w")) / F.col("x.w")), F.floor((F.col("_e") - 1) / F.col("x.w")))).alias("_b"))
    if sum(3 * n + total // widths[i] for i in found) > BROADCAST_ROWS:
        united = united.hint("merge")
    on = (_q(c) == F.col("_c")) & (level == F.col("_l")) & (at == F.col("_b")) & (_q(s) < F.col("_e")) & (F.col("_s") < _q(e)) & (length > 0)
    return records.join(united, on, "left_semi")


def merge_intervals(df: DataFrame, keys=KEYS, min_dist: int = 1, bins: Bins | None = None) -> DataFrame:
    """Union of intervals whose gap is at most min_dist: keys only, disjoint.

    An island begins where start > the largest end before it + min_dist. The running
    maximum and the island numbers are scans over a chromosome: done within bins of
    rows (:func:`cut_bins` by start and end), with one row a bin carried from bin to bin,
    so a chromosome is many tasks. The chromosome may be a column of any type.
    """
    c, s, e = keys
    rows = _spans(df, keys).where((_q(e) > _q(s)) & _q(c).isNotNull()).select(_q(c).alias("c"), _q(s).alias("s"), _q(e).alias("e"))
    rows = _binned(_kept(rows, "spans") if bins is None else rows, "c", ("s", "e"), bins)
    before = Window.partitionBy("c").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    carry = rows.groupBy("bin", "c").agg(F.max("e").alias("e")).select("c", "bin", F.max("e").over(before).alias("carry"))
    within = Window.partitionBy("bin", "c").orderBy("s", "e")
    rows = rows.join(carry, ["bin", "c"])
    reach = F.greatest("carry", F.max("e").over(within.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.withColumn("new", (reach.isNull() | (F.col("s") > reach + min_dist)).cast("long"))
    rows = rows.withColumn("island", F.sum("new").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    parts = rows.groupBy("bin", "c", "island").agg(F.min("s").alias("s"), F.max("e").alias("e"))
    begun = parts.groupBy("bin", "c").agg(F.max("island").alias("n")).select("c", "bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    parts = parts.join(begun, ["bin", "c"]).withColumn("island", F.col("base") + F.col("island"))
    merged = parts.groupBy("c", "island").agg(F.min("s").alias("s"), F.max("e").alias("e"))
    return merged.select(F.col("c").alias(c), F.col("s").alias(s), F.col("e").alias(e))


def nearest_interval(df: DataFrame, genes: DataFrame, symbol: str = "symbol", keys=KEYS, right_keys=("chrom", "start", "end"), out_cols=("nearest_symbol", "nearest_distance")) -> DataFrame:
    """Adds the nearest gene's symbol and its distance: the gap between the intervals, 0 if they overlap or touch.

    Ties go to the smaller (start, symbol); null where the chromosome has no gene. What
    ends up to s lies to the left: the best is that with the largest end. Of what ends
    beyond s, the smallest start is best: it overlaps if it lies before e, and if it does
    not, nothing overlaps and it is the nearest to the right. So both are scans along the
    ends, with no pair made, done within bins of rows with one row a bin carried on from
    either side, as in :func:`merge_intervals`.
    """
    whole = lambda name: F.col(name).cast("long").alias(name)
    a = df.select(*[_q(k).alias(n) for k, n in zip(keys, "cse")]).where("e > s and c is not null").select("c", whole("s"), whole("e"))
    g = genes.select(*[_q(k).alias(n) for k, n in zip(right_keys, ("c", "gs", "ge"))], _q(symbol).cast("string").alias("name")).where("ge > gs and c is not null")
    g = g.select("c", whole("gs"), whole("ge"), "name")
    no = F.lit(None).cast("long")
    by_end, by_start = F.struct((-F.col("ge")).alias("o"), "gs", "name"), F.struct("gs", "name")
    # At equal places ends (0) come before spans (1): they lie to the left.
    rows = a.distinct().select("c", F.col("s").alias("key"), F.lit(1).alias("k"), "s", "e", F.lit(None).cast("struct<o:bigint,gs:bigint,name:string>").alias("l"), F.lit(None).cast("struct<gs:bigint,name:string>").alias("r"), F.col("e").alias("tie"))
    rows = rows.unionByName(g.select("c", F.col("ge").alias("key"), F.lit(0).alias("k"), no.alias("s"), no.alias("e"), by_end.alias("l"), by_start.alias("r"), F.col("gs").alias("tie")))
    rows = _binned(_kept(rows, "places"), "c", ("key", "k", "tie"))
    past = lambda order: Window.partitionBy("c").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    carry = rows.groupBy("bin", "c").agg(F.min("l").alias("l"), F.min("r").alias("r"))
    carry = carry.select("c", "bin", F.min("l").over(past(F.col("bin"))).alias("l_0"), F.min("r").over(past(F.col("bin").desc())).alias("r_0"))
    within = Window.partitionBy("bin", "c").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("l", F.min("l").over(within.orderBy("key", "k", "tie")))
    rows = rows.withColumn("r", F.min("r").over(within.orderBy(F.col("key").desc(), F.col("k").desc(), F.col("tie").desc())))
    rows = rows.where("s is not null").join(carry, ["bin", "c"])
    rows = rows.select("c", "s", "e", F.least("l", "l_0").alias("l"), F.least("r", "r_0").alias("r"))
    beside = lambda g, d: F.when(F.col(g).isNotNull(), F.struct(d.alias("d"), F.col(f"{g}.gs").alias("gs"), F.col(f"{g}.name").alias("name")))
    best = F.least(beside("l", F.col("s") + F.col("l.o")), beside("r", F.greatest(F.col("r.gs") - F.col("e"), F.lit(0).cast("long"))))
    best = rows.select(*[F.col(n).alias(k) for k, n in zip(keys, "cse")], best.alias("best"))
    best = best.select(*map(_q, keys), F.col("best.name").alias(out_cols[0]), F.col("best.d").alias(out_cols[1]))
    return _attach(df, best, keys)


def in_order(df: DataFrame, chrom: str, pos: str, ties=(), out_col: str = "place", bins: Bins | None = None) -> DataFrame:
    """Adds a row's place, from 1, along its chromosome by position and ties.

    Rows are numbered within bins (:func:`cut_bins` by position and ties), which the
    counts of the bins before are added to; so a chromosome is many tasks, and so are the
    rows of one position if the ties tell them apart. A null position comes first, a null
    chromosome is one of its own.
    """
    rows = _binned(df, chrom, (pos, *ties), bins).withColumnRenamed("bin", "_bin")
    before = Window.partitionBy("_c").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(F.col("_bin").alias("_b"), _q(chrom).alias("_c")).agg(F.count("*").alias("_n"))
    counts = counts.select("_c", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("_bin", _q(chrom)).orderBy(_q(pos), *map(_q, ties))
    rows = rows.withColumn("_row", F.row_number().over(within))
    rows = rows.join(counts, (F.col("_bin") == F.col("_b")) & _q(chrom).eqNullSafe(F.col("_c")))
    return rows.withColumn(out_col, F.col("_base") + F.col("_row")).drop("_bin", "_c", "_b", "_base", "_row")


def chunk_numbers(regions: DataFrame, size: int, keys=("chrom", "start", "end"), out_col: str = "chunk") -> DataFrame:
    """Adds the chunk of size regions, from 0, that a region falls in along its chromosome (for reports)."""
    placed = in_order(regions, keys[0], keys[1], keys[2:], "_place")
    return placed.withColumn(out_col, F.floor((F.col("_place") - 1) / size).cast("long")).drop("_place")


def normalize_chrom(df: DataFrame, contigs: DataFrame, chrom: str = "chrom", contig: str = "contig", out_col: str = "contig_name") -> DataFrame:
    """Adds the contig that a chromosome name means: itself, else with 'chr' before it, else without; null if none is known."""
    known = contigs.select(_q(contig).alias("_n")).where("_n is not null").distinct()
    name = _q(chrom)
    forms = [name, F.when(~name.startswith("chr"), F.concat(F.lit("chr"), name)), F.when(name.startswith("chr"), F.substring(name, 4, 1 << 30))]
    for i, form in enumerate(forms):
        df = df.join(known.withColumnRenamed("_n", f"_n{i}"), form == F.col(f"_n{i}"), "left")
    return df.withColumn(out_col, F.coalesce("_n0", "_n1", "_n2")).drop("_n0", "_n1", "_n2")
