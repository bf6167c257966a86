"""Mixing sources to target weights by pivotal dependent rounding (native).

Each document of a source should be taken p = target / source size times. The whole
part of p is certain; the fraction is rounded so that the source's taken words stay
next to its target: two fractional documents meet, words move from one to the other
until one is taken or left out, the other stays fractional and meets the next one.
Which way the words move is random and keeps every document's expected copies at p.

The meetings form a reduction tree: documents are dealt by a hash to blocks of about
FAN_IN, each block is folded in one pass and leaves one fractional document at most,
and what the blocks leave is dealt again, until one is left a source. That last one is
rounded to the nearer side, so a source misses its target by half a document at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import WORD, written

#: Documents of a block: bounds what a task gathers, not what is mixed.
FAN_IN = 128
WEIGHTS = (3.0, 1.0, 2.0)


def targets(sources: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Words to take of each source. sources: source, source_size (one row a source).

    Sources by code point, null last, get the weights in turn and share ``share`` times
    all sizes; a target above ``most`` times its source's size stops there and the excess
    is shared again by weight. That is target = min(cap, level * weight) with one level
    for all: sources sorted by cap / weight stop as long as the level that the rest
    would get exceeds their own. Adds target; a source without words gets 0. The windows
    run over one row a source, of which there are few next to the documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy(F.lit(1))
    s = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    s = s.withColumn("cap", F.col("source_size") * F.lit(most)).withColumn("all", F.sum("source_size").over(every) * F.lit(share))
    by_cap = Window.partitionBy(F.lit(1)).orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    s = s.withColumn("before", F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    s = s.withColumn("rest", F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)))
    s = s.withColumn("level", (F.col("all") - F.col("before")) / F.col("rest"))
    s = s.withColumn("stops", F.col("level") * F.col("weight") >= F.col("cap"))
    level = F.min(F.when(~F.col("stops"), F.struct(F.col("cap") / F.col("weight"), F.col("level"))))
    s = s.withColumn("level", level.over(every)["level"])
    return s.select("source", "source_size", F.when(F.col("stops"), F.col("cap")).otherwise(F.col("level") * F.col("weight")).alias("target"))


def _uniform(*what: Column) -> Column:
    """A number in [0, 1) that reruns and other partitions give again."""
    return F.shiftrightunsigned(F.xxhash64(*what), 11).cast("double") / F.lit(float(1 << 53))


def _let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.transform(F.array(value), body)[0]


def _meet(state: Column, x: Column, seed: int) -> Column:
    """One meeting: state (carry, done) and the next document x; either is (k, size, p)."""
    def moved(c: Column) -> Column:
        up = F.least((1 - c["p"]) * c["size"], x["p"] * x["size"])  # words that can move to the carry
        down = F.least(c["p"] * c["size"], (1 - x["p"]) * x["size"])
        give = (_uniform(c["k"], x["k"], F.lit(seed)) * (up + down)) < down
        # Which of the two becomes whole is read off the same comparison as the amount, so it is exactly 0 or 1.
        pair = lambda p, q, left: F.struct(
            F.struct(F.when(left, x["k"]).otherwise(c["k"]).alias("k"), F.when(left, x["size"]).otherwise(c["size"]).alias("size"), F.when(left, q).otherwise(p).alias("p")).alias("carry"),
            F.struct(F.when(left, c["k"]).otherwise(x["k"]).alias("k"), F.when(left, c["size"]).otherwise(x["size"]).alias("size"), F.when(left, p).otherwise(q).alias("p")).alias("out"),
        )
        fills = (1 - c["p"]) * c["size"] <= x["p"] * x["size"]
        drains = c["p"] * c["size"] <= (1 - x["p"]) * x["size"]
        return (
            F.when(give & fills, pair(F.lit(1.0), x["p"] - up / x["size"], F.lit(True)))
            .when(give, pair(c["p"] + up / c["size"], F.lit(0.0), F.lit(False)))
            .when(drains, pair(F.lit(0.0), x["p"] + down / x["size"], F.lit(True)))
            .otherwise(pair(c["p"] - down / c["size"], F.lit(1.0), F.lit(False)))
        )

    first = F.struct(x.alias("carry"), state["done"].alias("done"))
    met = _let(moved(state["carry"]), lambda m: F.struct(m["carry"].alias("carry"), F.concat(state["done"], F.array(m["out"])).alias("done")))
    return F.when(state["carry"].isNull(), first).otherwise(met)


def _fold(rows: Column, seed: int) -> Column:
    """Array of (k, size, p), all fractional, to (carry, done)."""
    unit = "struct<k:bigint,size:bigint,p:double>"
    start = F.struct(F.lit(None).cast(unit).alias("carry"), F.array().cast(f"array<{unit}>").alias("done"))
    return F.aggregate(rows, start, lambda s, x: _meet(s, x, seed))


def pivotal_round(units: DataFrame, fan_in: int = FAN_IN, seed: int = 1) -> DataFrame:
    """units: source, k (long, distinct in a source), size (long > 0), p in [0, 1].

    Returns source, k, copies (0 or 1): the sum of size * copies of a source differs
    from the sum of size * p by half a unit's size at most, and P(copies = 1) = p but
    for the one unit a source that is left in the end.
    Levels of the tree: log_fan_in of the largest source.
    """
    whole = units.where("p = 0 or p = 1").select("source", "k", F.col("p").cast("int").alias("copies"))
    left = units.where("p > 0 and p < 1").select("source", "k", "size", "p")
    counted = left.groupBy(F.col("source").alias("_s")).agg(F.ceil(F.count("*") / fan_in).alias("blocks"))
    counted = written(counted, "mix-blocks")
    most = counted.agg(F.max("blocks")).first()[0] or 0
    left = left.join(counted, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    parts, level = [whole], 0
    while most:
        rows = F.array_sort(F.collect_list(F.struct(F.xxhash64("k", F.lit(seed + level)).alias("h"), "k", "size", "p")))
        rows = F.transform(rows, lambda x: F.struct(x["k"].alias("k"), x["size"].alias("size"), x["p"].alias("p")))
        block = F.pmod(F.xxhash64("k", F.lit(seed + 1000 + level)), F.col("blocks"))
        folded = left.groupBy("source", "blocks", block.alias("block")).agg(_fold(rows, seed + level).alias("f"))
        folded = written(folded.select("source", "blocks", "f.carry", "f.done"), f"mix-{level}")
        parts.append(folded.select("source", F.explode("done").alias("d")).select("source", "d.k", F.col("d.p").cast("int").alias("copies")))
        carry = folded.where("carry is not null").select("source", "blocks", "carry.*")
        parts.append(carry.where("p = 0 or p = 1").select("source", "k", F.col("p").cast("int").alias("copies")))
        left = carry.where("p > 0 and p < 1").withColumn("blocks", F.ceil(F.col("blocks") / fan_in))
        if most == 1:
            break
        most, level = -(-most // fan_in), level + 1
    parts.append(left.select("source", "k", (F.col("p") >= 0.5).cast("int").alias("copies")))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix(documents: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 1) -> DataFrame:
    """Adds size, source_size, target, copies to documents' rows (columns of these names are replaced).

    A document's size is its number of words (null or empty text: 0, taken 0 times).
    Rows that agree in doc_id, source and text are one unit and share the decision;
    null ids and null sources are values of their own. The unit's key is a 64-bit hash of
    them; of some billions of rows a few would share a decision by chance, no more. No row is dropped here: rows
    with copies = 0 are those the mix leaves out. An empty table gives an empty one.
    """
    d = documents.drop("size", "source_size", "target", "copies", "_k", "_s", "_base", "_unit", "_copies").withColumn("size", word_count(F.col("text")))
    d = d.withColumn("_k", F.xxhash64("doc_id", "source", "text"))
    small = written(d.select("source", "_k", "size"), "mix-sizes")
    units = small.groupBy("source", "_k").agg(F.sum("size").alias("size"))
    per = written(targets(units.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most), "mix-targets")
    at = per.select(F.col("source").alias("_s"), "source_size", "target")
    units = units.join(at, F.col("source").eqNullSafe(F.col("_s"))).where("size > 0")
    rate = F.try_divide("target", "source_size")  # null for a source without words
    units = units.select("source", F.col("_k").alias("k"), "size", F.floor(rate).alias("base"), (rate - F.floor(rate)).alias("p"))
    rounded = pivotal_round(units.select("source", "k", "size", "p"), seed=seed)
    base = per.select(F.col("source").alias("_s"), "source_size", "target", F.when(F.col("source_size") > 0, F.floor(rate)).otherwise(0).cast("int").alias("_base"))
    rounded = rounded.select(F.col("k").alias("_unit"), F.col("copies").alias("_copies"))
    out = d.join(rounded, F.col("_k") == F.col("_unit"), "left").join(base, F.col("source").eqNullSafe(F.col("_s")), "left")
    copies = F.when(F.col("size") > 0, F.col("_base") + F.coalesce("_copies", F.lit(0))).otherwise(0).cast("int")
    return out.withColumn("copies", copies).drop("_k", "_unit", "_copies", "_s", "_base")


def repeat_rows(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row as often as it was taken."""
    return mixed.where("copies > 0").withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("_i", "size", "source_size", "target", "copies")


def op6_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
