"""Hard-negative mining: exact scores by residue-number-system products, then windows of scores below each positive's."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import written
from ._vectors import NONE, best, integers, scorable, spread, upto

#: Numbers (rows times components) in a block of rows or of anchors, about.
BLOCK_VALUES = 1 << 19
#: Components of one float32 product: WIDTH * (p / 2) ** 2 stays under 2 ** 24 for primes p under PRIME.
WIDTH, PRIME = 64, 1024


def primes_for(bound: float) -> list[int]:
    """The largest primes under PRIME whose product tells apart all whole numbers from -bound to bound."""
    found, product = [], 1
    for p in range(PRIME - 1, 2, -1):
        if all(p % q for q in range(2, int(p**0.5) + 1)):
            found.append(p)
            product *= p
            if product > 2 * int(bound) + 8:
                return found
    raise ValueError("too large a bound")


def residues(numbers: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """The numbers modulo each prime, around 0, in float32."""
    found = []
    for p in primes:
        r = numbers % p
        r[r > p // 2] -= p
        found.append(r.astype(np.float32))
    return found


def products(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact inner products of rows of a and of b, both as residues: a float32 product a prime, then Chinese remaindering.

    Each sum of WIDTH products stays under 2**24, where float32 is exact. The remainders
    become digits of a mixed radix around 0, whose places are the products of the primes
    before, so signs come out without a further step.
    """
    value, place = None, 1
    for x, y, p in zip(a, b, primes):
        rest = np.zeros((len(x), len(y)), np.float32)
        for at in range(0, x.shape[1], WIDTH):
            part = x[:, at : at + WIDTH] @ y[:, at : at + WIDTH].T
            part -= np.float32(p) * np.rint(part * np.float32(1 / p))
            rest += part
        rest = rest.astype(np.int64)
        if value is None:
            value = rest - p * np.rint(rest / p).astype(np.int64)
        else:
            digit = (rest - value) % p * pow(place, -1, p) % p
            digit[digit > p // 2] -= p
            value += digit * np.int64(place)
        place *= p
    return value


def _lists(column) -> list[np.ndarray]:
    column = column.combine_chunks()
    return np.split(column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()[1:-1] - column.offsets[0].as_py())


def _grid(anchors: DataFrame, rows: DataFrame, blocks: tuple[int, int]) -> DataFrame:
    """Every block of anchors beside every block of rows, one group (a, r) each."""
    na, nr = blocks
    own = anchors.select("vec_id", "label", "embedding", "scores", F.pmod(F.xxhash64("vec_id"), F.lit(na)).cast("int").alias("a"), upto(nr).alias("r"))
    own = own.withColumn("anchor", F.lit(True))
    others = rows.withColumn("r", spread(nr)).select("vec_id", "label", "embedding", F.lit(None).cast("array<bigint>").alias("scores"), upto(na).alias("a"), "r", F.lit(False).alias("anchor"))
    return own.unionByName(others).groupBy("a", "r")


def mine(rows: DataFrame, positives: int = 5, negatives: int = 5, least: int = 80, most: int = 100, every: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of rows (vec_id, embedding, label).

    Components count as floor(256 x); a score is an exact integer inner product; higher
    ones come first, ties by smaller vec_id. Anchors are rows whose vec_id is divisible
    by ``every``; an anchor's positives are its first ``positives`` other rows of its
    label, and of each, the first ``negatives`` rows of another label whose score is
    from ``least`` to ``most`` hundredths of the positive's are returned. None are for a
    positive of a score below 0, as that range is empty.

    Anchors are held against all rows in blocks, twice: for the positives (only rows of an
    anchor's label are multiplied), then for what lies in the window below each of
    their scores. A block gives its best few, so rows moved on are ``positives`` (times
    ``negatives``) an anchor and block. Blocks have a bounded number of rows, whatever
    repeats. What is kept between the steps is written to the shared folder.

    Rows with a null vec_id, label or vector, a null or non-finite part, no part, another
    length than most vectors, or a squared length of 2**62 and more take no part. Rows
    that share a vec_id are candidates each, and none of an anchor with that id; of those
    with an anchor's id the first by label and vector is the anchor. Other columns
    are ignored; an empty table gives no rows.
    """
    base = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    base, count, size, bound = scorable(base, "embedding", "vec_id", "label")
    primes = primes_for(bound)
    first = F.min(F.struct("label", "embedding")).alias("v")
    anchors = base.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(first).select("vec_id", "v.label", "v.embedding")
    anchors = written(anchors.withColumn("scores", F.lit(None).cast("array<bigint>")), "anchors")
    block = max(1, BLOCK_VALUES // max(1, size))
    blocks = (max(1, -(-anchors.count() // block)), max(1, -(-count // block)))

    def sides(table: pa.Table):
        table = table.sort_by("vec_id")  # equal scores then come in the order of ids
        is_anchor = table["anchor"].to_numpy()
        return table.filter(pa.array(is_anchor)), table.filter(pa.array(~is_anchor))

    def nearest(table: pa.Table) -> pa.Table:
        """Of each anchor of the block, the best rows of its label."""
        own, others = sides(table)
        ids, other_ids = own["vec_id"].to_numpy(), others["vec_id"].to_numpy()
        label, other_label = own["label"].to_numpy(), others["label"].to_numpy()
        x, y = residues(integers(own["embedding"]), primes), residues(integers(others["embedding"]), primes)
        order = np.argsort(other_label, kind="stable")
        found = [(np.empty(0, np.int64),) * 3]
        for value in np.unique(label):
            mine = np.flatnonzero(label == value)
            lo, hi = np.searchsorted(other_label[order], [value, value + 1])
            same = order[lo:hi]
            for at in range(0, len(mine) if len(same) else 0, 256):
                some = mine[at : at + 256]
                s = products([r[some] for r in x], [r[same] for r in y], primes)
                s[ids[some][:, None] == other_ids[same][None]] = NONE
                i, j = best(s, positives)
                found.append((ids[some][i], other_ids[same][j], s[i, j]))
        return pa.table(dict(zip(("anchor_id", "vec_id", "score"), map(np.concatenate, zip(*found)))))

    def below(table: pa.Table) -> pa.Table:
        """Of each anchor and positive score, the best rows of other labels in its window."""
        own, others = sides(table)
        ids, other_ids = own["vec_id"].to_numpy(), others["vec_id"].to_numpy()
        label, other_label = own["label"].to_numpy(), others["label"].to_numpy()
        x, y = residues(integers(own["embedding"]), primes), residues(integers(others["embedding"]), primes)
        scores = _lists(own["scores"])
        found = [(np.empty(0, np.int64),) * 4]
        for at in range(0, len(ids) if len(other_ids) else 0, 256):
            some = slice(at, at + 256)
            s = products([r[some] for r in x], y, primes)
            s[(label[some][:, None] == other_label[None]) | (ids[some][:, None] == other_ids[None])] = NONE
            for p in range(positives):
                have = np.array([i for i in range(len(s)) if len(scores[at + i]) > p and scores[at + i][p] >= 0], np.int64)
                if not len(have):
                    break
                high = np.array([scores[at + i][p] for i in have], np.int64)
                top, low = _share(high, most, True), _share(high, least, False)
                i, j = best(np.where((s[have] <= top[:, None]) & (s[have] >= low[:, None]), s[have], NONE), negatives)
                found.append((ids[some][have[i]], np.full(len(i), p + 1, np.int64), other_ids[j], s[have[i], j]))
        return pa.table(dict(zip(("anchor_id", "place", "negative_id", "negative_score"), map(np.concatenate, zip(*found)))))

    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    pairs = _grid(anchors, base, blocks).applyInArrow(nearest, "anchor_id long, vec_id long, score long")
    pairs = pairs.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    pairs = written(pairs.select("anchor_id", F.col("place").cast("long").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    scores = F.transform(F.array_sort(F.collect_list(F.struct("place", "positive_score"))), lambda x: x["positive_score"])
    asked = anchors.drop("scores").join(pairs.groupBy(F.col("anchor_id").alias("vec_id")).agg(scores.alias("scores")), "vec_id")
    found = _grid(asked, base, blocks).applyInArrow(below, "anchor_id long, place long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor_id", "place").orderBy(F.desc("negative_score"), "negative_id")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return found.join(pairs, ["anchor_id", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _share(score: np.ndarray, hundredths: int, down: bool) -> np.ndarray:
    """score * hundredths / 100, rounded down or up, for scores of 0 and more: no step leaves 64 bits."""
    whole, rest = np.divmod(score, 100)
    part = rest * hundredths
    return whole * hundredths + (part // 100 if down else -(-part // 100))


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.col("label").cast("long")
    return mine(rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)))


OP11_SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS s FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT a, b AS positive_id, s AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5)
SELECT p.a AS anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.a, positive_id ORDER BY s.s DESC, s.b) AS INTEGER) AS rank, s.b AS negative_id, positive_score, s.s AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.same AND 80 * positive_score <= 100 * s.s AND 100 * s.s <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.a, positive_id ORDER BY s.s DESC, s.b) <= 5
"""
