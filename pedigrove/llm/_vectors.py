"""Integer vectors: components floor(256 x), rows that can be scored, the best of a block of scores."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A component x counts as floor(SCALE * x).
SCALE = 256
#: Rows whose squared length may reach this take no part: below it every score is a long.
LONGEST = 2.0**62
#: A score that stands for none.
NONE = np.iinfo(np.int64).min


class Scorable(NamedTuple):
    rows: DataFrame
    count: int
    #: Length of the vectors.
    size: int
    #: No score, and no squared length, is larger.
    bound: float


def scorable(rows: DataFrame, vector: str, *needed: str) -> Scorable:
    """Rows with a vector of finite parts, of the length that most have (the shorter of two), and the ``needed`` columns.

    Out are nulls, vectors with null or non-finite parts, empty ones, and those whose
    scores could not be told in a long (squared length of 2**62 and more).
    """
    bound = F.aggregate(vector, F.lit(0.0), lambda total, x: total + F.pow(F.abs(x.cast("double") * SCALE) + 1, 2))
    good = rows.withColumn("_bound", bound).where((F.col("_bound") < LONGEST) & (F.size(vector) > 0))
    for c in needed:
        good = good.where(F.col(c).isNotNull())
    usual = good.groupBy(F.size(vector).alias("d")).agg(F.count("*").alias("n"), F.max("_bound").alias("bound")).orderBy(F.desc("n"), "d").first()
    d, n, bound = usual or (0, 0, 0.0)
    return Scorable(good.where(F.size(vector) == d).drop("_bound"), n, d, bound)


def integers(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """floor(256 x) of a column of vectors of one length, one row a vector."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(values * SCALE).astype(np.int64).reshape(len(column), -1)


def best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each row's k highest scores (all but NONE, if fewer); of equal ones the first columns."""
    if scores.shape[1] > k:
        least = np.partition(scores, -k, axis=1)[:, -k][:, None]
        over, equal = scores > least, scores == least
        equal &= np.cumsum(equal, axis=1) <= k - over.sum(axis=1)[:, None]
        return np.nonzero((over | equal) & (scores != NONE))
    return np.nonzero(scores != NONE)


def spread(n: int) -> Column:
    """A number under n for each row of a scan, whatever repeats in it."""
    return F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)).cast("int")


def upto(n: int) -> Column:
    """Each number under n, a row each."""
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
