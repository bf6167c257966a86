"""Exact top-k search by inner product as a kNN join over Voronoi cells.

Data and queries are lifted to one sphere, where the order by inner product is the order
by distance: a data vector x becomes (x, sqrt(M^2 - |x|^2)) and a query q becomes
(q M / |q|, 0), with M at least the longest length; then |q' - x'|^2 = 2 M^2 - 2 q'x.
Pivots cut both into cells; a group of queries gets only data that its cells' summaries
and the triangle inequality cannot rule out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import written
from ._vectors import NONE, best, integers, scorable, spread, upto

#: Numbers (vectors times components) in a block of data or of queries, about.
BLOCK_VALUES = 1 << 19
#: Pivots at most (there are about as many as the square root of the vectors), and numbers in the sample that they are fitted on.
PIVOTS, SAMPLE_VALUES = 512, 1 << 19
#: Share of M by which bounds are widened: above the error of a distance near 0 in double precision, some 1e-7 of M.
SLACK = 1e-5


@dataclass
class Space:
    """The lifted sphere of radius M, and a cell's pivot a row."""

    m: float
    pivots: np.ndarray

    def lift(self, x: np.ndarray) -> np.ndarray:
        """Data vectors."""
        x = x.astype(np.float64)
        return np.column_stack([x, np.sqrt(np.maximum(0.0, self.m**2 - np.einsum("ij,ij->i", x, x)))])

    def aim(self, q: np.ndarray) -> np.ndarray:
        """Queries; a query of zeros is as far from all data."""
        q = q.astype(np.float64)
        length = np.sqrt(np.einsum("ij,ij->i", q, q))
        return np.column_stack([q * (self.m / np.where(length > 0, length, 1))[:, None], np.zeros(len(q))])

    def home(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest pivot of lifted points, and the distance."""
        d = _distances(x, self.pivots)
        cell = d.argmin(axis=1)
        return cell, d[np.arange(len(x)), cell]


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    square = np.einsum("ij,ij->i", x, x)[:, None] - 2 * x @ y.T + np.einsum("ij,ij->i", y, y)[None]
    return np.sqrt(np.maximum(square, 0))


def fit_pivots(points: np.ndarray, k: int, rounds: int = 5, seed: int = 0) -> np.ndarray:
    """Lloyd's k-means over lifted points; an empty cell takes a point at random."""
    rng = np.random.default_rng(seed)
    pivots = points[rng.choice(len(points), k, replace=False)]
    for _ in range(rounds):
        home = _distances(points, pivots).argmin(axis=1)
        order = np.argsort(home, kind="stable")
        used, first, n = np.unique(home[order], return_index=True, return_counts=True)
        pivots = points[rng.choice(len(points), k)]
        pivots[used] = np.add.reduceat(points[order], first) / n[:, None]
    return pivots


def _bundles(pivots: np.ndarray, queries: np.ndarray, size: int) -> list[np.ndarray]:
    """Cells with queries, in bundles of about ``size`` queries, neighbours along the pivots' main direction together."""
    middle = pivots - pivots.mean(axis=0)
    along = middle @ np.linalg.svd(middle, full_matrices=False)[2][0]
    cells = np.argsort(along, kind="stable")
    cells = cells[queries[cells] > 0]
    part = (np.cumsum(queries[cells]) - queries[cells]) // size
    return np.split(cells, np.flatnonzero(np.diff(part)) + 1) if len(cells) else []


def search(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest scores of each query among all other vectors (vec_id, embedding).

    Components count as floor(256 x); a score is an exact integer inner product, ties go
    to the smaller vec_id. Queries are rows whose vec_id is divisible by ``every``.

    1. Pivots are fitted on a sample of bounded size (drawn by a hash) and each vector is
       put in the cell of its nearest one; a query also gets the distance that its k-th
       best in the sample has, which bounds that of its k-th best in all data.
    2. Summaries: a cell of queries has U, the largest sum of a query's distance from the
       pivot and its bound; a cell of data the least and the greatest distance from its
       pivot. Of data in cell j at distance d from the pivot, cell i of queries needs only
       what has |d - |p_i p_j|| <= U.
    3. Cells of queries are bundled to groups of a block's size, or cut where larger. The
       data goes to the groups that need it, in blocks of a bounded number of rows, and is
       searched there, cell by cell, by the queries whose own bound it does not exceed.

    All is exact: bounds only skip what cannot be among the k best, with a margin for
    rounding. Vectors without structure are hardly skipped: the work is then that of all
    queries against all rows. On the driver are the sample and one row a cell.

    Rows with a null vec_id or vector, a null or non-finite part, no part, another length
    than most vectors, or a squared length of 2**62 and more take no part. Rows that
    share a vec_id are candidates each, and none of the query of that id, which is the first
    of them by vector. Other columns are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    base, count, size, bound = scorable(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding"), "embedding", "vec_id")
    out = "query_id long, vec_id long, score long"
    if not count:
        return spark.createDataFrame([], out).select("query_id", F.lit(0).alias("rank"), "vec_id", "score")
    block, most = max(1, BLOCK_VALUES // size), max(64, SAMPLE_VALUES // size)
    share = min(1.0, 1.2 * most / count)
    drawn = base.where(F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).limit(2 * most).toArrow()
    drawn = drawn.sort_by("vec_id") if drawn.num_rows else base.limit(1).toArrow()
    ids, sample = drawn["vec_id"].to_numpy(), integers(drawn["embedding"])
    space = Space(float(np.sqrt(bound)) + 1, np.zeros((0, size + 1)))
    asks = ids % every == 0
    points = np.concatenate([space.lift(sample), space.aim(sample[asks])])
    space.pivots = fit_pivots(points, min(PIVOTS, len(points), int(np.ceil(np.sqrt(count)))))
    known = space.lift(sample)
    exact = np.float64 if bound < 2.0**53 else np.int64  # sums that float64 holds, or such as numpy does itself

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cell and distance; of queries also those of the aimed vector, and the bound."""
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                part = whole.slice(at, 1024)
                x, own = integers(part.column(1)), part.column(0).to_numpy()
                cell, distance = space.home(space.lift(x))
                asking = np.flatnonzero(own % every == 0)
                q_cell, q_distance, reach = np.full(len(x), -1), np.zeros(len(x)), np.zeros(len(x))
                if len(asking):
                    aimed = space.aim(x[asking])
                    q_cell[asking], q_distance[asking] = space.home(aimed)
                    d = _distances(aimed, known)
                    d[own[asking][:, None] == ids[None]] = np.inf
                    reach[asking] = np.partition(d, k - 1, axis=1)[:, k - 1] if d.shape[1] >= k else np.inf
                columns = [*part.columns, *map(pa.array, (cell, distance, q_cell, q_distance, reach))]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "embedding", "cell", "distance", "q_cell", "q_distance", "reach"])

    kind = vectors.schema["embedding"].dataType.simpleString()
    placed = written(base.mapInArrow(assign, f"vec_id long, embedding {kind}, cell long, distance double, q_cell long, q_distance double, reach double"), "placed")
    one = F.min(F.struct("embedding", "q_cell", "q_distance", "reach")).alias("v")
    queries = written(placed.where("q_cell >= 0").groupBy("vec_id").agg(one).select("vec_id", "v.*"), "queries")

    # One row a cell, of PIVOTS at most.
    data = placed.groupBy("cell").agg(F.min("distance").alias("lo"), F.max("distance").alias("hi")).toArrow()
    asked = queries.groupBy("q_cell").agg(F.count("*").alias("n"), F.max(F.col("q_distance") + F.col("reach")).alias("far")).toArrow()
    cells, lo, hi = (data[c].to_numpy() for c in ("cell", "lo", "hi"))
    n, far = np.zeros(len(space.pivots), np.int64), np.zeros(len(space.pivots))
    n[asked["q_cell"].to_numpy()] = asked["n"].to_numpy()
    far[asked["q_cell"].to_numpy()] = asked["far"].to_numpy()
    between, slack = _distances(space.pivots, space.pivots), SLACK * space.m
    routes = []  # group, data cell, least and greatest distance from its pivot: a row for each two cells at most
    group_of, cuts = np.full(len(n), -1), []
    for g, members in enumerate(_bundles(space.pivots, n, block)):
        group_of[members] = g
        cuts.append(max(1, -(-int(n[members].sum()) // block)))
        least = np.maximum(lo, (between[members][:, cells] - far[members][:, None]).min(axis=0) - slack)
        greatest = np.minimum(hi, (between[members][:, cells] + far[members][:, None]).max(axis=0) + slack)
        routes += [(g, int(c), float(a), float(b)) for c, a, b in zip(cells, least, greatest) if a <= b]
    # Of proven size: PIVOTS squared rows at most.
    table = F.broadcast(spark.createDataFrame(routes, "g int, c long, a double, b double"))
    needed = placed.join(table, (F.col("cell") == F.col("c")) & F.col("distance").between(F.col("a"), F.col("b")))
    sizes = dict(needed.groupBy("g").count().collect())  # one row a group
    shape = spark.createDataFrame([(g, cuts[g], max(1, -(-sizes.get(g, 0) // block))) for g in range(len(cuts))], "g int, nq int, nd int")
    homes = spark.createDataFrame([(c, int(g)) for c, g in enumerate(group_of) if g >= 0], "q_cell long, g int")
    # A task: a part of a group's queries beside a block of the data that the group needs.
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    part = lambda column, n: F.pmod(column, F.col(n)).cast("int")
    left = queries.join(F.broadcast(homes), "q_cell").join(F.broadcast(shape), "g")
    left = left.select("g", part(F.xxhash64("vec_id"), "nq").alias("q"), each("nd").alias("d"), F.lit(True).alias("asks"), "vec_id", "embedding", "reach", F.col("q_cell").alias("cell"), F.lit(0.0).alias("distance"))
    right = needed.join(F.broadcast(shape), "g").withColumn("d", part(F.xxhash64(F.monotonically_increasing_id()), "nd"))
    right = right.select("g", each("nq").alias("q"), "d", F.lit(False).alias("asks"), "vec_id", "embedding", "reach", "cell", "distance")

    def solve(block: pa.Table) -> pa.Table:
        found = [(np.empty(0, np.int64),) * 3]
        asks = block["asks"].to_numpy()
        own, others = (block.filter(pa.array(m)).sort_by([("cell", "ascending"), ("vec_id", "ascending")]) for m in (asks, ~asks))
        if own.num_rows and others.num_rows:
            q, q_ids, reach = integers(own["embedding"]), own["vec_id"].to_numpy(), own["reach"].to_numpy()
            x, x_ids, x_cell, x_far = integers(others["embedding"]), others["vec_id"].to_numpy(), others["cell"].to_numpy(), others["distance"].to_numpy()
            start = np.flatnonzero(np.diff(x_cell, prepend=-1))
            held = np.unique(x_cell)
            to = _distances(space.aim(q), space.pivots[held])
            # A query's distance to the nearest and from the farthest ring that a cell's rows of this block lie in.
            near = np.maximum(to - np.maximum.reduceat(x_far, start), np.minimum.reduceat(x_far, start) - to) <= reach[:, None] + slack
            x, q = x.astype(exact), q.astype(exact)
            for at in range(0, len(q), 256):
                some = slice(at, at + 256)
                use = np.flatnonzero(np.repeat(near[some].any(axis=0), np.diff(np.append(start, len(x)))))
                use = use[np.argsort(x_ids[use], kind="stable")]
                if len(use):
                    s = (q[some] @ x[use].T).astype(np.int64)
                    s[q_ids[some][:, None] == x_ids[use][None]] = NONE
                    i, j = best(s, k)
                    found.append((q_ids[some][i], x_ids[use][j], s[i, j]))
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, zip(*found)))))

    hits = left.unionByName(right).groupBy("g", "q", "d").applyInArrow(solve, out)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op12_topk_search(spark, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP12_SQL = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, x.vec_id, CAST(list_inner_product(q.v, x.v) AS BIGINT) AS score FROM e q JOIN e x ON q.vec_id % 50 = 0 AND q.vec_id <> x.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""
