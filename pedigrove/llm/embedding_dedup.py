"""Embedding near-dedup: spherical k-means cells, blocked cosine products within cells."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import connected_components, written

#: Vectors that the cells are fitted on, vectors aimed at in a cell, rows of a block.
SAMPLE, CELL_ROWS, BLOCK_ROWS = 20_000, 256, 4096
#: Cells besides its home that a vector is compared in: the nearest ones. Times that many where cells are of two codebooks.
VISITS, WIDER = 8, 6
#: Centroids of a codebook; more cells than that are pairs of a centroid and a direction around it.
CODEBOOK = 1024


def fit_cells(sample: np.ndarray, k: int, rounds: int = 10, seed: int = 0) -> np.ndarray:
    """Spherical k-means over unit vectors: k unit centroids."""
    rng = np.random.default_rng(seed)
    cells = sample[rng.choice(len(sample), k, replace=False)]
    for _ in range(rounds):
        home = (sample @ cells.T).argmax(1)
        order = np.argsort(home, kind="stable")
        used, first = np.unique(home[order], return_index=True)
        sums = np.zeros_like(cells)
        sums[used] = np.add.reduceat(sample[order], first)
        norm = np.linalg.norm(sums, axis=1)
        empty = norm < 1e-9
        sums[empty] = sample[rng.choice(len(sample), int(empty.sum()))]
        cells = sums / np.where(empty, 1.0, norm)[:, None]
    return cells / np.linalg.norm(cells, axis=1)[:, None]


@dataclass
class Cells:
    """Unit centroids. With directions, a cell is a centroid c and a direction d: its own centroid is c + reach * d, normed.

    So two codebooks of bounded size, fitted on one sample of bounded size, name up to
    CODEBOOK ** 2 cells, and the cells' number can follow that of the vectors. Such cells
    are cut less well than k-means cells of their own: they take WIDER times the visits.
    """

    centroids: np.ndarray
    directions: np.ndarray | None = None
    reach: float = 0.0

    def __len__(self) -> int:
        return len(self.centroids) * (1 if self.directions is None else len(self.directions))

    def nearest(self, x: np.ndarray, m: int) -> np.ndarray:
        """Numbers of the m nearest cells of each row, its home first."""
        m = min(m, len(self))
        near = x @ self.centroids.T
        if self.directions is None:
            return _top(near, m)
        coarse = _top(near, min(m, near.shape[1]))
        norm = np.sqrt(1 + self.reach**2 + 2 * self.reach * self.centroids @ self.directions.T)
        along = self.reach * (x @ self.directions.T)
        score = (np.take_along_axis(near, coarse, 1)[:, :, None] + along[:, None, :]) / norm[coarse]
        best = _top(score.reshape(len(x), -1), m)
        return np.take_along_axis(coarse, best // len(self.directions), 1) * len(self.directions) + best % len(self.directions)


def _top(score: np.ndarray, m: int) -> np.ndarray:
    some = np.argpartition(-score, m - 1, axis=1)[:, :m]
    return np.take_along_axis(some, np.argsort(-np.take_along_axis(score, some, 1), axis=1, kind="stable"), 1)


def fit(sample: np.ndarray, k: int) -> Cells:
    """About k cells (no more than there are vectors in the sample, squared)."""
    if k <= min(CODEBOOK, len(sample)):
        return Cells(fit_cells(sample, k))
    side = int(min(CODEBOOK, len(sample), np.ceil(np.sqrt(k))))
    centroids = fit_cells(sample, side)
    near = sample @ centroids.T
    own = near.max(1)
    rest = sample - own[:, None] * centroids[near.argmax(1)]
    size = np.linalg.norm(rest, axis=1)
    far = size > 1e-6
    if far.sum() < side:
        return Cells(centroids)
    return Cells(centroids, fit_cells(rest[far] / size[far, None], side, seed=1), 0.4 * float(np.mean(size[far] / np.maximum(own[far], 0.1))))


def valid(vector) -> F.Column:
    """Neither null nor zero nor with a null or non-finite part."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0)


def _unit(batch_column) -> np.ndarray:
    values = batch_column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    m = values.reshape(len(batch_column), -1)
    m = m / np.abs(m).max(axis=1)[:, None]  # so that no square over- or underflows
    return m / np.sqrt(np.einsum("ij,ij->i", m, m))[:, None]


def link_vectors(vectors: DataFrame, threshold: float = 0.9, visits: int | None = None, exact: bool = False) -> tuple[DataFrame, DataFrame]:
    """Links among distinct vectors: vectors has node (long), copies (long), embedding (valid, one length).

    Returns (degrees, edges): node, n (copies of the vectors that it links with); and
    edges that connect the same nodes as the links do, at most one a node and block.

    A vector's home is its nearest cell; it also visits the next ``visits`` cells, and a
    cell compares its residents with each other and with its visitors. The cells follow
    the vectors in number, so a vector meets about (1 + visits) * CELL_ROWS others,
    up to CODEBOOK ** 2 cells, that is 268 million vectors; beyond that the cells grow with
    the vectors, no row is left out, and the work is quadratic again. A link is missed only if neither vector visits the other's
    home: of pairs at the very threshold in 64 dimensions 0.3 to 1 % are, of closer
    ones fewer, of those above 0.95 next to none (tests measure it).

    exact: no link is missed. A vector then visits each lower-numbered cell that can hold
    a partner: for x at home in c, y at home in c' and |x - y| <= r, where r is the chord
    of the threshold, y (c' - c) <= (y - x) (c' - c) <= r |c' - c|, as x (c - c') >= 0.
    On vectors without structure that is nearly every cell: the work is that of all pairs.
    """
    spark = vectors.sparkSession
    total = vectors.count()
    # The cells' fit: a sample of bounded size, taken by a hash of the node so that reruns agree.
    share = min(1.0, 1.2 * SAMPLE / max(1, total))
    drawn = vectors.where(F.pmod(F.xxhash64("node", F.lit(7)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).limit(2 * SAMPLE)
    sample = _unit(drawn.select("embedding").toArrow()["embedding"].combine_chunks())
    sample = sample[np.lexsort(sample.T[::-1])]
    wanted = max(1, total // CELL_ROWS)
    cells = fit(sample, min(wanted, CODEBOOK, len(sample)) if exact else wanted)
    if visits is None:
        visits = VISITS * (1 if cells.directions is None else WIDER)
    between = np.sqrt(np.maximum(0, 2 - 2 * cells.centroids @ cells.centroids.T)) if exact else None
    chord = np.sqrt(2 - 2 * threshold)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                x = _unit(part.column(2))
                if exact:
                    near = x @ cells.centroids.T
                    home = near.argmax(1)
                    own = near[np.arange(len(x)), home]
                    goes = (own[:, None] - near <= chord * between[home] + 1e-9) & (np.arange(len(cells))[None] < home[:, None])
                    to = [np.append(h, np.flatnonzero(g)) for h, g in zip(home, goes)]
                else:
                    to = cells.nearest(x, visits + 1).tolist()
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(to, pa.list_(pa.int64()))], names=["node", "copies", "embedding", "cells"])

    kind = vectors.schema["embedding"].dataType.simpleString()
    dealt = vectors.select("node", "copies", "embedding").mapInArrow(assign, f"node long, copies long, embedding {kind}, cells array<bigint>")
    dealt = written(dealt, "cells")
    # Cells of more than a block's rows, as a large group of near copies makes them, are cut into blocks. There are few:
    # their table is written, so that its size is known before its join is planned.
    sizes = dealt.select(F.posexplode("cells").alias("i", "cell")).groupBy("cell").agg(F.count_if(F.col("i") == 0).alias("residents"), F.count("*").alias("rows"))
    hot = sizes.where(F.col("rows") > BLOCK_ROWS).select(F.col("cell").alias("_c"), F.ceil(F.col("residents") / BLOCK_ROWS * 2).alias("_a"), F.ceil(F.col("rows") / BLOCK_ROWS).alias("_b"))
    hot = written(hot, "large-cells")
    rows = dealt.select("node", "copies", "embedding", "cells", F.posexplode("cells").alias("i", "cell"))
    rows = rows.join(hot, F.col("cell") == F.col("_c"), "left").withColumns({"_a": F.greatest(F.coalesce("_a", F.lit(1)), F.lit(1)), "_b": F.coalesce("_b", F.lit(1))})
    # A task compares residents of block a with rows of block b. A row is in it as one of the former, the latter, or both.
    left, right = (F.pmod(F.xxhash64("node", F.lit(1)), F.col(n)) for n in ("_a", "_b"))
    task = lambda a, b, role: F.struct(a.alias("a"), b.alias("b"), role.alias("role"))
    against = F.transform(F.sequence(F.lit(0).cast("long"), F.col("_a") - 1), lambda a: task(a, right, F.when((F.col("i") == 0) & (a == left), 2).otherwise(1)))
    across = F.transform(F.filter(F.sequence(F.lit(0).cast("long"), F.col("_b") - 1), lambda b: b != right), lambda b: task(left, b, F.lit(0)))
    tasks = F.when(F.col("i") == 0, F.concat(against, across)).otherwise(against)
    blocks = rows.select("cell", "node", "copies", "embedding", F.col("cells").alias("cells"), F.explode(tasks).alias("t"))
    blocks = blocks.select("cell", "t.a", "t.b", "t.role", "node", "copies", "embedding", "cells")

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")  # the forest below then hangs nodes on smaller ones
        cell, role = table["cell"][0].as_py(), table["role"].to_numpy()
        node, copies = table["node"].to_numpy(), table["copies"].to_numpy()
        lists = table["cells"].combine_chunks()
        at, flat = lists.offsets.to_numpy() - lists.offsets[0].as_py(), lists.flatten().to_numpy()
        home, last = flat[at[:-1]], int(flat.max()) + 1
        goes = np.repeat(np.arange(len(node)), np.diff(at)) * last + flat  # row and cell that it is in
        x = _unit(table["embedding"].combine_chunks())
        left, right = np.flatnonzero(role != 1), np.flatnonzero(role != 0)
        n = np.zeros(len(node), np.int64)
        root = np.arange(len(node))

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        pairs = []
        for start in range(0, len(left), 512):
            some = left[start : start + 512]
            linked = x[some] @ x[right].T >= threshold
            # Each pair once: of two residents from the smaller, of a resident and a visitor in the lower cell if both meet in two.
            linked &= (home[right] != cell)[None] | (node[some][:, None] < node[right][None])
            i, j = np.nonzero(linked & (home[right] < cell)[None])
            twice = np.isin(some[i] * last + home[right[j]], goes)
            linked[i[twice], j[twice]] = False
            n[some] += linked @ copies[right]
            n[right] += copies[some] @ linked
            # A spanning forest of the block's links: only pairs that are not connected yet.
            while (apart := linked & (root[some][:, None] != root[right][None])).any():
                i = np.flatnonzero(apart.any(axis=1))
                for p, q in zip(some[i], right[apart[i].argmax(axis=1)]):
                    p, q = sorted((find(p), find(q)))
                    if p != q:
                        root[q] = p
                        pairs.append((node[p], node[q]))
                while (root[root] != root).any():
                    root = root[root]
        hit = np.flatnonzero(n)
        return pa.table({
            "node": pa.array(np.concatenate([node[hit], np.array([p for p, _ in pairs], np.int64)])),
            "n": pa.array(np.concatenate([n[hit], np.zeros(len(pairs), np.int64)])),
            "other": pa.array([None] * len(hit) + [int(q) for _, q in pairs], pa.int64()),
        })

    found = written(blocks.groupBy("cell", "a", "b").applyInArrow(compare, "node long, n long, other long"), "links")
    degrees = found.where("other is null").groupBy("node").agg(F.sum("n").alias("n"))
    return degrees, found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))


def near_duplicates(embeddings: DataFrame, threshold: float = 0.9, visits: int | None = None, exact: bool = False) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row a row of embeddings (vec_id, embedding, ...).

    Links are pairs with cosine >= threshold (double precision), found in k-means cells;
    see :func:`link_vectors` for what ``visits`` misses and ``exact``. Equal vectors are
    one node with a count. Vectors that are null, zero, or hold null or non-finite
    parts, and rows without a vec_id, link with nothing: n_links 0, component_id their
    own id. Vectors of another length than most link with nothing either. Rows that
    share a vec_id are other vectors to each other but one node of a component. kept
    is vec_id = component_id (false without an id). An empty table gives no rows.
    """
    e = embeddings.select("vec_id", "embedding").withColumn("_ok", valid("embedding") & F.col("vec_id").isNotNull())
    length = e.where("_ok").groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    length = length["d"] if length else 0
    e = e.withColumn("_ok", F.col("_ok") & (F.size("embedding") == length))
    key = [F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2")]
    good = e.where("_ok").select("vec_id", "embedding", *key)
    groups = written(good.groupBy("h1", "h2").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"), F.first("embedding").alias("embedding")), "vectors")
    if groups.isEmpty():
        return e.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    degrees, edges = link_vectors(groups.select("node", "copies", "embedding"), threshold, visits, exact)
    parts = connected_components(edges)
    of_group = groups.select("h1", "h2", "node", "copies").join(degrees, "node", "left").join(parts, "node", "left")
    of_group = of_group.select("h1", "h2", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n"), F.coalesce("component", "node").alias("component"))
    out = e.withColumn("h1", F.when(F.col("_ok"), key[0])).withColumn("h2", F.when(F.col("_ok"), key[1])).drop("embedding").join(of_group, ["h1", "h2"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def op8_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP8_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
r AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
m AS (SELECT x, min(y) AS y FROM r GROUP BY x), n AS (SELECT x, count(*) AS n FROM l GROUP BY x)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, least(e.vec_id, coalesce(m.y, e.vec_id)) AS component_id, e.vec_id = least(e.vec_id, coalesce(m.y, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN m ON m.x = e.vec_id LEFT JOIN n ON n.x = e.vec_id
"""
