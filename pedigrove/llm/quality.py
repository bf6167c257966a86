"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature of a text falls in a bin; a lookup table a feature and one a chosen pair
of features hold what a bin adds to the logit. The tables are learned by cyclic
boosting: in turn, each feature gets a shallow tree over its bins, fitted to what the
model still misses and added with a small rate. Then the pairs whose best four-way cut
gains most get tables of their own in the same way.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._common import in_batches
from ._labels import labelled_sample, scored

FOLDS, HELD_OUT = 4, 2
#: Labelled rows of either class that the model is fitted on at most.
SAMPLE = 8000

FEATURES = (
    "log_words", "word_length", "upper_share", "symbol_share", "digit_share", "space_share", "other_share",
    "distinct_words", "same_as_before", "repeated_lines", "compression", "words_a_line", "symbol_words",
)

_CLASS = np.zeros((256, 5))
for _i in range(256):
    _c = chr(_i)
    _CLASS[_i] = (65 <= _i <= 90, _i < 128 and not _c.isalnum() and not _c.isspace() and _c not in ".,", 48 <= _i <= 57, _i < 128 and _c.isspace(), _i >= 128)
_SYMBOLS = tuple(bytes([c]) for c in b"!#$%&*|@^~+=<>{}[]\\/_-")


def features(text: str | None) -> tuple[float, ...]:
    """FEATURES of a whole text; a null or empty one has zeros."""
    data = (text or "").encode()
    words = data.split()
    if not words:
        return (0.0,) * len(FEATURES)
    n, size = len(words), len(data)
    upper, symbols, digits, space, other = (np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _CLASS).tolist()
    solid = size - space
    lines = [x for x in data.split(b"\n") if x.strip()]
    return (
        float(np.log1p(n)),
        solid / n,
        upper / solid,
        symbols / solid,
        digits / solid,
        space / size,
        other / solid,
        len(set(words)) / n,
        sum(map(eq, words, words[1:])) / n,
        1 - len(set(lines)) / len(lines),
        len(zlib.compress(data, 1)) / (size + 20),
        n / len(lines),
        sum(w.endswith(_SYMBOLS) for w in words) / n,
    )


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _tree(g: np.ndarray, h: np.ndarray, depth: int, ridge: float, least: float) -> np.ndarray:
    """Leaf values over the bins of one feature: a tree of the given depth on sums of gradients and Hessians."""
    value = np.full(len(g), -g.sum() / (h.sum() + ridge))
    if depth == 0 or len(g) < 2:
        return value
    cg, ch = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = cg**2 / (ch + ridge) + (g.sum() - cg) ** 2 / (h.sum() - ch + ridge)
    gain[(ch < least) | (h.sum() - ch < least)] = -1
    cut = int(gain.argmax()) + 1
    if gain[cut - 1] <= g.sum() ** 2 / (h.sum() + ridge) + 1e-9:
        return value
    return np.concatenate([_tree(g[:cut], h[:cut], depth - 1, ridge, least), _tree(g[cut:], h[cut:], depth - 1, ridge, least)])


def _quadrants(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """Gain and leaf values of the best cut of a pair's bins into four."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    total, weight = cg[-1, -1], ch[-1, -1]
    parts = []
    for c in (cg, ch):
        a = c[:-1, :-1]
        left, top = c[:-1, -1:], c[-1:, :-1]
        parts.append((a, left - a, top - a, c[-1, -1] - left - top + a))
    gain = sum(x**2 / (y + ridge) for x, y in zip(*parts)) - total**2 / (weight + ridge)
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    leaf = [-x[i, j] / (y[i, j] + ridge) for x, y in zip(*parts)]
    value = np.empty_like(g)
    value[: i + 1, : j + 1], value[: i + 1, j + 1 :], value[i + 1 :, : j + 1], value[i + 1 :, j + 1 :] = leaf
    return float(gain[i, j]), value


@dataclass
class AdditiveModel:
    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def logit(self, x: np.ndarray) -> np.ndarray:
        """Adds up the bins of all rows."""
        out = np.full(len(x), self.base)
        for j, table in enumerate(self.tables):
            out += table[np.searchsorted(self.edges[j], x[:, j], "right")]
        for i, j, table in self.pairs:
            out += table[np.searchsorted(self.coarse[i], x[:, i], "right"), np.searchsorted(self.coarse[j], x[:, j], "right")]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logit(x))


def fit(x: np.ndarray, y: np.ndarray, bins: int = 48, pair_bins: int = 12, rounds: int = 120, n_pairs: int = 6, rate: float = 0.12, ridge: float = 4.0) -> AdditiveModel:
    """Fits the tables; without both labels the model is a constant."""
    m = AdditiveModel()
    rate_of_ones = (y.sum() + 0.5) / (len(y) + 1)
    m.base = float(np.log(rate_of_ones / (1 - rate_of_ones)))
    if len(np.unique(y)) < 2:
        return m
    cuts = lambda n, v: np.unique(np.quantile(v, np.linspace(0, 1, n + 1)[1:-1]))
    m.edges = [cuts(bins, v) for v in x.T]
    m.coarse = [cuts(pair_bins, v) for v in x.T]
    binned = [np.searchsorted(e, v, "right") for e, v in zip(m.edges, x.T)]
    coarse = [np.searchsorted(e, v, "right") for e, v in zip(m.coarse, x.T)]
    m.tables = [np.zeros(len(e) + 1) for e in m.edges]
    f = np.full(len(y), m.base)
    for _ in range(rounds):
        for b, table in zip(binned, m.tables):
            p = _sigmoid(f)
            step = rate * _tree(np.bincount(b, p - y, len(table)), np.bincount(b, p * (1 - p), len(table)), 2, ridge, 1e-3)
            table += step
            f += step[b]

    def grid(i, j, v):
        shape = len(m.coarse[i]) + 1, len(m.coarse[j]) + 1
        return np.bincount(coarse[i] * shape[1] + coarse[j], v, shape[0] * shape[1]).reshape(shape)

    p = _sigmoid(f)
    able = [i for i in range(x.shape[1]) if len(m.coarse[i])]
    gains = sorted(((_quadrants(grid(i, j, p - y), grid(i, j, p * (1 - p)), ridge)[0], i, j) for i in able for j in able if i < j), reverse=True)
    m.pairs = [(i, j, np.zeros((len(m.coarse[i]) + 1, len(m.coarse[j]) + 1))) for _, i, j in gains[:n_pairs]]
    for _ in range(rounds // 2):
        for i, j, table in m.pairs:
            p = _sigmoid(f)
            step = rate * _quadrants(grid(i, j, p - y), grid(i, j, p * (1 - p)), ridge)[1]
            table += step
            f += step[coarse[i], coarse[j]]
    return m


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(t.as_py()) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "y", "x"])


def train(documents: DataFrame, labels: DataFrame, most: int = SAMPLE) -> AdditiveModel:
    """The model of labels.quality, from at most 2 * most labelled rows outside the held-out fold."""
    rows = labelled_sample(documents, labels, "quality", most, FOLDS, HELD_OUT).mapInArrow(_measure, "doc_id long, y int, x array<double>").toArrow()
    if not rows.num_rows:
        return AdditiveModel()
    rows = rows.sort_by([("doc_id", "ascending"), ("y", "ascending")])
    x = rows["x"].combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES))
    return fit(x, rows["y"].to_numpy().astype(float))


def score_quality(documents: DataFrame, model: AdditiveModel) -> DataFrame:
    """doc_id, held_out, score, predicted: every row, by its whole text alone.

    Null and empty texts get the score of a text of all-zero features. Repeated rows and
    null ids are rows like others (a null id is not held out); no rows give no rows.
    Where there is no labelled row to learn from, every score is the prior of 0.5.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_batches(batches):
            x = np.array([features(t.as_py()) for t in batch.column(1)]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], names=["doc_id", "score"])

    return scored(documents.select("doc_id", "text").mapInArrow(task, "doc_id long, score double"), FOLDS, HELD_OUT)


def keep_good(documents: DataFrame, model: AdditiveModel, threshold: float = 0.7) -> DataFrame:
    """documents without the rows that score under the threshold; all columns stay.

    Null and empty texts have the score of all-zero features and mostly go; repeated
    rows stay or go together; null ids are ids like others; an empty table gives an
    empty one. Where there are not both labels to learn from, nothing can be told and all rows stay.
    """
    if not model.tables:
        return documents
    columns = documents.columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_batches(batches):
            x = np.array([features(t.as_py()) for t in batch.column(columns.index("text"))]).reshape(-1, len(FEATURES))
            yield batch.filter(pa.array(model.score(x) >= threshold))

    return documents.mapInArrow(task, documents.schema)


def op3_quality(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_quality(documents, train(documents, spark.read.parquet(f"{sf_dir}/labels.parquet")))
