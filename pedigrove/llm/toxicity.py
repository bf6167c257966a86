"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (3 to 5, with marks for its ends) and of
itself as a whole; the average of their vectors goes into a linear softmax with two
outcomes. Vectors and softmax are trained together. n-grams are hashed to a fixed
number of buckets, so a misspelling that was never seen still shares most of its
vectors. A text is as toxic as its most toxic words: its highest logit alone and its TOP
highest together each go into a logistic unit, and the higher of the two is the score.
So they count in a long text as much as in a short one, and one clear word is enough. Labels are of texts, so training alternates: in a
toxic text only the words that the model holds toxic by now (at least its top one)
count as toxic, the others as clean.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._common import in_batches
from ._labels import labelled_sample, scored

FOLDS, HELD_OUT = 3, 1
#: Labelled rows of either class that the model is fitted on at most.
SAMPLE = 3000
BUCKETS, DIM = 1 << 16, 8
#: What stands around a word and is not part of it.
AROUND = " \t\n\r\x0b\x0c.,;:!?\"'()[]{}<>|*#$%&/\\+=~^_`-…“”„«»¿¡"
#: Words whose n-grams are worked on at once while fitting; fits 16 bits.
CHUNK = 20_000
#: Words that a text's score is made of, and the lowest logit that counts.
TOP, FLOOR = 3, -6.0
#: Words of a worker's cache.
CACHE = 300_000


def words_of(text: str | None) -> list[str]:
    """Distinct words of a text, in lower case, without signs around them."""
    return list({w for w in (x.strip(AROUND) for x in set((text or "").lower().split())) if w})


def subwords(words: list[str], shortest: int = 3, longest: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words' n-grams, one after the other, and where each word's begin."""
    code = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    size = np.array([len(w) + 2 for w in words])
    end = np.cumsum(size)
    word = np.repeat(np.arange(len(words)), size)
    left = end[word] - np.arange(len(code))  # code points up to the word's end
    p, hashes, owners = np.uint64(1099511628211), [], []
    h = np.full(len(code), np.uint64(14695981039346656037))
    for n in range(1, min(longest, len(code)) + 1):
        h[: len(code) - n + 1] = (h[: len(code) - n + 1] ^ code[n - 1 :]) * p
        if n >= shortest:
            ok = np.flatnonzero(left >= n)
            hashes.append(h[ok])
            owners.append(word[ok])
    # The word as a whole: a sum over its places, unlike any n-gram's hash.
    power = np.cumprod(np.full(int(size.max()) + 1, np.uint64(6364136223846793005)))
    whole = np.add.reduceat(code * power[left], end - size) ^ np.uint64(0x9E3779B97F4A7C15)
    h, owner = np.concatenate([*hashes, whole]), np.concatenate([*owners, np.arange(len(words))])
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    order = np.argsort(owner, kind="stable")
    bucket = ((h ^ (h >> np.uint64(32))) % np.uint64(BUCKETS)).astype(np.int64)[order]
    return bucket, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(words)))[:-1]])


@dataclass
class ToxicityModel:
    vectors: np.ndarray  # BUCKETS x DIM
    softmax: np.ndarray  # DIM x 2
    bias: np.ndarray  # 2
    units: tuple[np.ndarray, np.ndarray]  # of the top word alone and of all TOP: slopes and shift

    def __post_init__(self):
        self.cache: dict[str, float] = {}

    def word_logits(self, words: list[str]) -> np.ndarray:
        bucket, at = subwords(words)
        out = _bags(self.vectors, bucket, at) @ self.softmax + self.bias
        return out[:, 1] - out[:, 0]

    def top_logits(self, texts: list[str | None]) -> np.ndarray:
        """The TOP highest logits of each text's distinct words; FLOOR where there are fewer."""
        bags = [words_of(t) for t in texts]
        new = list({w for b in bags for w in b if w not in self.cache})
        if len(self.cache) + len(new) > CACHE:
            self.cache = {}
            new = list({w for b in bags for w in b})
        for i in range(0, len(new), 20_000):
            self.cache.update(zip(new[i : i + 20_000], self.word_logits(new[i : i + 20_000]).tolist()))
        return np.array([_top([self.cache[w] for w in b]) for b in bags]).reshape(-1, TOP)

    def score(self, texts: list[str | None]) -> np.ndarray:
        top = self.top_logits(texts)
        return np.maximum(*(_sigmoid(top[:, : len(u) - 1] @ u[:-1] + u[-1]) for u in self.units))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _top(logits) -> np.ndarray:
    return np.sort(np.append(np.maximum(logits, FLOOR), [FLOOR] * TOP))[::-1][:TOP]


def _unit(x: np.ndarray, want: np.ndarray, of_toxic: float, steps: int = 4000) -> np.ndarray:
    """A logistic unit of x with slopes >= 0 (no word makes a text less toxic), then its shift; of_toxic: the toxic texts' weight of 1."""
    w = np.where(want == 1, of_toxic / max(1, want.sum()), (1 - of_toxic) / max(1, (1 - want).sum()))
    slopes, shift = np.full(x.shape[1], 1 / x.shape[1]), 0.0
    for _ in range(steps):
        d = w * (_sigmoid(x @ slopes + shift) - want)
        slopes, shift = np.maximum(slopes - 0.1 * (x.T @ d + 0.002 * slopes), 0.0), shift - 0.5 * d.sum()
    return np.append(slopes, shift)


def _bags(vectors: np.ndarray, bucket: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Mean vector of each word, one dimension at a time so that little is held."""
    counts = np.diff(np.append(at, len(bucket))).astype(np.float32)
    return np.stack([np.add.reduceat(v[bucket], at) / counts for v in vectors.T], axis=1)


def _chunk(words: list[str]) -> tuple[np.ndarray, ...]:
    """A chunk's n-grams for fitting, in 16 bits each: buckets by word, where words begin, their sizes; words by bucket, buckets, where they begin."""
    bucket, at = subwords(words)
    counts = np.diff(np.append(at, len(bucket)))
    order = np.argsort(bucket, kind="stable")
    used, first = np.unique(bucket[order], return_index=True)
    owner = np.repeat(np.arange(len(words), dtype=np.uint16), counts)[order]
    return bucket.astype(np.uint16), at, counts, owner, used.astype(np.uint16), first.astype(np.int32)


def fit(texts: list[np.ndarray], toxic: np.ndarray, vocabulary: pa.Array, epochs: int = 16, turns: int = 3, rate: float = 0.3, prior: float = 3.0, seed: int = 0) -> ToxicityModel:
    """Trains on texts (numbers of their distinct words) and labels; a fifth of the texts sets slope and shift."""
    rng = np.random.default_rng(seed)
    vectors = np.asfortranarray(rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32))
    model = ToxicityModel(vectors, rng.normal(0, 0.5, (DIM, 2)), np.zeros(2), (np.zeros(2), np.zeros(TOP + 1)))
    if len(np.unique(toxic)) < 2 or not any(map(len, texts)):
        return ToxicityModel(np.zeros((BUCKETS, DIM), np.float32), np.zeros((DIM, 2)), np.zeros(2), (np.zeros(2), np.zeros(TOP + 1)))
    aside = np.arange(len(texts)) % 5 == 0
    if len(np.unique(toxic[aside])) < 2 or len(np.unique(toxic[~aside])) < 2:
        aside[:] = False
    learned = [(t, z) for t, z, a in zip(texts, toxic, aside) if not a]
    # Every word of the sampled rows is learned from: SAMPLE is the only bound.
    often = np.bincount(np.concatenate([t for t, _ in learned]), minlength=len(vocabulary))
    known = np.flatnonzero(often)
    number = np.full(len(vocabulary), -1)
    number[known] = np.arange(len(known))
    toxic_rows = [r[r >= 0] for r in (number[t] for t, z in learned if z)]
    toxic_rows = [r for r in toxic_rows if len(r)]
    seen = often[known]
    chunks = [_chunk(vocabulary.take(pa.array(known[i : i + CHUNK])).to_pylist()) for i in range(0, len(known), CHUNK)]
    squares = [np.full(BUCKETS, 1e-8), np.full((DIM, 2), 1e-8), np.full(2, 1e-8)]
    blame = np.bincount(np.concatenate(toxic_rows or [np.zeros(0, np.int64)]), minlength=len(known)).astype(float)
    base = 0.02
    for _ in range(turns):
        target = (blame + base * prior) / (seen + prior)
        weight = np.sqrt(seen + prior)
        weight = weight / weight.mean()
        for _ in range(epochs):
            grad, steps = np.zeros((BUCKETS, DIM), np.float32), [np.zeros((DIM, 2)), np.zeros(2)]
            for i, (bucket, at, counts, owner, used, first) in enumerate(chunks):
                some = slice(i * CHUNK, i * CHUNK + len(at))
                bags = _bags(vectors, bucket, at)
                logits = bags @ model.softmax + model.bias
                p = _sigmoid(logits[:, 1] - logits[:, 0])
                d = (weight[some] * (p - target[some]))[:, None] * np.array([[-1.0, 1.0]])  # gradient of the softmax's two outputs
                back = (d @ model.softmax.T / counts[:, None]).astype(np.float32)
                grad[used] += np.stack([np.add.reduceat(b[owner], first) for b in np.ascontiguousarray(back.T)], axis=1)
                steps[0] += bags.T @ d
                steps[1] += d.sum(0)
            squares[0] += (grad**2).mean(1)
            vectors -= rate * grad / np.sqrt(squares[0])[:, None].astype(np.float32)
            for value, square, g in ((model.softmax, squares[1], steps[0] / len(known)), (model.bias, squares[2], steps[1] / len(known))):
                square += g**2
                value -= 0.1 * rate * g / np.sqrt(square)
        logit = np.empty(len(known))
        for i, (bucket, at, *_) in enumerate(chunks):
            logits = _bags(vectors, bucket, at) @ model.softmax + model.bias
            logit[i * CHUNK : i * CHUNK + len(at)] = logits[:, 1] - logits[:, 0]
        blame[:] = 0
        for r in toxic_rows:
            blame[r[logit[r] >= min(0.0, logit[r].max())]] += 1
    # The last units, on texts that no word was learned from.
    held = [i for i in range(len(texts)) if aside[i] or not aside.any()]
    words = np.unique(np.concatenate([texts[i] for i in held]))
    of_word = np.full(len(vocabulary), FLOOR)
    for some in np.array_split(words, len(words) // 20_000 + 1):
        if len(some):
            of_word[some] = model.word_logits(vocabulary.take(pa.array(some)).to_pylist())
    x = np.array([_top(of_word[texts[i]]) for i in held])
    model.units = _unit(x[:, :1], toxic[held], 0.2), _unit(x, toxic[held], 0.35)
    return model


def train(documents: DataFrame, labels: DataFrame, most: int = SAMPLE) -> ToxicityModel:
    """The model of labels.toxic, from at most 2 * most labelled rows outside the held-out fold."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([sorted(words_of(t.as_py())) for t in batch.column(1)], pa.list_(pa.string()))], names=["doc_id", "y", "words"])

    rows = labelled_sample(documents, labels, "toxic", most, FOLDS, HELD_OUT).mapInArrow(split, "doc_id long, y int, words array<string>").toArrow()
    rows = rows.sort_by([("doc_id", "ascending"), ("y", "ascending")])
    words = rows["words"].combine_chunks()
    coded = words.flatten().dictionary_encode()
    return fit(np.split(coded.indices.to_numpy(), words.offsets.to_numpy()[1:-1] - words.offsets[0].as_py()) if len(words) else [], rows["y"].to_numpy(), coded.dictionary)


def score_toxicity(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, held_out, score, predicted: every row, by its whole text alone.

    A null or empty text, or one of signs only, gets the score of no words, next to 0.
    Repeated rows and null ids are rows like others (a null id is not held out); no rows
    give no rows. Where there is no label to learn from, every score is 0.5.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_batches(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(model.score(part.column(1).to_pylist()))], names=["doc_id", "score"])

    return scored(documents.select("doc_id", "text").mapInArrow(task, "doc_id long, score double"), FOLDS, HELD_OUT)


def drop_toxic(documents: DataFrame, model: ToxicityModel, threshold: float = 0.7) -> DataFrame:
    """documents without the rows that score at the threshold or more; all columns stay.

    Null and empty texts score next to 0 and stay; repeated rows stay or go together;
    null ids are ids like others; an empty table gives an empty one. Where there is no
    label to learn from, every score is 0.5 and all rows stay.
    """
    text = documents.columns.index("text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_batches(batches):
            yield part.filter(pa.array(model.score(part.column(text).to_pylist()) < threshold))

    return documents.mapInArrow(task, documents.schema)


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_toxicity(documents, train(documents, spark.read.parquet(f"{sf_dir}/labels.parquet")))
