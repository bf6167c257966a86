"""Registered queries without SQL, row by row against a plain recomputation that shares no code with the vectorised one."""

import bisect
import collections
import math
import re
import zlib

import pytest
from conftest import DATA

from pedigrove.llm import quality, queries, toxicity

MASK = (1 << 64) - 1


def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def labels(spark):
    return spark.read.parquet(f"{DATA}/labels.parquet")


def sigmoid(x):
    return 1 / (1 + math.exp(-x)) if x > -700 else 0.0


def bucket(h):
    h = ((h ^ (h >> 29)) * 0xBF58476D1CE4E5B9) & MASK
    return (h ^ (h >> 32)) % toxicity.BUCKETS


def buckets_of(word):
    """One n-gram after the other, then the word as a whole."""
    marked, found = f"<{word}>", []
    for n in (3, 4, 5):
        for i in range(len(marked) - n + 1):
            h = 14695981039346656037
            for c in marked[i : i + n]:
                h = ((h ^ ord(c)) * 1099511628211) & MASK
            found.append(bucket(h))
    whole = 0
    for i, c in enumerate(marked):
        power = pow(6364136223846793005, len(marked) - i + 1, 1 << 64)
        whole = (whole + ord(c) * power) & MASK
    return [*found, bucket(whole ^ 0x9E3779B97F4A7C15)]


def word_logit(model, word):
    at = buckets_of(word)
    mean = [sum(float(model.vectors[b, k]) for b in at) / len(at) for k in range(toxicity.DIM)]
    return sum(m * float(model.softmax[k, 1] - model.softmax[k, 0]) for k, m in enumerate(mean)) + float(model.bias[1] - model.bias[0])


def test_toxicity_query(spark):
    """Every row of op5: bags word by word, softmax, top words, both units."""
    model = toxicity.train(documents(spark), labels(spark))
    logits, want = {}, {}
    for r in documents(spark).collect():
        words = {w.strip(toxicity.AROUND) for w in (r.text or "").lower().split()} - {""}
        for w in words - logits.keys():
            logits[w] = word_logit(model, w)
        top = sorted([max(logits[w], toxicity.FLOOR) for w in words] + [toxicity.FLOOR] * toxicity.TOP, reverse=True)
        single, several = model.units
        units = top[0] * single[0] + single[1], sum(x * s for x, s in zip(top, several[:-1])) + several[-1]
        want[r.doc_id] = max(map(sigmoid, units))
    rows = queries.QUERIES["op5_toxicity"](spark, DATA).collect()
    assert len(rows) == len(want) and len(set(want.values())) > 20
    for r in rows:
        assert r.score == pytest.approx(want[r.doc_id], abs=1e-4), r.doc_id
        assert r.predicted == (r.score >= 0.7) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def plain_features(text):
    """quality.FEATURES of a text, byte by byte."""
    data = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    if not words:
        return [0.0] * len(quality.FEATURES)
    kinds = collections.Counter()
    for b in data:
        c = chr(b)
        kinds["upper"] += "A" <= c <= "Z"
        kinds["digit"] += "0" <= c <= "9"
        kinds["other"] += b > 127
        kinds["space"] += b < 128 and c.isspace()
        kinds["symbol"] += b < 128 and not c.isspace() and not c.isalnum() and c not in ".,"
    solid = len(data) - kinds["space"]
    lines = [x for x in data.split(b"\n") if re.search(rb"[^\x20\x09-\x0D]", x)]
    twice = sum(words[i] == words[i - 1] for i in range(1, len(words)))
    ended = sum(chr(w[-1]) in "!#$%&*|@^~+=<>{}[]\\/_-" for w in words)
    return [
        math.log(1 + len(words)), solid / len(words), kinds["upper"] / solid, kinds["symbol"] / solid, kinds["digit"] / solid, kinds["space"] / len(data), kinds["other"] / solid,
        len(set(words)) / len(words), twice / len(words), 1 - len(set(lines)) / len(lines), len(zlib.compress(data, 1)) / (len(data) + 20), len(words) / len(lines), ended / len(words),
    ]


def test_quality_query(spark):
    """Every row of op3: features byte by byte, tables looked up one by one."""
    model = quality.train(documents(spark), labels(spark))
    want = {}
    for r in documents(spark).collect():
        x = plain_features(r.text)
        assert x == pytest.approx(quality.features(r.text), rel=1e-9)
        # The same numbers as the query's, as a value next to an edge may fall to either side.
        x = quality.features(r.text)
        total = model.base + sum(t[bisect.bisect_right(list(e), v)] for t, e, v in zip(model.tables, model.edges, x))
        for i, j, t in model.pairs:
            total += t[bisect.bisect_right(list(model.coarse[i]), x[i]), bisect.bisect_right(list(model.coarse[j]), x[j])]
        want[r.doc_id] = sigmoid(total)
    rows = queries.QUERIES["op3_quality"](spark, DATA).collect()
    assert len(rows) == len(want) and len(set(want.values())) > 20
    for r in rows:
        assert r.score == pytest.approx(want[r.doc_id], abs=1e-9), r.doc_id
        assert r.predicted == (r.score >= 0.7) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def shared_out(sizes):
    """Targets by the contract's own words: share by weight, stop at twice a source's size, share the excess again."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, open_, left = dict.fromkeys(order, 0.0), set(order), 1.5 * sum(sizes.values())
    while open_ and left > 1e-9:
        level = left / sum(weight[s] for s in open_)
        for s in open_:
            target[s] += level * weight[s]
        left = sum(max(0.0, target[s] - 2 * sizes[s]) for s in open_)
        for s in [s for s in open_ if target[s] >= 2 * sizes[s]]:
            target[s] = 2.0 * sizes[s]
            open_.discard(s)
    return target


def test_mixing_query(spark):
    """Every row of op6: sizes, targets, whole copies next to the source's rate, sums next to the targets; reruns agree."""
    docs = {r.doc_id: r for r in documents(spark).collect()}
    sizes = collections.Counter()
    for r in docs.values():
        sizes[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    target, taken, largest = shared_out(sizes), collections.Counter(), collections.Counter()
    rows = queries.QUERIES["op6_mixing"](spark, DATA).collect()
    assert len(rows) == len(docs) and {r.doc_id for r in rows} == docs.keys()
    for r in rows:
        source = docs[r.doc_id].source
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", docs[r.doc_id].text or ""))
        assert r.source_size == sizes[source] and r.target == pytest.approx(target[source])
        rate = target[source] / sizes[source]
        assert r.taken in (math.floor(rate) * r["size"], math.ceil(rate) * r["size"]) and r.taken <= 2 * r["size"]
        taken[source] += r.taken
        largest[source] = max(largest[source], r["size"])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6
    assert sorted(map(str, queries.QUERIES["op6_mixing"](spark, DATA).collect())) == sorted(map(str, rows))
