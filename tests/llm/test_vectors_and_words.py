"""Hard negatives, top-k search and spelling variants against brute force in plain Python."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import DATA

from pedigrove.llm import hard_negatives, queries, spelling, topk_search


def ints(v):
    return [int(np.floor(256 * float(x))) for x in v]


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def usable(rows, size):
    return [r for r in rows if r[0] is not None and r[1] is not None and len(r[1]) == size and all(x is not None and np.isfinite(x) for x in r[1]) and dot(ints(r[1]), ints(r[1])) < 2**61]


def odd_vectors(rng, n, size=6):
    """Ids with ties and repeats, copies of a vector, zeros, negative ids; and rows that take no part."""
    v = rng.integers(-3, 4, (n, size)) / 4
    v[n // 3 : n // 2] = v[0]
    rows = [(i * 25 - 300, [float(x) for x in v[i]], int(rng.integers(0, 3))) for i in range(n)]
    rows += [rows[5], rows[8], (0, [0.5] * size, 1), (1, [0.0] * size, 0), (50, [2.0**20] * size, 2), (51, [-(2.0**20)] * size, 1)]
    rows += [(None, rows[0][1], 1), (7, None, 1), (8, [None] * size, 1), (9, [float("nan")] * size, 1), (10, [float("inf")] + [0.0] * (size - 1), 1), (100, [1.0], 0), (200, [], 0), (11, [2.0**40] * size, 1)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "'x' as score", "1 as cell", "2 as a", "3 as rank")


def mined(rows, size):
    """(anchor, positive, rank, negative, scores) by comparing all."""
    rows = [(i, ints(v), y) for i, v, y in usable(rows, size) if y is not None]
    anchors = {}
    for i, v, y in rows:
        if i % 100 == 0:
            anchors[i] = min(anchors.get(i, (y, v)), (y, v))
    out = []
    for i, (y, v) in anchors.items():
        scored = sorted((-dot(v, w), j, z) for j, w, z in rows if j != i)
        for s, j, _ in [x for x in scored if x[2] == y][:5]:
            held = [x for x in scored if x[2] != y and 80 * -s <= 100 * -x[0] <= 100 * -s][:5]
            out += [(i, j, k + 1, x[1], -s, -x[0]) for k, x in enumerate(held)]
    return sorted(out)


@pytest.mark.parametrize("block", [1 << 19, 60])
def test_hard_negatives(spark, monkeypatch, block):
    monkeypatch.setattr(hard_negatives, "BLOCK_VALUES", block)
    rows = odd_vectors(np.random.default_rng(1), 90) + [(300, [0.25] * 6, None)]
    got = hard_negatives.mine(frame(spark, rows).repartition(3))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == mined(rows, 6)
    if block == 60:
        assert hard_negatives.mine(frame(spark, []).limit(0)).isEmpty() and hard_negatives.mine(frame(spark, rows[:1])).isEmpty()


@pytest.mark.parametrize("high, size", [(2, 3), (256, 64), (2**20, 300), (2**28, 63)])
def test_products_are_exact(high, size):
    rng = np.random.default_rng(high)
    a, b = rng.integers(-high, high, (40, size)), rng.integers(-high, high, (50, size))
    bound = max((x.astype(float) ** 2).sum(1).max() for x in (a, b))
    primes = hard_negatives.primes_for(bound)
    assert (hard_negatives.products(hard_negatives.residues(a, primes), hard_negatives.residues(b, primes), primes) == a @ b.T).all()


def searched(rows, size, every=50):
    rows = [(i, ints(v)) for i, v, _ in usable(rows, size)]
    asked = {}
    for i, v in rows:
        if i % every == 0:
            asked[i] = min(asked.get(i, v), v)
    return sorted((i, k + 1, j, -s) for i, v in asked.items() for k, (s, j) in enumerate(sorted((-dot(v, w), j) for j, w in rows if j != i)[:5]))


@pytest.mark.parametrize("block, sample, pivots", [(1 << 19, 1 << 19, 512), (60, 600, 512), (60, 1, 5)])
def test_topk_search(spark, monkeypatch, block, sample, pivots):
    for name, value in (("BLOCK_VALUES", block), ("SAMPLE_VALUES", sample), ("PIVOTS", pivots)):
        monkeypatch.setattr(topk_search, name, value)
    rows = odd_vectors(np.random.default_rng(2), 120)
    got = topk_search.search(frame(spark, rows).repartition(3))
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == searched(rows, 6)
    if pivots == 5:
        assert topk_search.search(frame(spark, []).limit(0)).isEmpty() and topk_search.search(frame(spark, rows[:1])).isEmpty()
        assert topk_search.search(frame(spark, [r for r in rows if r[0] in (25, 75)])).isEmpty()  # no query


def test_topk_search_skips_far_cells(spark, monkeypatch):
    """Tight groups of vectors: the same results, and far fewer rows are sent than all to each group of queries."""
    from pyspark.sql import functions as F

    for name, value in (("BLOCK_VALUES", 8 * 16), ("PIVOTS", 40)):
        monkeypatch.setattr(topk_search, name, value)
    rng = np.random.default_rng(3)
    middle = rng.normal(size=(30, 8))
    middle /= np.linalg.norm(middle, axis=1)[:, None]
    rows = [(i * 10, [float(x) for x in middle[i % 30] + rng.normal(size=8) * 0.01], 0) for i in range(600)]
    sent = []
    union = type(frame(spark, rows)).unionByName
    monkeypatch.setattr(type(frame(spark, rows)), "unionByName", lambda a, b, **more: sent.append((a, b)) or union(a, b, **more))
    assert sorted(map(tuple, topk_search.search(frame(spark, rows)).collect())) == searched(rows, 8)
    left, right = sent[-1]
    groups = left.select("g").distinct().count()
    assert groups > 4 and right.select("g", "q", "d", "vec_id").where(F.col("q") == 0).count() < 0.5 * groups * len(rows)


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_topk_search"])
def test_queries_equal_sql(spark, same, name):
    same(queries.QUERIES[name](spark, DATA), queries.SQL[name])


def is_near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(a == b[:k] + b[k + 1 :] for k in range(len(b)))


def grouped(counts, near=is_near):
    """(word, form, root, n, n_near, form_n) by comparing all."""
    forms, out = {}, []
    for w, n in counts.items():
        beside = [v for v in counts if near(w, v)]
        best = min(beside, key=lambda v: (-counts[v], v), default=None)
        forms[w] = (best if best and counts[best] >= 5 * n else None, len(beside))
    for w, n in counts.items():
        root = w
        while forms[root][0]:
            root = forms[root][0]
        out.append((w, forms[w][0], root, n, forms[w][1], counts.get(forms[w][0])))
    return sorted(out, key=str)


def counted(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc}:{run}".encode()) if doc is not None else 1
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 6
    return {w: n for w, n in counts.items() if n >= 5 and len(w) >= 6}


@pytest.mark.parametrize("block", [4096, 8])
def test_near_words(spark, monkeypatch, block):
    """Letters that repeat, chains of forms, ties, long words, a place of many words, code points beyond ASCII."""
    monkeypatch.setattr(spelling, "BLOCK_ROWS", block)
    rng = np.random.default_rng(4)
    words = {"".join(rng.choice(list("abé"), rng.integers(6, 9))) for _ in range(150)} | {"common" + x for x in "abcdefghij"} | {x + "tion" for x in ("sta", "ra", "na", "mo", "lo", "stal")}
    words |= {"aaaaaa", "aaaaaaa", "aaaaaaaa", "x" * 3000, "x" * 3001, "x" * 2999 + "y", "ÿÿÿÿÿÿ", "ÿÿÿÿÿÀ"}
    words |= {"abcdefg", "abcdefgh", "abcdefghi", "abcdefghij"}
    counts = {w: int(rng.integers(1, 2000)) for w in sorted(words)} | {"abcdefg": 1, "abcdefgh": 5, "abcdefghi": 25, "abcdefghij": 125}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = spelling.variants(df).select("word", "form", "root", "n", "n_near", "form_n")
    want = grouped(counts)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert ("abcdefg", "abcdefgh", "abcdefghij", 1, 1, 5) in want


def test_one_edit_equals_brute_force():
    rng = np.random.default_rng(5)
    words = sorted({"".join(rng.choice(list("ab"), rng.integers(6, 8))) for _ in range(120)})
    near, _ = spelling.one_edit(words, words)
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            assert a == b or near[i, j] == is_near(a, b)


def test_spelling_variants(spark):
    """Whole query on odd rows: nulls, no letters, repeats, upper case, other letters, letters lost by the checksum."""
    base = ["Frobnicate the WIDGETS, frobnicate!", None, "", "123 --", "ÀÉÎÕÜß ÀÉÎÕÜß", "x" * 5000, "widget widgets wid-gets frobnicates"]
    rows = [(d, base[d % 7]) for d in range(3000)] + [(None, "frobnicate widgets")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'y' as word", "1 as n", "2 as run")
    got = sorted(map(tuple, spelling.spelling_variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)
    want = grouped(counted(rows))
    assert got == want and {w[0]: w[4] for w in want}["frobnicate"] >= 1
    assert spelling.spelling_variants(df.limit(0)).isEmpty()


def test_query_of_words_equals_brute_force(spark, duck):
    counts = counted(duck.sql("select doc_id, text from documents").fetchall())
    # Near words are found by what is left when a letter is dropped, each verified.
    drops = {}
    for w in counts:
        for k in range(len(w)):
            drops.setdefault(w[:k] + w[k + 1 :], set()).add(w)
    beside = {w: {w[:k] + w[k + 1 :] for k in range(len(w))} & counts.keys() | drops.get(w, set()) | {v for k in range(len(w)) for v in drops[w[:k] + w[k + 1 :]]} for w in counts}
    want = []
    forms = {w: min((v for v in beside[w] if is_near(w, v)), key=lambda v: (-counts[v], v), default=None) for w in counts}
    forms = {w: v if v and counts[v] >= 5 * counts[w] else None for w, v in forms.items()}
    for w in counts:
        root = w
        while forms[root]:
            root = forms[root]
        want.append((w, forms[w], root, counts[w], sum(is_near(w, v) for v in beside[w]), counts.get(forms[w])))
    got = queries.QUERIES["op13_spelling_variants"](spark, DATA).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str) and len(want) > 100
