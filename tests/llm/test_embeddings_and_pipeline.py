import numpy as np
import pytest
from conftest import DATA

from pedigrove.llm import embedding_dedup


def brute(rows):
    """vec_id, n_links, component_id, kept by comparing all pairs; vectors of the usual length only."""
    good = [i for i, (d, v) in enumerate(rows) if d is not None and v is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    x = np.array([rows[i][1] for i in good], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    low = np.array([rows[i][0] for i in good])
    same = low[:, None] == low[None]
    for _ in range(len(good)):
        low = np.minimum(low, np.where(near | same, low[None], low.max()).min(1))
    out = [(d, 0, d, d is not None) for d, _ in rows]
    for k, i in enumerate(good):
        out[i] = (rows[i][0], int(near[k].sum()), int(low[k]), rows[i][0] == low[k])
    return sorted(out, key=str)


def test_near_duplicates(spark, monkeypatch):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(40, 8))
    vectors = np.concatenate([base, base[:20] + rng.normal(size=(20, 8)) * 0.25, np.repeat(base[:1], 30, 0) + rng.normal(size=(30, 8)) * 0.05, np.repeat(base[2:3], 9, 0), base[3:5] * 7])
    rows = [(i * 31 % 997, [float(np.float32(y)) for y in v]) for i, v in enumerate(vectors)]
    rows += [(2000, None), (2001, [0.0] * 8), (2002, [1.0, None] + [0.0] * 6), (2003, [float("nan")] * 8), (2004, [float("inf")] + [0.0] * 7), (2005, [1.0]), (None, rows[0][1]), (2006, rows[0][1]), (2006, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'x' as node", "1 as cell")
    want = brute(rows)
    assert sorted((tuple(r) for r in embedding_dedup.near_duplicates(df).collect()), key=str) == want
    # Many cells and small blocks give the same, with every cell that can hold a partner visited or simply all.
    monkeypatch.setattr(embedding_dedup, "CELL_ROWS", 6)
    monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", 8)
    for way in ({"exact": True}, {"visits": 1000}):
        assert sorted((tuple(r) for r in embedding_dedup.near_duplicates(df.repartition(5), **way).collect()), key=str) == want
    assert embedding_dedup.near_duplicates(df.limit(0)).isEmpty()
    assert sorted((tuple(r) for r in embedding_dedup.near_duplicates(df.where("vec_id = 2001")).collect()), key=str) == [(2001, 0, 2001, True)]


def planted(n, cosine, dim=64, seed=3):
    """n random unit vectors, then one partner of each at the given cosine."""
    rng = np.random.default_rng(seed)
    x, z = rng.normal(size=(2, n, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    z -= (z * x).sum(1)[:, None] * x
    z /= np.linalg.norm(z, axis=1)[:, None]
    return np.concatenate([x, cosine * x + np.sqrt(1 - cosine**2) * z])


@pytest.mark.parametrize("codebook, directions", [(1024, False), (16, True)])
def test_recall_near_the_threshold(monkeypatch, codebook, directions):
    """Pairs just above 0.9 and at 0.95 in 64 dimensions, with cells of one codebook and of two: met in some cell."""
    monkeypatch.setattr(embedding_dedup, "CODEBOOK", codebook)
    for cosine, least in ((0.9001, 0.99), (0.95, 0.998)):
        x = planted(4000, cosine)
        cells = embedding_dedup.fit(x[::2], 160)
        assert (cells.directions is not None) == directions and len(cells) >= 160
        to = cells.nearest(x, 1 + embedding_dedup.VISITS * (embedding_dedup.WIDER if directions else 1))
        a, b = to[:4000], to[4000:]
        met = (a[:, :1] == b).any(1) | (b[:, :1] == a).any(1)
        assert met.mean() >= least


def test_planted_links_are_found(spark, monkeypatch):
    """3,000 links in 64 dimensions over many cells: the default way against all pairs, and none below the threshold."""
    monkeypatch.setattr(embedding_dedup, "CELL_ROWS", 32)
    x = np.concatenate([planted(1500, 0.901), planted(1500, 0.96, seed=4), planted(500, 0.899, seed=5)])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    exact = {r.vec_id: r for r in embedding_dedup.near_duplicates(df, exact=True).collect()}
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df).collect()}
    assert sum(r.n_links for r in exact.values()) == 2 * 3000
    assert all(r.n_links <= exact[i].n_links for i, r in got.items())
    assert sum(r.n_links for r in got.values()) >= 0.99 * 6000
    assert all(r.component_id in (r.vec_id, exact[r.vec_id].component_id) for r in got.values())


def test_pipeline(spark):
    import corpus_pipeline as c
    from pedigrove.llm import _common, ngram_jaccard, quality, toxicity

    first = docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    kept = {}
    for name, stage in c.STAGES:
        docs = _common.written(stage(spark, docs, DATA), name)
        kept[name] = docs
        assert name == "packing" or docs.columns == first.columns
    ids = lambda df: {r[0] for r in df.select("doc_id").collect()}
    toxic = ids(toxicity.score_toxicity(first, toxicity.train(first, labels)).where("predicted = 1"))
    assert ids(kept["toxicity"]) == ids(first) - toxic
    bad = ids(quality.score_quality(kept["toxicity"], quality.train(kept["toxicity"], labels)).where("predicted = 0"))
    assert ids(kept["quality"]) == ids(kept["toxicity"]) - bad
    groups = ngram_jaccard.similar_components(kept["quality"]).collect()
    assert ids(kept["near_duplicates"]) == {r.component_id for r in groups}
    assert ids(kept["mixing"]) <= ids(kept["near_duplicates"]) and ids(kept["packing"]) == ids(kept["mixing"])
    rows = c.run(spark, DATA)
    assert rows.columns == kept["packing"].columns and rows.count() > 0


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Null, empty and repeated rows, null ids, columns that are not the documents' own, an empty table: through all stages."""
    import corpus_pipeline as c
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(40)
    odd = [(None, "a text without an id, repeated", "en", "s", 30), (None, "a text without an id, repeated", "en", "s", 30), (-1, None, None, None, None), (-2, "", "en", None, 0), (-3, "x y", None, "t", 3), (-3, "x y", None, "t", 3)]
    rows = docs.select(c.COLUMNS).unionByName(spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars int").withColumn("n_chars", F.col("n_chars").cast(docs.schema["n_chars"].dataType)))
    rows = rows.withColumns({n: F.lit("mine") for n in ("size", "score", "node", "component", "target", "copies", "_k")})
    for name, table in (("full", rows), ("empty", rows.limit(0))):
        folder = str(tmp_path / name)
        table.write.parquet(f"{folder}/documents.parquet")
        spark.read.parquet(f"{DATA}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
        stage = table
        for what, f in c.STAGES:
            before, stage = stage, f(spark, stage, folder)
            if what in ("toxicity", "quality", "near_duplicates"):
                assert set(map(str, stage.collect())) <= set(map(str, before.select(c.COLUMNS).collect()))
        assert c.run(spark, folder).isEmpty() == (name == "empty")
