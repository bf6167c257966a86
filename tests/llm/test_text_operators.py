"""Operators on texts against brute force, round trips and held-out accuracy; nulls, ties, repeats, empty tables."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from conftest import DATA

from pedigrove.llm import chat_format, html_extract, media_columns, mixing, ngram_jaccard, packing, quality, queries, token_counts, toxicity
from pedigrove.llm._common import connected_components

ODD = [
    (1, "a b c d e f g", "s"), (2, "A B c\td e f\ng", "s"), (3, None, None), (4, "", "s"), (None, "a b c d e f g", None), (5, "x y", "t"), (6, "X  Y", "t"),
    (7, " \n ", "t"), (7, "repeated row", "t"), (7, "repeated row", "t"), (8, "w " * 3000, None), (9, "<|endoftext|> é  x", ""), (10, "z z z z z z", "u"), (11, "z z z z z", "u"),
]


@pytest.fixture(scope="module")
def odd(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD, "doc_id long, text string, source string").withColumn("lang", F.lit("en")).withColumn("n_chars", F.lit(1).cast("long"))
    # Extra columns whose names the operators use inside.
    for name in ("size", "target", "node", "component", "score", "k", "key", "part", "digest", "n"):
        df = df.withColumn(name, F.lit("mine"))
    return df


def grams(text, k=5):
    w = (text or "").encode().lower().split()
    return frozenset([tuple(w)] if 0 < len(w) < k else [tuple(w[i : i + k]) for i in range(len(w) - k + 1)])


def brute_components(rows):
    sets = [grams(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            x = len(sets[i] & sets[j])
            if sets[i] and 5 * x >= 4 * (len(sets[i]) + len(sets[j]) - x):
                a, b = find(i), find(j)
                root[a] = b
    ids = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        ids[find(i)].append(d)
    return [(d, len(sets[i]), (min((x for x in ids[find(i)] if x is not None), default=None) if sets[i] else d)) for i, (d, _) in enumerate(rows)]


def by_text(rows):
    return sorted(rows, key=str)


def test_jaccard_odd_rows(spark, odd):
    got = by_text(tuple(r) for r in ngram_jaccard.similar_components(odd).collect())
    assert got == by_text(brute_components([r[:2] for r in ODD]))
    assert ngram_jaccard.similar_components(odd.limit(0)).isEmpty()


@pytest.mark.parametrize("frequent", [3, 32])
def test_jaccard_near_copies(spark, frequent):
    """Copies with few and many edits, a passage that all share, and sizes around the bounds."""
    rng = random.Random(frequent)
    word = lambda: f"w{rng.randrange(5000)}"
    passage, rows = [word() for _ in range(25)], []
    for g in range(12):
        base = [word() for _ in range(rng.choice([6, 9, 30, 120]))]
        for _ in range(9):
            t = list(base)
            for _ in range(rng.randrange(0, 1 + len(t) // 12)):
                t[rng.randrange(len(t))] = word()
            rows.append((len(rows) * 7 % 1009, " ".join(t + passage * (g % 2))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = by_text(tuple(r) for r in ngram_jaccard.similar_components(df, frequent=frequent).collect())
    assert got == by_text(brute_components(rows))


def test_jaccard_row_without_id_before_its_twin(spark):
    """One batch, in this order: the row without an id is the one that holds the set's signatures."""
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(None, text), (20, text), (21, text + " more"), (None, "alone " + text + " x y"), (30, "other words that no row has"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = by_text(tuple(r) for r in ngram_jaccard.similar_components(df).collect())
    want = brute_components(rows)
    want[3] = (None, want[3][1], None)  # no equal set has an id
    assert got == by_text(want) and (21, 57, 20) in got


def test_jaccard_hot_shingle_is_one_entry_a_batch():
    """A passage of 50 tokens in each of 400 documents: a range gets each token of the batch once, with its count."""
    rng = np.random.default_rng(1)
    passage = rng.integers(0, 1 << 48, 50, dtype=np.uint64)
    sets = {bytes([i % 256, i // 256]): (i, np.union1d(passage, rng.integers(0, 1 << 48, 5, dtype=np.uint64))) for i in range(400)}
    own, *sent = ngram_jaccard.batch_rows(list(range(400)), list(sets), [55] * 400, sets, 7, 16)
    tokens = np.concatenate([ngram_jaccard._unpack(r[2]) for r in sent])
    assert len(tokens) == len(np.unique(tokens)) == 50 + 400 * 5
    at, held = (np.concatenate([np.frombuffer(r[c], np.uint16) for r in sent]) for c in (3, 4))
    assert set(tokens[at == ngram_jaccard.MANY]) == set(passage) and held.tolist() == [400] * 50
    assert own[0] < 0 and sorted(np.frombuffer(own[3], np.uint16).tolist()) == sorted(list(range(400)) * 50)


def test_jaccard_hot_signatures(spark, monkeypatch):
    """A line that every document holds, one large group of near copies, ids that two texts share; parts and blocks of few rows."""
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(4000)}"
    line, base = [word() for _ in range(20)], [word() for _ in range(40)]
    rows = []
    for i in range(150):
        t = list(base if i % 3 == 0 else [word() for _ in range(4)])
        if i % 3 == 0:
            t[rng.randrange(len(t))] = word()
        rows.append((i // 2 if i % 10 == 0 else i, " ".join(t + line)))
    monkeypatch.setattr(ngram_jaccard, "BLOCK", 4)
    monkeypatch.setattr(ngram_jaccard, "PARTNERS", 3)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = by_text(tuple(r) for r in ngram_jaccard.similar_components(df, frequent=8).collect())
    want = brute_components(rows)
    low = {}  # sets of one doc_id are nodes of one component id
    for (d, _), (_, _, c) in zip(rows, want):
        low.setdefault(d, set()).add(c)
    for _ in range(len(rows)):
        for x in low.values():
            for y in low.values():
                if x & y and x != y:
                    x |= y
                    y |= x
    assert got == by_text((d, n, min(low[d])) for d, n, _ in want)


def test_prefix_signatures_lose_no_pair():
    rng = np.random.default_rng(0)
    for _ in range(300):
        n = int(rng.integers(2, 200))
        pool = rng.integers(0, 1 << 62, 3 * n, dtype=np.uint64)
        held = rng.integers(2, 80, 3 * n).astype(np.uint16)
        x = np.unique(rng.choice(3 * n, n, replace=False))
        out = rng.choice(x, int(rng.integers(0, max(1, n // 8 + 1))), replace=False)
        y = np.union1d(np.setdiff1d(x, out), rng.choice(3 * n, int(rng.integers(0, max(1, n // 10 + 1))), replace=False))
        both = len(np.intersect1d(x, y))
        if 5 * both >= 4 * (len(x) + len(y) - both) and len(np.union1d(x, y)) > both:
            a, b = (ngram_jaccard.signatures(len(z), pool[z], held[z]) for z in (x, y))
            assert len(np.intersect1d(a, b))


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(50)] + [(i, i + 1) for i in range(200, 260)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    low = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            low[a] = low[b] = min(low[a], low[b])
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: low[x] for x in linked}
    assert connected_components(spark.createDataFrame([], "a long, b long")).isEmpty()


def check_packing(rows, docs, length=packing.LENGTH):
    """Each id in exactly one piece, whatever rows share an id; sequences gapless, full or at a power of two."""
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts, covered = collections.Counter(), {}
    for doc_id, text in docs:
        texts[doc_id, tuple(plain.encode(text or "", add_special_tokens=False).ids + [1])] += 1
    for doc_id, t in texts:
        covered[doc_id, t] = np.zeros(len(t), int)
    of = collections.defaultdict(list)
    for doc_id, t in texts:
        of[doc_id].append(t)
    windows = collections.defaultdict(list)
    for r in rows:
        windows[r.sequence_id].append((r.offset, r.length))
        fits = [t for t in of[r.doc_id] if len(t) == r.doc_tokens and zlib.crc32(np.array(t[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32]
        assert len(fits) == 1 and r.length > 0
        covered[r.doc_id, fits[0]][r.start : r.start + r.length] += 1
    for key, times in texts.items():
        assert (covered[key] == times).all()
    for v in windows.values():
        at = 0
        for offset, n in sorted(v):
            assert offset == at
            at += n
        assert at == length or at & (at - 1) == 0


def test_ids_are_those_of_the_json_tokenizer():
    """Random strings of odd characters, long runs and special strings: the ranks' encoder against the JSON file's tokenizer."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from pedigrove.llm._tokens import encode, ranks_path

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(9)
    signs = ["a", "b", " ", "  ", "\n", "\t", "é", "ß", "中", "😀", "\u200d", "\x00", "'s", "1", "23", "...", "\u0301", "\xa0", "<|endoftext|>", "x" * 50, " " * 40, "don't"]
    for _ in range(4000):
        t = "".join(rng.choice(signs) for _ in range(rng.randrange(1, 30)))
        assert encode(t, ranks_path(), True).tolist() == plain.encode(t, add_special_tokens=False).ids, repr(t)


def test_packing(spark, odd):
    check_packing(packing.pack(odd).collect(), [r[:2] for r in ODD])
    assert packing.pack(odd.limit(0)).isEmpty()
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    check_packing(queries.QUERIES["op4_packing"](spark, DATA).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_packer_levels():
    """The level that makes the sum of squared counts least, against trying all of them."""
    rng = np.random.default_rng(1)
    p = packing.Packer(16, 0)
    for i in range(400):
        size = int(rng.integers(1, 16))
        costs = {}
        for h in [0] + [h for h in range(1, 17 - size) if p.counts[h]]:
            c = p.counts.copy()
            if h:
                c[h] -= 1
            if h + size < 16:
                c[h + size] += 1
            costs[h] = int((c**2).sum())
        assert costs[p.level_for(size)] == min(costs.values())
        p.add(i, np.arange(size, dtype=np.uint32))
    p.recut()
    assert sum(x[2] for x in p.take()) > 0 and not p.counts.any()


def test_windows_that_no_piece_fits_are_cut_anew_in_the_end():
    """12,000 documents of just over half a window: each opens one, and nothing is padded in the end."""
    p = packing.Packer(2048, 0)
    for i in range(12_000):
        p.add(i, np.zeros(1100, np.uint32))
    assert p.counts[1100] == 12_000 and not p.done
    p.recut()
    done = p.take()
    assert sum(x[2] for x in done) == 12_000 * 1100 and len({x[5] for x in done}) <= 12_000 * 1100 // 2048 + 12


def test_token_counts(spark, odd, tmp_path):
    from pedigrove.llm._tokens import encode, ranks_path

    names = token_counts.write_token_files(odd, f"file://{tmp_path}/t")
    for block in (3, 1000, 10**6):
        found = {(r.file, r.doc_index): r for r in token_counts.stitch(token_counts.scan_separators(spark, f"file://{tmp_path}/t", block=block)).collect()}
        got = by_text((r.doc_id, found[r.file, r.doc_index].n_tokens) for r in names.collect())
        assert got == by_text((d, len(encode(t, ranks_path(), False))) for d, t, _ in ODD)


def test_separator_scan_edges(spark, tmp_path):
    """Separators at block edges, in a row, at the start, and a last document without one; an empty file."""
    folder = tmp_path / "s"
    folder.mkdir()
    sep, ids = 9, [9, 1, 2, 9, 9, 3, 4, 5, 9, 6, 7]
    (folder / "a.bin").write_bytes(np.array(ids, "<u2").tobytes())
    (folder / "b.bin").write_bytes(b"")
    want = [(0, 0, 0, True), (1, 1, 2, True), (2, 4, 0, True), (3, 5, 3, True), (4, 9, 2, False)]
    for block in (1, 2, 3, 4, 11, 100):
        got = token_counts.stitch(token_counts.scan_separators(spark, f"file://{folder}", sep, block)).orderBy("doc_index").collect()
        assert [(r.doc_index, r.start, r.n_tokens, r.ended) for r in got] == want


def test_token_counts_query(spark):
    """Every document of the tables against the JSON file's tokenizer, the separator's string taken as ordinary text."""
    import public_tokenizers
    from tokenizers import Tokenizer

    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = queries.QUERIES["op10_token_counts"](spark, DATA).collect()
    assert len(got) == len(docs)
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert {r.doc_id: r.n_tokens for r in got} == {d: len(plain.encode(t, add_special_tokens=False).ids) for d, t in docs.items() if "<|endoftext|>" not in t}
    for f in {r.file for r in got}:  # documents follow each other without a gap
        rows, at = sorted((r for r in got if r.file == f), key=lambda r: r.doc_index), 0
        for i, r in enumerate(rows):
            assert (r.doc_index, r.start) == (i, at)
            at += r.n_tokens + 1


def test_token_files_of_an_empty_table(spark, odd, tmp_path):
    assert token_counts.write_token_files(odd.limit(0), f"file://{tmp_path}/e").isEmpty()


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, free, rest = {}, set(names), share * sum(sizes.values())
    while free:
        level = rest / sum(w[s] for s in free)
        over = {s for s in free if level * w[s] > most * sizes[s]}
        if not over:
            return target | {s: level * w[s] for s in free}
        target |= {s: float(most * sizes[s]) for s in over}
        rest, free = rest - sum(most * sizes[s] for s in over), free - over
    return target


def test_mixing(spark, odd):
    for df in (odd, spark.read.parquet(f"{DATA}/documents.parquet")):
        rows = mixing.mix(df).select("doc_id", "source", "text", "size", "source_size", "target", "copies").collect()
        assert len(rows) == df.count()
        sizes = collections.Counter()
        for r in rows:
            assert r["size"] == len((r.text or "").encode().split()) and 0 <= r.copies <= 2
            sizes[r.source] += r["size"]
        target = brute_targets(sizes)
        largest, taken = collections.Counter(), collections.Counter()
        for r in rows:
            assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
            taken[r.source] += r.copies * r["size"]
            largest[r.source] = max(largest[r.source], r["size"])
        assert all(abs(taken[s] - target[s]) <= largest[s] + 1e-6 for s in sizes)
        again = mixing.mix(df.repartition(3)).select("doc_id", "source", "text", "size", "source_size", "target", "copies").collect()
        assert by_text(map(str, rows)) == by_text(map(str, again))
        assert mixing.repeat_rows(mixing.mix(df)).count() == sum(r.copies for r in rows)
    assert mixing.mix(odd.limit(0)).isEmpty()
    wordless = spark.createDataFrame([(1, "", "a"), (2, None, None), (3, "x y", "b")], "doc_id long, text string, source string")
    got = {r.doc_id: (r["size"], r.target, r.copies) for r in mixing.mix(wordless).collect()}
    assert got[1] == got[2] == (0, 0.0, 0) and got[3][:2] == (2, 3.0) and got[3][2] in (1, 2)


def test_pivotal_rounding_is_fair_and_exact(spark):
    from pyspark.sql import functions as F

    units = spark.range(3000).select(F.lit("s").alias("source"), F.col("id").alias("k"), (F.col("id") % 7 + 1).alias("size"), F.lit(0.3).alias("p"))
    got = mixing.pivotal_round(units, fan_in=16).join(units, "k")
    r = got.agg(F.count("*").alias("n"), F.sum(F.col("copies") * F.col("size")).alias("t"), F.sum(F.col("size") * F.col("p")).alias("want"), F.avg("copies").alias("rate")).first()
    assert r.n == 3000 and abs(r.t - r.want) <= 3.5 and abs(r.rate - 0.3) < 0.05


def test_chat_round_trip(spark):
    texts = ["", None, "\\", "\\### ", "a</turn>\\", "\n</turn>\n", "### x\n### ", "\\\\</turn></turn>", "end\n", "é ###  "]
    rows = [(c, i, "assistant" if i % 2 else "user", t) for c in (1, None) for i, t in enumerate(texts)] + [(2, 0, "tool role\n", "x"), (2, 0, "tool role\n", "x"), (3, None, None, "q")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in chat_format.format_chats(chat_format.turn_events(df)).collect()}
    assert got[1] == got[None] == [("assistant" if i % 2 else "user", t or "") for i, t in enumerate(texts)]
    assert got[2] == [("tool role\n", "x")] * 2 and got[3] == [("", "q")]
    assert chat_format.format_chats(chat_format.turn_events(df.limit(0))).isEmpty()


def test_chat_events(spark):
    e = [
        (1, 0, 0, "message", "user", "hi"), (1, 1, 1, "message", "assistant", "a"), (1, 2, 1, "delta", "assistant", "b"), (1, 3, 0, "edit", "user", "hey"),
        (1, 4, 1, "regenerate", "assistant", ""), (1, 5, 1, "delta", "assistant", "X"), (1, 6, 1, "delta", "assistant", "Y"), (1, 7, 2, "delta", None, "late"),
    ]
    df = spark.createDataFrame(e, "conv_id long, seq long, message long, op string, role string, text string")
    assert [tuple(t) for t in chat_format.format_chats(df.repartition(3)).first().turns] == [("user", "hey"), ("assistant", "XY"), ("", "late")]


def test_loss_mask(spark):
    """Spans cut out of the string in Python; each assistant text once, nothing of another role or of the template."""
    texts = ["", None, "\\", "\\### ", "é</turn>\\", "\n</turn>\n", "😀 ### x", "plain"]
    rows = [(1, i, ("assistant", "user", "assistant", "tool")[i % 4], t) for i, t in enumerate(texts * 2)] + [(2, 0, "user", "no loss here"), (3, 0, "assistant", "twice"), (3, 0, "assistant", "twice")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    chats = chat_format.render(chat_format.fold_events(chat_format.turn_events(df)))
    for r in chats.collect():
        want = [t or "" for c, _, role, t in rows if c == r.conv_id and role == "assistant"]
        cut = [r.formatted[s.start : s.start + s.length] for s in r.loss]
        plain = [x.replace("\\### ", "### ").replace("\\</turn>", "</turn>") for x in cut]
        assert [x for x in plain if x] == [x for x in want if x] and len(cut) == sum(c == r.conv_id for c, *_ in rows)
    back = {(r.conv_id, r.i): (r.role, r.text, r.under_loss) for r in chat_format.read_back(chats).collect()}
    for c in (1, 2, 3):
        for i, (_, _, role, t) in enumerate(x for x in rows if x[0] == c):
            assert back[c, i] == (role, t or "", (t or "") if role == "assistant" else "")


def test_turn_events_hold_every_op(spark):
    df = spark.createDataFrame([(1, 0, "user", "abcde")], "conv_id long, turn long, role string, text string")
    log = chat_format.turn_events(df)
    assert {r.op for r in log.collect()} == {"message", "delta", "edit", "regenerate"}
    assert [r.text for r in chat_format.fold_events(log).collect()] == ["abcde"]


def test_chat_query(spark, same):
    same(queries.QUERIES["op9_chat_format"](spark, DATA), queries.SQL["op9_chat_format"])


PAGE = """<!doctype html><html><head><title>no</title><style>p{}</style></head><body><nav><a href=x>menu</a></nav><div class="cookie-notice">no, no, no</div>
<header>site</header><main><article><h1>Head &amp; line</h1><p>One, two,   three<br>four <b>bold</b><p>Second &lt;p&gt; &eacute;<ul><li>a<li>b</ul><aside>no</aside><script>var a="<p>no</p>"</script>
<form><p>no</p></form><div class="ad">no</div><blockquote>quote</blockquote></article><section id="comments"><p>nice, nice, nice, nice, nice, nice, nice, nice, nice, nice</p></section></main><footer>no</footer></body></html>"""


def test_html(spark):
    want = "Head & line\nOne, two, three four bold\nSecond <p> é\na\nb\nquote"
    assert html_extract.main_text(PAGE) == want
    assert html_extract.main_text(None) == html_extract.main_text("") == html_extract.main_text("<nav>x</nav>") == ""
    assert html_extract.main_text("just text") == "just text"
    assert html_extract.main_text("<p>a < b &amp c<p class='x") == "a < b & c"
    deep = "<div>" * 20_000 + "<p>deep</p>"
    assert html_extract.main_text(deep) == "deep"
    df = spark.createDataFrame([(1, "u", PAGE), (1, "u", PAGE), (None, None, None)], "page_id long, url string, html string")
    df = df.selectExpr("*", "'mine' as text", "0 as n_chars", "1 as node")
    assert by_text(tuple(r) for r in html_extract.extract(df).collect()) == by_text([(1, "u", want, len(want))] * 2 + [(None, None, "", 0)])
    assert html_extract.extract(df.limit(0)).isEmpty()


def test_html_names_do_not_drop_the_article():
    p = "<p>One, two, three and a text of some length that is the article.</p>"
    want = "One, two, three and a text of some length that is the article."
    junk = "<div class='sidebar'><p>no</p></div><section class='comments'><article class='comment'><p>nice, nice, nice</p></article></section>"
    for page in (
        f"<div class='layout has-sidebar'><article>{p}</article>{junk}</div>", f"<article class='post comments-open'>{p}</article>{junk}",
        f"<div id='page-header-wrap'><article class='entry no-header'>{p}</article></div>{junk}", f"<div class='no-sidebar'>{p}</div><div class='ad'>no</div>",
        f"<main><div class='has-sidebar'>{p}</div><div class='widget'>no</div></main>", f"<article><div class='with-sidebar'>{p}</div><p class='share'>no</p></article>",
    ):
        assert html_extract.main_text(f"<html><body>{page}</body></html>") == want, page
    table = "<article><table><tr class='header'><th class='header'>a</th><th>b</th></tr><tr><td>1</td><td>2</td></tr></table></article>"
    assert html_extract.main_text(table) == "a\nb\n1\n2"


@pytest.mark.parametrize(
    "page",
    [
        "<div class='layout has-sidebar'><article>{p}{p}</article></div>", "<article class='post no-comments'>{p}{p}</article>", "<form><div>{p}{p}</div></form>",
        "<form><article>{p}{p}</article><input></form>", "<article>{p}<div id='related-work'>{p}</div></article>", "<main>{l}{p}{p}</main>", "<div>{l}{p}{p}</div>",
        "<article>{p}{p}{l}</article>", "<div><div>{p}{p}</div>{l}</div>", "<div class=post>{p}{p}</div><div id=comments>{p}{p}{p}{p}{p}</div>",
        "<article>{p}{p}</article><section><h3>3 Comments</h3>{p}{p}{p}{p}</section>", "<main><div class=body>{p}{p}</div><ol class='comment-list'><li>{p}</li><li>{p}</li></ol></main>",
        "<main><div>{p}{p}</div><section class='comments'><article class=comment>{p}{p}{p}</article></section></main>", "<main><article>{p}<aside>{p}</aside>{p}</article></main>",
        "<div class=wrap><div class=content>{p}{p}</div><div class='sidebar'>{p}</div></div>", "<div class='cookie-notice'>{p}</div><div>{p}{p}</div>",
        "<header><h1>Site</h1>{p}</header><main>{p}{p}</main><footer>{p}</footer>", "<div role=banner>{p}</div><div>{p}{p}</div><div role=contentinfo>x, y</div>",
        "<article>{p}<form><p>Subscribe, now, please.</p></form>{p}</article>", "<article><header><h1>{t}</h1><p>By someone</p></header>{p}</article>", "<div class='sidebar'>{p}{p}</div>",
        "<article>{p}<div class='newsletter-signup'>{p}</div>{p}</article>", "<article>{p}{p}<footer>{p}</footer></article>",
    ],
)
def test_html_scores_before_it_drops(page):
    """Names and tags around the article cost it nothing; menus, comments and the like go, whatever marks them."""
    t = "One, two, three and a text of some length that is the article, really."
    links = "<ul>" + "".join(f"<li><a href='/{i}'>Nav link {i}</a></li>" for i in range(6)) + "</ul>"
    assert html_extract.main_text("<html><body>" + page.format(p=f"<p>{t}</p>", t=t, l=links) + "</body></html>") == f"{t}\n{t}"


def test_html_keeps_short_sections_without_an_article():
    long = "<p>" + "many, many words, " * 30 + "</p>"
    got = html_extract.main_text(f"<body><div>{long}</div><div><p>Short second one.</p></div><p>End.</p><div><a href='/'>one</a> <a href='/'>two</a></div></body>")
    assert got.split("\n")[1:] == ["Short second one.", "End."]
    got = html_extract.main_text(f"<div class=post>Bare before,<br>and more.<div>{long}</div>Bare after. <div><a href='/'>a</a></div><a href='/'>one</a> <a href='/'>two</a></div><div class=ad>Bare, too</div>")
    assert got.split("\n")[0] == "Bare before, and more." and got.split("\n")[2:] == ["Bare after."]


ARTICLE = "<article><p>Some text, that is long enough, to be kept here.</p>"


@pytest.mark.parametrize(
    "rest",
    [
        "<a" * 20000, "a<" * 20000, "<a" * 20000 + ">", "<a x=\"1 " * 20001, "<a x='1 " * 20001, "<a x=\"1\" " * 20001 + "y=\">", "<a " + "x=\"1 " * 20001, "<div>" * 20000 + "<li></li>" * 20000,
        "<div>" * 20000 + "<li>" * 20000, "<li><div>" * 20000, "<header><h1></h1></header>" * 20000, "<!" * 20000, "<!--" * 20000, "</x" * 20000, "<a " + "= " * 20000, "<b>" * 20000 + "</i>" * 20000,
        "&#" + "9" * 5000 + ";", "&#" + "0" * 6000 + "65;", "<p style='" + "display " * 20000 + "'>", "<table><tr><td>" * 10000,
    ],
)
def test_no_page_hangs(rest):
    """Malformed and deep pages are read in time that grows with their length, by both readers; the article before them stays."""
    import time

    for read in (html_extract.main_text, media_columns.sequence):
        began = time.process_time()
        read(ARTICLE + rest)
        assert time.process_time() - began < 2
    assert html_extract.main_text(ARTICLE + rest).startswith("Some text, that is long enough, to be kept here.")


def test_html_keeps_the_article_and_no_more():
    t = "A paragraph of the article, with commas, words, and a sentence that makes it long enough."
    links = "".join(f"<li><a>A linked headline {i}</a></li>" for i in range(3))
    for page, want in (
        (f"<article><p>{t}</p><p>See <a>one thing here</a>, <a>another thing here</a>, and <a>the third thing here</a>.</p></article>", f"{t}\nSee one thing here, another thing here, and the third thing here."),
        (f"<article><p>{t}</p><section id='banner-history'><h2>Banners</h2><p>{t}</p></section></article>", f"{t}\nBanners\n{t}"),
        (f"<div class='elementor-widget-container'><p>{t}</p></div><div class='elementor-widget-container'><p>{t}</p></div>", f"{t}\n{t}"),
        (f"<article><p>{t}</p><h2>References</h2><ol>{links}</ol></article>", f"{t}\nReferences\nA linked headline 0\nA linked headline 1\nA linked headline 2"),
        (f"<article><p>{t}</p><p>{t}</p></article><article><p>{t}</p></article>", f"{t}\n{t}\n{t}"),
        (f"<article><p>{t}</p></article><article><p>{t}</p><p>{t}</p></article>", f"{t}\n{t}\n{t}"),
        (f"<div><p>{t}</p><p>{t}</p></div><div>We use cookies to improve your experience.</div><div>© 2020 A Company. All rights reserved.</div>", f"{t}\n{t}"),
        (f"<article><p>{t}</p><ul>{links}</ul><p><a>Home</a> | <a>About us</a> | <a>Contact</a></p></article>", t),
        (f"<div><p>{t}</p><p>{t}</p></div><div class='widget-area'><ul>{links}</ul></div>", f"{t}\n{t}"),
        (f"<article><p>{t}</p><p>{t}</p><div class='cookie-banner'>We use cookies to improve your experience on this site, and more. By going on you agree to it.</div></article>", f"{t}\n{t}"),
    ):
        assert html_extract.main_text(f"<html><body>{page}</body></html>") == want, page


def test_html_query(spark):
    """The pages' articles, read off their source by another way."""
    import html
    import re

    for r, p in zip(queries.QUERIES["op2_html_extract"](spark, DATA).orderBy("page_id").collect(), spark.read.parquet(f"{DATA}/pages.parquet").orderBy("page_id").collect()):
        body = re.search(r"<article>(.*)</article>", p.html, re.S)[1].replace("<br>", " ")
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n".join(filter(None, parts)) and r.n_chars == len(r.text)


def test_media(spark, odd):
    rows = [(i, t) for i, t, _ in ODD if i not in (7, None)]
    got = media_columns.read_back(media_columns.store_payloads(odd.selectExpr("cast(text as binary) payload"))).collect()
    assert len(got) == len({(t or "").encode() for _, t, _ in ODD})
    by = {r.digest: r for r in got}
    for _, t in rows:
        raw = (t or "").encode()
        pad = raw.ljust(max(1, -(-len(raw) // 192)) * 192)
        r = by[hashlib.sha256(raw).hexdigest()]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(pad), hashlib.sha256(pad).hexdigest(), zlib.crc32(pad[-16:]))
        stored = media_columns.store(pad)
        assert (r.media_bytes, r.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest()) and media_columns.load(stored).tobytes() == pad
    assert media_columns.read_back(media_columns.store_payloads(odd.limit(0).selectExpr("cast(text as binary) payload"))).isEmpty()


def test_media_query(spark):
    """Every row of the query against Python's own way: payload, stored form, place amid the text's lines, caption."""
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = queries.QUERIES["op7_media_columns"](spark, DATA).collect()
    assert len(got) == len(docs)
    for r in got:
        raw = docs[r.doc_id].encode()
        pad = raw.ljust(max(1, -(-len(raw) // 192)) * 192)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(pad), hashlib.sha256(pad).hexdigest(), zlib.crc32(pad[-16:]))
        stored = media_columns.store(pad)
        assert (r.media_bytes, r.media_sha256, r.feature) == (len(stored), hashlib.sha256(stored).hexdigest(), media_columns.feature(np.frombuffer(pad, np.uint8)))
        lines = docs[r.doc_id].split("\n")
        assert r.position == sum(bool(x.split()) for x in lines[: len(lines) // 2]) and r.caption == str(r.doc_id)
    assert len({r.position for r in got}) > 3


def test_shown_pages_keep_the_text(spark):
    """The text parts of the query's pages are the text's lines, signs of HTML and all."""
    from pyspark.sql import functions as F

    texts = ["a <b> & c\n\nd", "", None, "one line", "&amp; <p>x</p>\n</article>\nz"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pages = df.select("doc_id", media_columns.shown(F.sha2(F.lit("x"), 256), F.col("text"), F.col("doc_id").cast("string")).alias("html"))
    for r in media_columns.parse_sequences(pages, "doc_id").collect():
        assert [p.text for p in r.parts if p.kind == "text"] == [x for x in (texts[r.doc_id] or "").split("\n") if x]
        assert [p.position for p in r.parts] == list(range(len(r.parts))) and sum(p.kind == "media" for p in r.parts) == 1


def test_media_sequence_stays_aligned(spark):
    html = "<p>a<img src=x alt=q><figure><img src='media:sha256:" + "0" * 64 + "'><img src=z><figcaption>cap <b>t</b></figcaption></figure>tail<figure><img src=w></figure>"
    parts = media_columns.sequence(html)
    assert [(p["position"], p["kind"], p["text"] or p["ref"][:1], p["caption"]) for p in parts] == [
        (0, "text", "a", None), (1, "media", "x", "q"), (2, "media", "m", "cap t"), (3, "media", "z", "cap t"), (4, "text", "tail", None), (5, "media", "w", None)
    ]
    pages = spark.createDataFrame([(1, html), (2, None)], "page_id long, html string")
    media = spark.createDataFrame([("0" * 64, 5)], "digest string, n_bytes int")
    got = media_columns.resolve(media_columns.parse_sequences(pages), media).orderBy("position").collect()
    assert [(r.position, r.caption, r.n_bytes) for r in got] == [(1, "q", None), (2, "cap t", 5), (3, "cap t", None), (5, None, None)]


def labelled(spark):
    return spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")


def accuracy(scored, labels, label):
    rows = scored.where("held_out").join(labels, "doc_id").select("predicted", label).collect()
    assert len(rows) > 500
    return sum(r[0] == r[1] for r in rows) / len(rows)


def test_quality(spark, odd):
    docs, labels = labelled(spark)
    model = quality.train(docs, labels, 1500)
    assert accuracy(quality.score_quality(docs, model), labels, "quality") > 0.98
    rows = quality.score_quality(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert quality.keep_good(odd, model).columns == odd.columns and quality.score_quality(odd.limit(0), model).isEmpty() and quality.keep_good(odd.limit(0), model).isEmpty()
    assert quality.keep_good(odd, quality.train(docs, labels.limit(0))).count() == len(ODD)
    assert quality.train(docs, labels.limit(0)).score(np.zeros((1, len(quality.FEATURES))))[0] == 0.5


def test_toxicity(spark, odd):
    docs, labels = labelled(spark)
    model = toxicity.train(docs, labels, 600)
    scored = toxicity.score_toxicity(docs, model)
    assert accuracy(scored, labels, "toxic") > 0.95
    rows = toxicity.score_toxicity(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert model.score([None, "", " ,.! "]).max() < 0.1
    long = model.score(["the and " * 5000 + "idiot"])[0]
    assert long == model.score(["the and idiot"])[0] > 0.7
    assert toxicity.train(docs, labels.limit(0)).score(["x"])[0] == 0.5
    assert toxicity.score_toxicity(odd.limit(0), model).isEmpty() and toxicity.drop_toxic(odd, model).columns == odd.columns
    scored = toxicity.score_toxicity(docs, toxicity.train(docs, labels))  # as the query learns
    held = scored.where("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    hit = sum(r.predicted and r.toxic for r in held)
    assert hit / sum(r.toxic for r in held) > 0.85 and hit / sum(r.predicted for r in held) > 0.9


def test_sample_is_bounded_by_ids(spark):
    """Rows that share an id count once, a null text is empty, at most so many ids a class."""
    from pedigrove.llm._labels import in_fold, labelled_sample

    docs = spark.createDataFrame([(i % 50, f"t{i}") for i in range(500)] + [(3, None), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)] + [(None, 1), (7, 1)], "doc_id long, toxic int")
    rows = labelled_sample(docs, labels, "toxic", 10, 3, 1).collect()
    assert len(rows) == len({r.doc_id for r in rows}) == 20 and sum(r.y for r in rows) == 10 and all(r.text is not None for r in rows)
    assert not {r.doc_id for r in rows} & {r.doc_id for r in docs.where(in_fold("doc_id", 3, 1)).collect()}


def test_registered_classifiers_cover_every_row(spark):
    docs = {r.doc_id for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    for name, folds, fold in (("op3_quality", 4, 2), ("op5_toxicity", 3, 1)):
        rows = queries.QUERIES[name](spark, DATA).collect()
        assert {r.doc_id for r in rows} == docs and len(rows) == len(docs)
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == fold) for r in rows)


def test_toxicity_learns_from_every_word():
    """Over 100,000 words to learn, those of the toxic rows last; each has one mark, a word of no other text."""
    import pyarrow as pa

    rng = random.Random(3)
    clean = ["".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(140_000)]
    marks = [f"zq{i}xkv" for i in range(40)]
    vocabulary = list(dict.fromkeys(clean)) + marks
    n = len(vocabulary) - 40
    texts = list(np.array_split(np.arange(n), 320)) + [np.array([7 * i, 7 * i + 3, n + i]) for i in range(40)]
    model = toxicity.fit(texts, np.array([0] * 320 + [1] * 40), pa.array(vocabulary), epochs=6, turns=2)
    marked, plain = model.word_logits(marks), model.word_logits(vocabulary[:2000])
    assert marked.min() > np.quantile(plain, 0.99)
    assert np.quantile(model.score([f"{clean[0]} {m}" for m in marks]), 0.1) > 0.7 > model.score(clean[:2000]).max()


def test_subwords_are_shared_and_stable():
    words = ["idiot", "idiots", "ab", "é", "idiot"]
    bucket, at = toxicity.subwords(words)
    bags = [sorted(x.tolist()) for x in np.split(bucket, at[1:])]
    assert bags[0] == bags[4] and len(set(bags[0]) & set(bags[1])) >= 6
    alone = toxicity.subwords(["idiots"])[0]
    assert sorted(alone.tolist()) == bags[1] and [len(b) for b in bags] == [5 + 4 + 3 + 1, 6 + 5 + 4 + 1, 2 + 1 + 1, 1 + 1, 13]


def test_tables_add_up_by_bins():
    """The vectorised score against one that walks the tables row by row."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)  # an interaction that no single feature shows
    m = quality.fit(x, y, rounds=60)
    assert ((m.score(x) > 0.5) == y).mean() > 0.95
    for row in x[:20]:
        total = m.base + sum(t[(e <= v).sum()] for t, e, v in zip(m.tables, m.edges, row))
        total += sum(t[(m.coarse[i] <= row[i]).sum(), (m.coarse[j] <= row[j]).sum()] for i, j, t in m.pairs)
        assert m.logit(row[None])[0] == pytest.approx(total)
