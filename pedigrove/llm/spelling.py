"""Spelling variants: words one edit apart, found by common prefixes and suffixes of blocks of words, and the forms they stand for."""

from __future__ import annotations

import math
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import written

#: A run of letters.
LETTERS = r"[A-Za-zÀ-ÿ]+"
#: Rows in a block of words, about.
BLOCK_ROWS = 4096


def runs(documents: DataFrame, least: int) -> DataFrame:
    """doc_id, run: every run of at least ``least`` letters of each whole text, A to Z in lower case."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    found = F.regexp_extract_all(F.translate("text", upper, upper.lower()), F.lit(LETTERS), F.lit(0))
    return documents.select("doc_id", F.explode(found).alias("run")).where(F.length("run") >= least)


def with_typos(words: DataFrame, one_in: int = 199) -> Column:
    """The run, or where ``one_in`` divides h, the crc32 of '<doc_id>:<run>', the run without its code point h % length. A null doc_id: the run."""
    h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run")).cast("binary"))
    at = (h % F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return F.when(h % one_in == 0, cut).otherwise(F.col("run"))


def _code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A row a word, first letters first, and one last letters first; rows are padded to the longest word."""
    size = np.array([len(w) for w in words])
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    row, start = np.repeat(np.arange(len(words)), size), np.cumsum(size) - size
    at = np.arange(len(flat)) - start[row]
    ahead = np.zeros((len(words), int(size.max())), np.uint32)
    back = ahead.copy()
    ahead[row, at], back[row, size[row] - 1 - at] = flat, flat
    return ahead, back


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Letters that each row of a and each row of b begin with in common. What pads a must not match what pads b."""
    found, alive = np.zeros((len(a), len(b)), np.int32), np.ones((len(a), len(b)), bool)
    for t in range(a.shape[1]):
        alive &= a[:, t][:, None] == b[:, t][None]
        if not alive.any():
            break
        found += alive
    return found


def one_edit(a: list[str], b: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For each word of a and each of b, distinct and of lengths at most one apart: whether one inserted, deleted or replaced code point is all that differs, and their common prefix.

    It is if common prefix and suffix together reach the longer length less one.
    """
    sides = [(x[: len(a)], np.where(x[len(a) :] == 0, np.uint32(0xFFFFFFFF), x[len(a) :])) for x in _code_points(a + b)]
    prefix, suffix = (_common(*x) for x in sides)
    la, lb = (np.array([len(w) for w in x], np.int32) for x in (a, b))
    return prefix + suffix >= np.maximum(la[:, None], lb[None]) - 1, prefix


def _compare(table: pa.Table) -> pa.Table:
    table = table.sort_by("word")  # rows then stand in code-point order
    longer, side, part, n = (table[c].to_numpy() for c in ("longer", "side", "part", "n"))
    i, j = table["i"][0].as_py(), table["j"][0].as_py()
    words = np.array(table["word"].to_pylist(), object)
    size = np.array([len(w) for w in words])
    found = [(np.empty(0, np.int64),) * 3]
    # A tile: words of one class and one side, those of part i beside those of part j.
    order = np.lexsort((side, longer))
    for some in np.split(order, np.flatnonzero(np.diff(longer[order]) | np.diff(side[order])) + 1):
        left, right = (some[part[some] == x] for x in (i, j))
        for start in range(0, len(left) if len(right) else 0, 512):
            rows = left[start : start + 512]
            near, prefix = one_edit(list(words[rows]), list(words[right]))
            a, b = np.nonzero(near)
            # Each pair in one place: in the class of its longer word, at the side of its canonical common part; within a part in one order.
            at = longer[some[0]]
            here = (np.maximum(size[rows[a]], size[right[b]]) == at) & ((prefix[a, b] < at // 2) == side[some[0]])
            here &= (rows[a] < right[b]) if i == j else True
            a, b = rows[a[here]], right[b[here]]
            a, b = np.concatenate([a, b]), np.concatenate([b, a])
            # One row a word: its near words counted, and the best of them.
            ranked = np.lexsort((b, -n[b], a))
            mine, first, count = np.unique(a[ranked], return_index=True, return_counts=True)
            found.append((mine, count, b[ranked][first]))
    mine, count, best = map(np.concatenate, zip(*found))
    return pa.table({"word": table["word"].take(pa.array(mine)), "n_near": count, "near": table["word"].take(pa.array(best)), "near_n": n[best]})


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, near, near_n of words (word, n, distinct): how many are one edit away, and that of largest n (ties: smallest), for words that have one.

    Of two words one edit apart, the longer of L code points, either the first L // 2 agree
    or the last L - L // 2, so each word goes to four places: as one of L and as one of
    L - 1, by its first and by its last letters. Places are put together to blocks of about
    BLOCK_ROWS rows; a place of more is cut in parts, of which each two are compared. In a
    block words of one class and side are padded to matrices of code points and compared
    all at once; a block gives one row a word and tile, so nothing grows with the number of pairs.
    """
    size = F.length("word")
    place = lambda longer, side, text: F.struct(longer.cast("int").alias("longer"), F.lit(side).alias("side"), F.xxhash64(longer, F.lit(side), text).alias("place"))
    places = []
    for longer in (size, size + 1):
        head = F.floor(longer / 2).cast("int")
        tail = longer - head
        places += [place(longer, 0, F.substring(F.col("word"), F.lit(1), head)), place(longer, 1, F.substring(F.col("word"), size - tail + 1, tail))]
    rows = words.select("word", "n", F.explode(F.array(*places)).alias("p")).select("word", "n", "p.*")
    sizes = rows.groupBy("place").agg(F.count("*").alias("_rows"))
    large = written(sizes.where(F.col("_rows") > BLOCK_ROWS).select(F.col("place").alias("_place"), F.ceil(F.col("_rows") / BLOCK_ROWS).cast("int").alias("_parts")), "large-places")
    blocks = max(1, 4 * words.count() // BLOCK_ROWS)
    rows = rows.join(large, F.col("place") == F.col("_place"), "left")
    # A large place is a block of its own, numbered apart from those that small ones share.
    block = F.when(F.col("_parts").isNull(), F.pmod("place", F.lit(blocks))).otherwise(F.col("place"))
    part = F.when(F.col("_parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("word"), F.col("_parts")).cast("int"))
    others = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
    rows = rows.withColumns({"block": block, "large": F.col("_parts").isNotNull(), "part": part}).withColumn("other", F.explode(others))
    rows = rows.select("word", "n", "longer", "side", "block", "large", "part", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))
    found = rows.groupBy("block", "large", "i", "j").applyInArrow(_compare, "word string, n_near long, near string, near_n long")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), "near"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", F.col("b.near").alias("near"), (-F.col("b.n")).alias("near_n"))


def variants(words: DataFrame, factor: int = 5) -> DataFrame:
    """word, n, n_near, form, form_n, root of words (word, n, distinct).

    A word's form is its near word of largest n (ties: smallest in code-point order) if
    that n is at least ``factor`` times the word's; root is where forms lead to, the word
    itself if it has none. Along forms n grows by the factor at each step, so a chain has
    at most log(largest n) of them, and roots are found by as many doublings as that takes.
    """
    words = written(words, "words")
    near = near_words(words)
    formed = F.col("near_n") >= factor * F.col("n")
    table = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(formed, F.col("near")).alias("form"), F.when(formed, F.col("near_n")).alias("form_n")
    )
    table = written(table, "forms")
    largest = table.agg(F.max("n")).first()[0] or 1
    steps = math.ceil(math.log(largest) / math.log(factor)) + 1
    leads = table.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps))):
        onward = leads.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        leads = written(leads.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root")), "roots")
    return table.join(leads, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(documents: DataFrame, least: int = 6, often: int = 5) -> DataFrame:
    """word, form, root, n, n_near, form_n: the words of at least ``least`` code points that occur ``often`` in documents (doc_id, text).

    Words are runs of letters of the whole texts, A to Z in lower case, of which one
    in 199 loses a letter (see :func:`with_typos`). Null and empty texts have none;
    repeated rows count each; of a null doc_id no run loses a letter. Other columns are
    ignored; an empty table gives no rows.
    """
    found = runs(documents.select("doc_id", "text"), least)
    words = found.select(with_typos(found).alias("word")).where(F.length("word") >= least)
    words = words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= often)
    return variants(words).select("word", "form", "root", "n", "n_near", "form_n")


def op13_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return spelling_variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))
