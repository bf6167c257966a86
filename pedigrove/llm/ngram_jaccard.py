"""N-gram Jaccard join by token-combination prefixes.

Two documents link when the Jaccard similarity of their sets of word shingles
("tokens") reaches a threshold. Tokens are ordered by how many documents hold them,
rare ones first. In a linked pair a document lacks at most tau = n - ceil(t n) of its n
tokens in the other, which a prefix of the order turns into shared signatures:

* tokens of the rare class count singly: tau + 1 of them share one with the partner;
* tokens of the frequent class fall, by a hash, in groups, and two of one group make a
  signature: a group of m tokens counts m - 1, as that many may be missing before no
  two are left. The prefix is extended until the counts add up to tau + 1.

With both documents' prefixes cut so, the shorter one (in the order) already holds what
is shared, so the other holds it too. The number of groups follows the size of the
smaller document, so that combinations stay linear in it: sizes fall in classes of
ratio 1 / t, and a document is indexed under each class that a partner no larger than
itself can have, two in most cases.

A token is 48 bits of a hash (set sizes and equality use 64 and 128): two sets of 20,000
tokens look one token closer than they are with a chance of one in a million. Equal sets
are one node throughout. Candidates are never paired all with all: within a
signature, each document is first verified against one leader; components of the links
found drop whole signatures; what is left is compared in blocks by exact bounds (sizes,
parity bitmaps), across components only, and verified.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import connected_components, written

#: Tokens that a task gathers before it sends them on, and that a token range is cut for.
BATCH_TOKENS, RANGE_TOKENS = 500_000, 800_000
#: Documents that hold a token of the frequent class, at least.
FREQUENT = 32
#: Documents of a signature that are compared with each other at once, and documents that one is verified against.
BLOCK, PARTNERS = 1024, 128
BITS = 2048
#: Place of a token that several documents of a batch hold; above any document's.
MANY = 65535

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]


def mix64(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class WordHash(dict):
    """Word to 64-bit hash, remembered up to a number of words."""

    MOST = 100_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.MOST:
            self.clear()
        self[word] = h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return h


def shingles(text: str | None, hashes: WordHash, k: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles; A-Z in lower case, words apart by ASCII white space."""
    words = (text or "").encode().lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    if n < k:
        h = np.array([n], np.uint64) * np.uint64(0xA0761D6478BD642F)
        for i in range(n):
            h = mix64(h + w[i : i + 1] * _MIX[i % 5])
        return h
    h = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        h += w[i : n - k + 1 + i] * (_MIX[i] if i < 5 else mix64(np.array([i], np.uint64))[0] | np.uint64(1))
    return np.unique(mix64(h))


def size_class(n: int, t: float = 0.8) -> int:
    return int(np.floor(np.log(n) / -np.log(t) + 1e-9))


def groups_of_class(c: int, t: float = 0.8) -> int:
    """Groups that the frequent tokens of size class c fall in: an eighth of its smallest size."""
    return max(1, int(np.ceil(t**-c - 1e-9)) // 8)


def signatures(n: int, tokens: np.ndarray, held: np.ndarray, num: int = 4, den: int = 5, frequent: int = FREQUENT) -> np.ndarray:
    """Signatures of a document with n tokens, of which ``tokens`` are held by ``held`` >= 2 documents each."""
    need = n - -(-num * n // den) + 1
    alone = n - len(tokens)
    if alone >= need or n < 2:
        return np.zeros(0, np.uint64)
    order = np.lexsort((tokens, held))
    tokens, rare = tokens[order], held[order] < frequent
    t, found = num / den, []
    for c in range(size_class(-(-num * n // den), t), size_class(n, t) + 1):
        salt, m = mix64(np.array([c + 1], np.uint64)), groups_of_class(c, t)
        group = (mix64(tokens ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(m)).astype(np.int64)
        # A frequent token counts unless it is the first of its group.
        counts = rare.copy()
        often = np.flatnonzero(~rare)
        first = np.unique(group[often], return_index=True)[1]
        counts[often] = True
        counts[often[first]] = False
        reach = np.searchsorted(np.cumsum(counts), need - alone) + 1
        prefix, often = tokens[:reach], ~rare[:reach]
        found.append(mix64(prefix[~often] ^ salt))
        if often.any():
            at = np.argsort(group[:reach][often], kind="stable")
            g, p = group[:reach][often][at], prefix[often][at]
            for gap in range(1, int(np.bincount(g).max())):
                same = np.flatnonzero(g[gap:] == g[:-gap])
                a, b = p[same], p[same + gap]
                found.append(mix64(mix64(np.minimum(a, b) + salt) ^ np.maximum(a, b)))
    return np.unique(np.concatenate(found))


def parity_bits(tokens: np.ndarray) -> bytes:
    """Parity of the tokens in each of BITS cells: two sets differ in as many tokens as their bits at least."""
    cells = np.bincount((tokens % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(cells.astype(np.uint8)).tobytes()


def _pack(tokens: np.ndarray) -> bytes:
    """Sorted 48-bit hashes as six planes of bytes: the leading ones hardly change and are compressed away in the shuffle."""
    return np.ascontiguousarray(tokens, "<u8").view(np.uint8).reshape(-1, 8).T[:6].tobytes()


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(6, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :6] = planes.T
    return out.view("<u8").ravel()


_SENT = "part long, batch long, tokens binary, at binary, held binary, ids array<bigint>, digests array<binary>, sizes array<bigint>"
_SENT_ARROW = pa.schema([
    ("part", pa.int64()), ("batch", pa.int64()), ("tokens", pa.binary()), ("at", pa.binary()), ("held", pa.binary()),
    ("ids", pa.list_(pa.int64())), ("digests", pa.list_(pa.binary())), ("sizes", pa.list_(pa.int64())),
])


def _sent(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SENT_ARROW)] if rows else [pa.array([], f.type) for f in _SENT_ARROW], schema=_SENT_ARROW)


def batch_rows(ids: list, digests: list[bytes], sizes: list[int], sets: dict[bytes, tuple[int, np.ndarray]], number: int, parts: int) -> list[tuple]:
    """Rows of _SENT for a batch: one of its own, which no other batch's rows meet, and one a range of hash values.

    A range gets each token of the batch once, however many documents hold it: ``at`` is
    the document, or MANY, and ``held`` the number of documents of each of the latter.
    Which they are stays on the batch's own row, so a task that counts a range has one
    entry a batch and token at most.
    """
    if not sets:
        return [(-1 - number, number, None, b"", b"", ids, digests, sizes)]
    tokens = np.concatenate([x for _, x in sets.values()])
    at = np.repeat(np.array([i for i, _ in sets.values()], np.uint16), [len(x) for _, x in sets.values()])
    order = np.argsort(tokens)
    tokens, at = tokens[order], at[order]
    first = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
    times = np.diff(np.append(first, len(tokens)))
    rows = [(-1 - number, number, None, at[np.repeat(times > 1, times)].tobytes(), times[times > 1].astype(np.uint16).tobytes(), ids, digests, sizes)]
    tokens, at = tokens[first], np.where(times > 1, np.uint16(MANY), at[first])
    cut = np.searchsorted((tokens >> np.uint64(16)) * np.uint64(parts) >> np.uint64(32), np.arange(parts + 1, dtype=np.uint64))
    for p, (a, b) in enumerate(zip(cut, cut[1:])):
        if b > a:
            t = times[a:b]
            rows.append((p, number, _pack(tokens[a:b]), at[a:b].tobytes(), t[t > 1].astype(np.uint16).tobytes(), None, None, None))
    return rows


def index(documents: DataFrame, k: int = 5, num: int = 4, den: int = 5, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, digest (of the set), n, sigs, tokens, bits: one row a document, written.

    sigs are its signatures; tokens, as packed sorted hashes, those that another batch or
    set holds too (all that a partner can share). Both are null where no partner is
    possible, and for a repeated set within a batch.

    Texts are read once. A task counts the tokens of a batch and sends each on once, cut
    by ranges of hash values; a range adds the batches' counts up and sends back the
    tokens that are held twice or more. A set that a batch repeats is counted once in it.
    """
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(documents.sparkSession.sparkContext.defaultParallelism, int(size // 8 // RANGE_TOKENS) + 1)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, number = WordHash(), TaskContext.get().partitionId() << 24
        ids, digests, sizes, sets, total = [], [], [], {}, 0

        def flush():
            nonlocal number
            rows = batch_rows(ids, digests, sizes, sets, number, parts)
            number += 1
            return _sent(rows)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                x = shingles(text.as_py(), hashes, k)
                digest = hashlib.blake2b(x.tobytes(), digest_size=16).digest()
                if len(x) and digest not in sets:
                    sets[digest] = len(ids), np.unique(x >> np.uint64(16))
                    total += len(x)
                ids.append(doc_id)
                digests.append(digest)
                sizes.append(len(x))
                if total >= BATCH_TOKENS or len(ids) >= 50_000:
                    yield flush()
                    ids, digests, sizes, sets, total = [], [], [], {}, 0
        if ids:
            yield flush()

    def count(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        if rows[0]["part"] < 0:
            return table
        tokens = np.concatenate([_unpack(r["tokens"]) for r in rows])
        order = np.argsort(tokens, kind="stable")
        tokens = tokens[order]
        first = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
        own = np.ones(len(tokens), np.int64)
        own[np.concatenate([np.frombuffer(r["at"], np.uint16) for r in rows]) == MANY] = np.concatenate([np.frombuffer(r["held"], np.uint16) for r in rows])
        times = np.add.reduceat(own[order], first)
        held = np.empty(len(tokens), np.uint16)
        held[order] = np.repeat(np.minimum(times, 65535), np.diff(np.append(first, len(tokens))))  # any function of the token will do for the order
        out, start = [], 0
        for r in rows:
            own, at = _unpack(r["tokens"]), np.frombuffer(r["at"], np.uint16)
            h = held[start : start + len(own)]
            start += len(own)
            shared = h > 1
            if shared.any():
                out.append((r["part"], r["batch"], _pack(own[shared]), at[shared].tobytes(), h[shared].tobytes(), None, None, None))
        return pa.Table.from_batches([_sent(out)])

    def gather(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        names = next(r for r in rows if r["part"] < 0)
        sent = [r for r in rows if r["part"] >= 0]
        cat = lambda key, kind, read: np.concatenate([read(r[key]) for r in sent]) if sent else np.zeros(0, kind)
        short = lambda x: np.frombuffer(x, np.uint16)
        sent.sort(key=lambda r: r["part"])  # by range, so by token, as the batch's own row has the documents of MANY
        tokens, at, held = cat("tokens", np.uint64, _unpack), cat("at", np.uint16, short), cat("held", np.uint16, short)
        times = np.ones(len(at), np.int64)
        times[at == MANY] = short(names["held"])
        tokens, at, held = (np.repeat(x, times) for x in (tokens, at, held))
        at[at == MANY] = short(names["at"])
        order = np.lexsort((tokens, at))
        tokens, at, held = tokens[order], at[order], held[order]
        n_docs = len(names["ids"])
        cut = np.searchsorted(at, np.arange(n_docs + 1))
        sigs, packed, bits = [None] * n_docs, [None] * n_docs, [None] * n_docs
        for i in np.flatnonzero(np.diff(cut)):
            own = tokens[cut[i] : cut[i + 1]]
            s = signatures(names["sizes"][i], own, held[cut[i] : cut[i + 1]], num, den, frequent)
            if len(s):
                sigs[i], packed[i], bits[i] = s.view(np.int64), _pack(own), parity_bits(own)
        return pa.table({
            "doc_id": pa.array(names["ids"], pa.int64()), "digest": pa.array(names["digests"], pa.binary()), "n": pa.array(names["sizes"], pa.int64()),
            "sigs": pa.array(sigs, pa.list_(pa.int64())), "tokens": pa.array(packed, pa.binary()), "bits": pa.array(bits, pa.binary()),
        })

    sent = documents.select("doc_id", "text").mapInArrow(read, _SENT)
    counted = sent.groupBy("part").applyInArrow(count, _SENT)
    return written(
        counted.groupBy("batch").applyInArrow(gather, "doc_id long, digest binary, n long, sigs array<bigint>, tokens binary, bits binary"), "jaccard-index"
    )


def _verify(pairs: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """a, b of the distinct pairs (a, b) whose sets are similar enough, by exact intersection of their tokens.

    The tokens of a are sent once to a task's PARTNERS of its partners, not once a pair;
    an a with more partners is cut into as many parts as that makes.
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, fresh = [], False  # sets of the a at hand (two rows of one doc_id are two)
        for batch in batches:
            ok = []
            for i, (other, q, tokens) in enumerate(zip(batch.column(1).to_pylist(), batch.column(3).to_pylist(), batch.column(4))):
                tokens = _unpack(tokens.as_py())
                if not other:  # sorted so that they come before their partners
                    own = [*own, (q, tokens)] if fresh else [(q, tokens)]
                elif any(den * min(n, q) >= num * max(n, q) and den * (s := len(np.intersect1d(x, tokens, assume_unique=True))) >= num * (n + q - s) for n, x in own):
                    ok.append(i)
                fresh = not other
            yield batch.select([0, 2]).take(pa.array(ok, pa.int64())).rename_columns(["a", "b"])

    # Written, the pairs' size is known before the joins are planned: few pairs go to the tokens, not all tokens to the pairs.
    pairs = written(pairs, "jaccard-pairs")
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / PARTNERS).alias("parts")).where("parts > 1")
    pairs = pairs.join(written(many, "jaccard-parts"), "a", "left")
    pairs = written(pairs.select("a", "b", F.pmod(F.xxhash64("b", F.lit(9)), F.coalesce("parts", F.lit(1))).alias("part")), "jaccard-dealt")
    some = nodes.select("node", "n", "tokens")
    own = pairs.select("a", "part").distinct().withColumns({"other": F.lit(False), "node": F.col("a")}).join(some, "node")
    others = pairs.withColumns({"other": F.lit(True), "node": F.col("b")}).join(some, "node")
    kinds = ("a", "part", "other", "node", "n", "tokens")
    rows = own.select(*kinds).unionByName(others.select(*kinds)).repartition("a", "part").sortWithinPartitions("a", "part", "other")
    return rows.select("a", "other", "node", "n", "tokens").mapInArrow(check, "a long, b long")


def _compare(blocks: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of other components that the bounds allow, within each key's rows (side 0 with side 1, or all if there is one side)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

        def pairs(t: pa.Table) -> pa.RecordBatch:
            node, part, n = (t[c].to_numpy() for c in ("node", "component", "n"))
            held, mixed, side = t["m"].to_numpy(), t["mixed"][0].as_py(), t["side"].to_numpy()
            bits = np.frombuffer(b"".join(t["bits"].to_pylist()), np.uint64).reshape(len(node), -1)
            left, right = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if mixed else (np.arange(len(node)),) * 2
            found = []
            for i in left.tolist():
                j = right if mixed else right[i + 1 :]
                j = j[(part[j] != part[i]) & (den * np.minimum(n[j], n[i]) >= num * np.maximum(n[j], n[i]))]
                if len(j):
                    apart = np.bitwise_count(bits[j] ^ bits[i]).sum(1)
                    most = (held[j] + held[i] - apart) // 2  # of the intersection
                    j = j[(num + den) * most >= num * (n[j] + n[i])]
                    found += [(min(node[i], x), max(node[i], x)) for x in node[j].tolist()]
            found = sorted(set(found))
            return pa.RecordBatch.from_arrays([pa.array([p[c] for p in found], pa.int64()) for c in (0, 1)], schema=out)

        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([rest, t]) if rest is not None else t
            key = t["key"].to_numpy()
            cut = np.flatnonzero(key[1:] != key[:-1]) + 1
            start = 0
            for stop in cut.tolist():
                yield pairs(t.slice(start, stop - start))
                start = stop
            rest = t.slice(start)
        if rest is not None and rest.num_rows:
            yield pairs(rest)

    rows = blocks.repartition("key").sortWithinPartitions("key")
    return rows.select("key", "mixed", "side", "node", "component", "n", "m", "bits").mapInArrow(run, "a long, b long")


def similar_components(documents: DataFrame, k: int = 5, num: int = 4, den: int = 5, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_shingles, component_id: one row a document.

    Links: intersection >= num / den of the union of the sets of k-word shingles (fewer
    words: the whole sequence is one). component_id is the smallest doc_id reachable by
    links. Null, empty or blank texts have no shingles and link with nothing; equal
    texts link if they have any. Rows without a doc_id cannot be named: they link only
    with equal sets, whose component they get (null if none of those has an id). Rows
    that share a doc_id are one node if their sets are equal, else nodes of one
    component id. An empty table gives no rows; columns but doc_id and text are ignored.
    """
    rows = index(documents, k, num, den, frequent)
    # A batch holds a set's signatures on one row, which may be one without an id: sets without any id go only after all rows are grouped.
    some = rows.where("n > 0").groupBy("digest").agg(
        F.min("doc_id").alias("node"), F.first("n").alias("n"), *(F.first(c, ignorenulls=True).alias(c) for c in ("sigs", "tokens", "bits"))
    ).where("node is not null")
    sets = written(some, "jaccard-sets")
    nodes = sets.where("sigs is not null").select("node", "n", "tokens", "bits", (F.octet_length("tokens") / 6).cast("long").alias("m"))
    posted = sets.where("sigs is not null").select(F.explode("sigs").alias("sig"), "node")
    # Signatures with the same documents tell the same; one of them is kept. Two sums of hashes and a count name the documents.
    named = posted.groupBy("sig").agg(
        F.count("*").alias("size"), F.min("node").alias("leader"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(2))).alias("y"),
    )
    kept = named.where("size > 1").groupBy("size", "leader", "x", "y").agg(F.min("sig").alias("sig")).select("sig", "leader")
    posted = written(posted.join(written(kept, "jaccard-signatures"), "sig"), "jaccard-posted")

    led = posted.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    links = written(_verify(led, nodes, num, den), "jaccard-led")
    parts = connected_components(links)
    of = nodes.join(parts, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    split = written(posted.select("sig", "node").join(of, "node"), "jaccard-split")
    # Signatures whose documents are in several components stay open: written, so that the join is planned by their size.
    per = split.groupBy("sig", "component").agg(F.count("*").alias("c")).groupBy("sig")
    open_ = per.agg(F.max(F.struct("c", "component")).alias("most"), F.sum("c").alias("size"), F.count("*").alias("k")).where("k > 1")
    open_ = written(open_.select("sig", F.col("most.component").alias("top"), F.ceil(F.col("most.c") / BLOCK).alias("tops"), F.ceil((F.col("size") - F.col("most.c")) / BLOCK).alias("rests")), "jaccard-open")
    split = split.join(open_, "sig").join(nodes.select("node", "n", "m", "bits"), "node")
    # Blocks of a signature's documents: those of its largest component meet the others only, the others meet all.
    at = F.xxhash64("node", F.lit(5))
    of_top = F.col("component") == F.col("top")
    own = F.when(of_top, F.pmod(at, F.col("tops"))).otherwise(F.col("tops") + F.pmod(at, F.col("rests")))
    other = F.explode(F.sequence(F.when(of_top, F.col("tops")).otherwise(0), F.col("tops") + F.col("rests") - 1)).alias("other")
    split = split.select("sig", "node", "component", "n", "m", "bits", own.alias("own"), other)
    blocks = split.select(
        F.xxhash64("sig", F.least("own", "other"), F.greatest("own", "other")).alias("key"), (F.col("own") != F.col("other")).alias("mixed"),
        F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side"), "node", "component", "n", "m", "bits",
    )
    more = _verify(_compare(blocks, num, den).distinct(), nodes, num, den)
    parts = connected_components(links.unionByName(more))
    found = sets.select("digest", "node").join(parts, "node", "left").select("digest", F.coalesce("component", "node").alias("component_id"))
    out = rows.select("doc_id", "digest", F.col("n").alias("n_shingles")).join(found, "digest", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def op1_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    return similar_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) BETWEEN 1 AND 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM g a JOIN g b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * i >= 80 * (a.n + b.n - i)),
r AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
m AS (SELECT x, min(y) AS y FROM r GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.y, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.x = d.doc_id
"""
