"""Media columns: interleaved document sequences of text and media references.

A page's HTML becomes an ordered array of structs: text blocks, and media references
with their digest and caption. Payloads are held once a digest, as PNG images of 8-bit
samples, and resolved by a join on the digest; a part keeps its position and caption
whatever is resolved.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import in_batches
from ._html import BLOCK, Reader, attributes, decode

#: Bytes of an image row.
ROW = 192
SCHEME = "media:sha256:"
PARTS = "array<struct<position:int,kind:string,text:string,ref:string,caption:string>>"
_PNG = b"\x89PNG\r\n\x1a\n"


def padded(payload: bytes) -> bytes:
    """Bytes 32 up to a positive multiple of a row."""
    rows = max(1, -(-len(payload) // ROW))
    return payload.ljust(rows * ROW, b" ")


def store(payload: bytes) -> bytes:
    """A payload of whole rows as an 8-bit greyscale PNG, ROW samples wide."""

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    rows = len(payload) // ROW
    lines = np.zeros((rows, ROW + 1), np.uint8)  # a filter byte of 0 before each row
    lines[:, 1:] = np.frombuffer(payload, np.uint8).reshape(rows, ROW)
    head = struct.pack(">IIBBBBB", ROW, rows, 8, 0, 0, 0, 0)
    return _PNG + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines.tobytes(), 1)) + chunk(b"IEND", b"")


def load(stored: bytes) -> np.ndarray:
    """The samples of an image that :func:`store` made, as rows."""
    if stored[:8] != _PNG:
        raise ValueError("not a PNG image")
    at, data, width, height = 8, b"", 0, 0
    while at < len(stored):
        size, kind = struct.unpack(">I4s", stored[at : at + 8])
        body = stored[at + 8 : at + 8 + size]
        if zlib.crc32(kind + body) != struct.unpack(">I", stored[at + 8 + size : at + 12 + size])[0]:
            raise ValueError("damaged image")
        if kind == b"IHDR":
            width, height = struct.unpack(">II", body[:8])
        elif kind == b"IDAT":
            data += body
        at += 12 + size
    lines = np.frombuffer(zlib.decompress(data), np.uint8).reshape(height, width + 1)
    if lines[:, 0].any():
        raise ValueError("filtered rows")
    return lines[:, 1:]


def feature(samples: np.ndarray) -> str:
    """Sixteen mean samples of equal stretches, as hex: a coarse thumbnail."""
    flat = samples.reshape(-1)
    at = np.arange(16) * len(flat) // 16
    means = np.add.reduceat(flat, at, dtype=np.int64) // np.diff(np.append(at, len(flat)))
    return bytes(means.astype(np.uint8)).hex()


class _Sequence(Reader):
    MEDIA = frozenset(("img", "video", "audio", "source", "embed"))

    def __init__(self):
        super().__init__()
        self.parts: list[dict] = []
        self.chunks: list[str] = []
        self.waiting: list[int] = []  # parts of the open figure, which its caption goes to
        self.figures = 0

    def flush(self):
        if text := " ".join("".join(self.chunks).split()):
            if "figcaption" in self.path and self.waiting:
                for i in self.waiting:
                    self.parts[i]["caption"] = " ".join(filter(None, [self.parts[i]["caption"], text]))
            else:
                self.parts.append({"kind": "text", "text": text, "ref": None, "caption": None})
        self.chunks = []

    def start(self, tag, attrs):
        if tag in BLOCK:
            self.flush()
        if tag == "figure":
            self.figures += 1
        if tag in self.MEDIA and (a := attributes(attrs)).get("src"):
            self.flush()
            self.parts.append({"kind": "media", "text": None, "ref": a["src"], "caption": a.get("alt") or None})
            if self.figures:
                self.waiting.append(len(self.parts) - 1)

    def end(self, tag):
        if tag == "figcaption":
            self.path.append(tag)  # the caption's own text still belongs to it
            self.flush()
            self.path.pop()
        elif tag in BLOCK:
            self.flush()
        if tag == "figure":
            self.figures -= 1
            if not self.figures:
                self.waiting = []

    def text(self, chunk):
        self.chunks.append(decode(chunk))


def sequence(html: str | None) -> list[dict]:
    """Ordered parts of a page: kind text (text) or media (ref, caption), with their position."""
    reader = _Sequence()
    reader.read(html or "")
    reader.flush()
    return [{"position": i, **x} for i, x in enumerate(reader.parts)]


def parse_sequences(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """key, parts: every page as an interleaved sequence.

    Null or empty html, or a page without text and media: no parts. Repeated rows and
    null keys are rows like others; an empty table gives no rows; other columns are ignored.
    """
    kind = pages.schema[key].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = pa.struct([("position", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("ref", pa.string()), ("caption", pa.string())])
        for batch in in_batches(batches):
            parts = [sequence(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(parts, pa.list_(part))], names=["key", "parts"])

    return pages.select(key, "html").mapInArrow(task, f"key {kind}, parts {PARTS}").withColumnRenamed("key", key)


def store_payloads(payloads: DataFrame) -> DataFrame:
    """digest, n_bytes, stored: one row a distinct payload (binary column ``payload``; null: empty).

    Equal payloads are met before the shuffle and after it, so a payload that many rows
    share is sent once a task.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_batches(batches):
            raw = list(dict.fromkeys(x or b"" for x in batch.column(0).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([hashlib.sha256(x).hexdigest() for x in raw], pa.string()),
                    pa.array(map(len, raw), pa.int64()),
                    pa.array([store(padded(x)) for x in raw], pa.binary()),
                ],
                names=["digest", "n_bytes", "stored"],
            )

    rows = payloads.select("payload").mapInArrow(task, "digest string, n_bytes long, stored binary")
    return rows.groupBy("digest").agg(F.first("n_bytes").alias("n_bytes"), F.first("stored").alias("stored"))


def read_back(media: DataFrame) -> DataFrame:
    """What the stored bytes hold: digest, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_batches(batches):
            rows = []
            for stored in batch.column(2).to_pylist():
                samples = load(stored)
                payload = samples.tobytes()
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(stored), hashlib.sha256(stored).hexdigest(), feature(samples)))
            c = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(x, pa.string() if i in (1, 4, 5) else pa.int64()) for i, x in enumerate(c))],
                names=["digest", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"],
            )

    return media.select("digest", "n_bytes", "stored").mapInArrow(
        task, "digest string, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    )


def resolve(sequences: DataFrame, media: DataFrame, key: str = "page_id") -> DataFrame:
    """One row a media part: key, position, caption and the columns of media by digest.

    They are null where no payload is known, or the reference is to another scheme. A
    page that shows a payload twice, or is there twice, has a row each time; a page without media has
    none. media: one row a digest, as :func:`store_payloads` gives it.
    """
    refs = sequences.select(key, F.explode("parts").alias("part")).where("part.kind = 'media'")
    refs = refs.select(key, "part.position", "part.caption", F.when(F.col("part.ref").startswith(SCHEME), F.substring("part.ref", len(SCHEME) + 1, 64)).alias("digest"))
    return refs.join(media, "digest", "left")


def shown(payload_digest: Column, text: Column, caption: Column) -> Column:
    """HTML of a page that tells a text line by line and, in the middle of the lines, shows a payload in a figure."""
    plain = F.coalesce(text, F.lit(""))
    for sign, reference in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        plain = F.replace(plain, F.lit(sign), F.lit(reference))
    lines = F.split(plain, "\n")
    half = F.floor(F.size(lines) / 2).cast("int")
    told = lambda x: F.concat(F.lit("<p>"), F.array_join(x, "</p><p>"), F.lit("</p>"))
    figure = F.concat(F.lit(f"<figure><img src='{SCHEME}"), payload_digest, F.lit("'><figcaption>"), caption, F.lit("</figcaption></figure>"))
    return F.concat(F.lit("<article>"), told(F.slice(lines, 1, half)), figure, told(F.slice(lines, half + 1, F.size(lines) - half)), F.lit("</article>"))


def op7_media_columns(spark, sf_dir: str) -> DataFrame:
    """Each document as a page of its lines, amid which it shows its own text's payload, captioned with its id."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("payload"))
    html = shown(F.sha2("payload", 256), F.col("text"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none")))
    parts = parse_sequences(docs.select("doc_id", html.alias("html")), "doc_id")
    found = resolve(parts, read_back(store_payloads(docs)), "doc_id")
    return found.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "position", "caption")
