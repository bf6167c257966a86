"""Text lines of compressed files: block gzip read in splits and written, and the first lines of any file.

A block-gzip file is a chain of gzip members of up to 64 KiB that tell their own size, so a
task can begin at the first member behind any byte. Paths are reached through pyarrow's
file systems; what only Spark reaches is read by Spark's own text reader, a task a file.
"""

from __future__ import annotations

import itertools
import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

#: Compressed bytes of a split, and bytes of text in a batch.
SPLIT_BYTES, BATCH_BYTES = 32 << 20, 4 << 20
#: Tasks, about, beyond which neighbouring splits under SPLIT_BYTES are put together: each task has its start to pay.
MOST_SPLITS = 256
# Fixed values of the block-gzip format: text in a block, and the empty block that ends a file.
BLOCK_TEXT = 0xFF00
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")


def locate(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file:///"):
        path = "file:///" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path if "://" in path else "file://" + os.path.abspath(path))


def _block(head: bytes) -> int:
    """Size of the block that begins here; 0 if none does."""
    if len(head) < 18 or head[:3] != b"\x1f\x8b\x08" or not head[3] & 4:
        return 0
    at, end = 12, 12 + struct.unpack_from("<H", head, 10)[0]
    while at + 4 <= min(end, len(head)):
        name, size = head[at : at + 2], struct.unpack_from("<H", head, at + 2)[0]
        if name == b"BC" and size == 2 and at + 6 <= len(head):
            return struct.unpack_from("<H", head, at + 4)[0] + 1
        at += 4 + size
    return 0


def kind_of(path: str) -> str:
    """'blocks', 'gzip', 'text', or 'remote' where only Spark reaches the file."""
    try:
        system, where = locate(path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return "remote"
    with system.open_input_file(where) as f:
        head = f.read(64)
    return "blocks" if _block(head) else "gzip" if head[:2] == b"\x1f\x8b" else "text"


def _inflate(f, at: int) -> tuple[bytes, int]:
    """Text of the block at a place, and the place after it."""
    f.seek(at)
    raw = f.read(1 << 16)
    size = _block(raw)
    if not size or size > len(raw):
        raise ValueError(f"no whole block at byte {at}")
    data = zlib.decompress(raw[12 + struct.unpack_from("<H", raw, 10)[0] : size - 8], -15)
    if (zlib.crc32(data), len(data)) != struct.unpack_from("<II", raw, size - 8):
        raise ValueError(f"block at byte {at} is damaged")
    return data, at + size


def _first_block(f, start: int, size: int) -> int:
    """Place of the first block from start on: bytes that look like one must also inflate to what they say."""
    at = start
    while at < size:
        f.seek(at)
        window = f.read(1 << 17)
        found = window.find(b"\x1f\x8b\x08")
        while 0 <= found:
            try:
                _inflate(f, at + found)
                return at + found
            except (ValueError, zlib.error):
                found = window.find(b"\x1f\x8b\x08", found + 1)
        at += max(1, len(window) - 2)
    return size


def split_text(f, start: int, end: int, size: int) -> Iterator[bytes]:
    """Whole lines, in pieces, that belong to the blocks from start up to end.

    A split skips up to its first line end, but for a file's first, and reads on to the
    first line end behind its last block; so each line is in exactly one.
    """
    at = _first_block(f, start, size) if start else 0
    skip, kept, held = start > 0, [], 0
    while at < size:
        last = at >= end
        if last and skip:
            return
        data, at = _inflate(f, at)
        if skip:
            cut = data.find(b"\n") + 1
            if not cut:
                continue
            skip, data = False, data[cut:]
        cut = (data.find(b"\n") if last else data.rfind(b"\n")) + 1
        if last and cut:
            kept.append(data[:cut])
            break
        if not last and cut and held >= BATCH_BYTES:
            yield b"".join([*kept, data[:cut]])
            kept, held, data = [], 0, data[cut:]
        kept.append(data)
        held += len(data)
    if text := b"".join(kept):
        yield text


def _texts(data: bytes) -> list[str]:
    lines = data.decode().split("\n")
    if not lines[-1]:
        lines.pop()
    return [x.removesuffix("\r") for x in lines]


class Split(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


class BlockReader(DataSourceReader):
    """Lines of block-gzip files by splits; with the option heads, the lines that begin with # at the top of files of any kind."""

    def __init__(self, options):
        self.paths, self.heads = json.loads(options["paths"]), options.get("heads") == "true"
        self.split_bytes = int(options.get("split_bytes") or SPLIT_BYTES)

    def partitions(self):
        sizes = {}
        for path in self.paths:
            system, where = locate(path)
            sizes[path] = 0 if self.heads else system.get_file_info(where).size
        step = self.split_bytes
        if step < SPLIT_BYTES:
            step = min(SPLIT_BYTES, step * max(1, -(-sum(sizes.values()) // (step * MOST_SPLITS))))
        return [Split(path, at, at + step) for path, size in sizes.items() for at in range(0, max(size, 1), step)]

    def read(self, split: Split) -> Iterator[pa.RecordBatch]:
        system, where = locate(split.path)
        with system.open_input_file(where) as f:
            pieces = [self._head(f)] if self.heads else split_text(f, split.start, split.end, f.size())
            for piece in pieces:
                values = _texts(piece)
                yield pa.RecordBatch.from_arrays([pa.array([split.path] * len(values), pa.string()), pa.array(values, pa.string())], names=["path", "value"])

    @staticmethod
    def _head(f) -> bytes:
        """Lines at the top that begin with #, read no further than that."""
        text, unpack = b"", None
        while raw := f.read(1 << 16):
            if not text and unpack is None and raw[:2] == b"\x1f\x8b":
                unpack = zlib.decompressobj(31)
            while raw:
                if unpack is None:
                    text, raw = text + raw, b""
                else:
                    text += unpack.decompress(raw)
                    raw = unpack.unused_data
                    if raw:
                        unpack = zlib.decompressobj(31)
            ended = text.rfind(b"\n") + 1
            if ended and any(x[:1] != b"#" for x in text[text.rfind(b"\n", 0, ended - 1) + 1 :].split(b"\n") if x):
                break
        return b"".join(x + b"\n" for x in itertools.takewhile(lambda x: x[:1] == b"#", text.split(b"\n")))


class Written(WriterCommitMessage):
    def __init__(self, made: str, final: str):
        self.made, self.final = made, final


class BlockWriter(DataSourceWriter):
    """A block-gzip file a task, each with the header lines on top. Files get their names when all are written."""

    def __init__(self, options):
        self.path, self.header = options["path"], json.loads(options.get("header") or "[]")
        self.suffix = options.get("suffix") or ".gz"

    def write(self, rows) -> Written:
        system, where = locate(self.path)
        name = f"part-{uuid.uuid4().hex}{self.suffix}"
        made = f"{where}/_writing/{name}"
        system.create_dir(f"{where}/_writing", recursive=True)
        with system.open_output_stream(made, compression=None) as out:
            kept = bytearray(b"".join(x.encode() + b"\n" for x in self.header))
            for row in rows:
                kept += (row[0] or "").encode() + b"\n"
                while len(kept) >= BLOCK_TEXT:
                    out.write(packed(bytes(kept[:BLOCK_TEXT])))
                    del kept[:BLOCK_TEXT]
            if kept:
                out.write(packed(bytes(kept)))
            out.write(END)
        return Written(made, f"{where}/{name}")

    def commit(self, messages):
        system, where = locate(self.path)
        for m in messages:
            if m is not None:
                system.move(m.made, m.final)
        system.delete_dir(f"{where}/_writing")

    def abort(self, messages):
        system, where = locate(self.path)
        if system.get_file_info(f"{where}/_writing").type == fs.FileType.Directory:
            system.delete_dir(f"{where}/_writing")


def packed(text: bytes) -> bytes:
    """One block of up to BLOCK_TEXT bytes."""
    squeeze = zlib.compressobj(6, zlib.DEFLATED, -15)
    data = squeeze.compress(text) + squeeze.flush()
    if len(data) > 0xFFFF - 26:  # text that does not shrink is stored
        squeeze = zlib.compressobj(0, zlib.DEFLATED, -15)
        data = squeeze.compress(text) + squeeze.flush()
    head = b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H2sHH", 6, b"BC", 2, len(data) + 25)
    return head + data + struct.pack("<II", zlib.crc32(text), len(text))


class BlockText(DataSource):
    @classmethod
    def name(cls):
        return "block_gzip_lines"

    def schema(self):
        return "path string, value string"

    def reader(self, schema):
        return BlockReader(self.options)

    def writer(self, schema, overwrite):
        return BlockWriter(self.options)


def _plain(spark: SparkSession, files: list[str]) -> DataFrame:
    """By Spark's text reader, which takes paths as they are and names files by URIs (local ones with one slash)."""
    path = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:///")
    return spark.read.text([unquote(f) for f in files]).select(path.alias("path"), "value")


def files_of(spark: SparkSession, path) -> list[str]:
    """URIs of the files behind a path, a pattern or a list of such."""
    return spark.read.text(path).inputFiles()


def _source(spark: SparkSession, paths: list[str], **options) -> DataFrame:
    spark.dataSource.register(BlockText)
    return spark.read.format(BlockText.name()).options(paths=json.dumps(paths), **options).load()


def read_lines(spark: SparkSession, files: list[str], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """path, value: every line of files (see :func:`files_of`); block gzip in splits of compressed bytes, others by Spark's text reader."""
    blocks = [f for f in files if kind_of(f) == "blocks"]
    others = [f for f in files if f not in set(blocks)]
    parts = [_source(spark, blocks, split_bytes=split_bytes)] if blocks else []
    if others or not parts:
        parts.append(_plain(spark, others))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_heads(spark: SparkSession, files: list[str]) -> DataFrame:
    """path, value: the lines beginning with # at the top of files, read no further; files that only Spark reaches are read whole."""
    near = [f for f in files if kind_of(f) != "remote"]
    far = [f for f in files if f not in set(near)]
    parts = [_source(spark, near, heads="true")] if near else []
    if far:
        parts.append(_plain(spark, far).where(F.col("value").startswith("#")))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def write_block_gzip(lines: DataFrame, path: str, header: list[str] | None = None, suffix: str = ".gz") -> None:
    """The first column's texts as lines of block-gzip files in a folder, the header's lines on top of each."""
    lines.sparkSession.dataSource.register(BlockText)
    lines.write.format(BlockText.name()).options(path=path, header=json.dumps(header or []), suffix=suffix).mode("append").save()
