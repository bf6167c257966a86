"""Sum-of-squares online packing of tokenised documents into fixed windows."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ._tokens import encode, ranks_path

LENGTH = 2048

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Packer:
    """One task's windows. A piece is (doc_id, start, ids, doc_tokens).

    counts[h] is the number of open windows filled to level h. A piece of size s goes to
    the level h (0: a new window) that makes the sum of squared counts least: it takes a
    window from h and puts one at h + s, which changes the sum by
    2 * (counts[h + s] - counts[h]) + 2; a window that becomes full no longer counts.
    Ties go to the fullest level. Windows stay open until they are full: what is held is
    the ids of the task's own rows in them, four bytes a token, which the size of an
    input split bounds.
    """

    def __init__(self, length: int, base: int):
        self.length, self.next_id = length, base
        self.counts = np.zeros(length + 1, np.int64)
        self.windows: list[list[list[tuple]]] = [[] for _ in range(length + 1)]
        self.done: list[tuple] = []

    def close(self, pieces: list[tuple]) -> None:
        offset, sequence, self.next_id = 0, self.next_id, self.next_id + 1
        for doc_id, start, ids, total in pieces:
            self.done.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), total, sequence, offset))
            offset += len(ids)

    def level_for(self, size: int) -> int:
        """Level of the window to take; 0 opens one."""
        counts, full = self.counts, self.length
        after = counts[size : full + 1].copy()  # windows at h + size, for h = 0 ... full - size
        after[-1] = -1  # a full window leaves the sum: -2 counts[h] + 1 instead of + 2
        cost = 2 * (after - counts[: full - size + 1]) + 2
        cost[-1] += 1
        cost[1:][counts[1 : full - size + 1] == 0] = np.iinfo(np.int64).max
        cost[0] = 2 * counts[size] + 1
        return full - size - int(np.argmin(cost[::-1]))

    def place(self, piece: tuple) -> None:
        size = len(piece[2])
        if size == self.length:
            self.close([piece])
            return
        level = self.level_for(size)
        if level:
            window = self.windows[level].pop()
            self.counts[level] -= 1
        else:
            window = []
        window.append(piece)
        if level + size == self.length:
            self.close(window)
            return
        self.windows[level + size].append(window)
        self.counts[level + size] += 1

    def add(self, doc_id, ids: np.ndarray) -> None:
        ids, total = np.ascontiguousarray(ids, "<u4"), len(ids)
        for start in range(0, total, self.length):
            self.place((doc_id, start, ids[start : start + self.length], total))

    def recut(self) -> None:
        """In the end, pieces of all open windows, fullest first, cut anew into full windows and the last tokens into powers of two."""
        pieces = [p for level in reversed(self.windows) for window in level for p in window]
        self.windows = [[] for _ in range(self.length + 1)]
        self.counts[:] = 0
        left = sum(len(p[2]) for p in pieces)
        window: list[tuple] = []
        room = goal = min(self.length, 1 << left.bit_length() - 1) if left else 0
        for doc_id, start, ids, total in pieces:
            while len(ids):
                part, ids = ids[:room], ids[room:]
                window.append((doc_id, start, part, total))
                start, room = start + len(part), room - len(part)
                if not room:
                    self.close(window)
                    window, left = [], left - goal
                    room = goal = min(self.length, 1 << left.bit_length() - 1) if left else 0

    def take(self) -> list[tuple]:
        done, self.done = self.done, []
        return done


def pack(documents: DataFrame, length: int = LENGTH, end_id: int = 1, tokenizer: str | None = None) -> DataFrame:
    """Packs every row's tokens and end_id into sequences of at most ``length`` (a power of two).

    Documents longer than a window are cut at its multiples; what remains is placed by
    the sum of squares. Each task packs its own rows as they come, with no shuffle, and
    in the end cuts the windows it has not filled anew: into full ones, and the last
    tokens into sequences at powers of two, so that nothing is padded.

    Null or empty text: end_id alone. Repeated rows and null ids are packed row by row.
    An empty table gives no pieces; columns other than doc_id and text are ignored.
    tokenizer: path of the ranks file; the vocabulary files are never copied.
    """
    path = tokenizer or ranks_path()
    out = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(length, TaskContext.get().partitionId() << 40)
        end = np.array([end_id], np.uint32)

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*packer.take())], schema=out)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                packer.add(doc_id, np.concatenate([encode(text.as_py(), path, True), end]))
                if len(packer.done) >= 20_000:
                    yield rows()
        packer.recut()
        if packer.done:
            yield rows()

    return documents.select("doc_id", "text").mapInArrow(task, SCHEMA)


def op4_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
