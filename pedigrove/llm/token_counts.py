"""Token counts: separator scan over flat, unindexed token files."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import new_path, written
from ._tokens import encode, ranks_path

#: Tokens of a block: what a task reads at once.
BLOCK = 2_000_000
SEPARATOR = 50256


def _open(uri: str):
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri) if ":" in uri else f"file://{uri}")


def write_token_files(documents: DataFrame, path: str, separator: int = SEPARATOR, tokenizer: str | None = None) -> DataFrame:
    """Writes documents' ids, each document followed by the separator, as flat little-endian 16-bit files.

    One file a task, path/part-<task>.bin, written under a name of its own attempt and
    then moved, so that a repeated task replaces its file. Returns, once written, file,
    doc_index, doc_id: which document stands where, for comparison only; the files
    carry no index. The separator never comes from a text: its string is ordinary text.
    A null or empty text is a document of no tokens; repeated rows and null ids are
    documents of their own; an empty table gives no rows. Other columns are ignored.
    """
    ranks = tokenizer or ranks_path()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        fs, folder = _open(path)
        fs.create_dir(folder, recursive=True)
        name = f"part-{context.partitionId():06d}.bin"
        draft = f"{folder}/_{name}.{context.taskAttemptId()}"
        ids: list = []
        with fs.open_output_stream(draft) as f:
            for batch in batches:
                for text in batch.column(1):
                    f.write(np.append(encode(text.as_py(), ranks, False), separator).astype("<u2").tobytes())
                ids += batch.column(0).to_pylist()
        fs.move(draft, f"{folder}/{name}")
        yield pa.RecordBatch.from_pydict({"file": pa.array([name] * len(ids), pa.string()), "doc_index": pa.array(range(len(ids)), pa.int64()), "doc_id": pa.array(ids, pa.int64())})

    return written(documents.select("doc_id", "text").mapInArrow(task, "file string, doc_index long, doc_id long"), "token-names")


def scan_separators(spark: SparkSession, path: str, separator: int = SEPARATOR, block: int = BLOCK, width: int = 2) -> DataFrame:
    """Where the separators of flat token files stand: file, block, first, n, ends (positions, ascending).

    Files are listed, not read, by Spark; each block is then read by one task and
    searched in one vectorised comparison. An empty file, or a folder of none, has no blocks.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(path).where("length > 0").select("path", "length")
    blocks = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("length") / (block * width)) - 1)).alias("block"))
    blocks = blocks.repartition(F.col("path"), F.col("block"))
    kind = f"<u{width}"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, name = _open(row["path"])
                first = row["block"] * block
                with fs.open_input_file(name) as f:
                    ids = np.frombuffer(f.read_at(min(block * width, row["length"] - first * width), first * width), kind)
                ends = first + np.flatnonzero(ids == separator)
                yield pa.RecordBatch.from_pydict({
                    "file": pa.array([name.rpartition("/")[2]]),
                    "block": pa.array([row["block"]], pa.int64()),
                    "first": pa.array([first], pa.int64()),
                    "n": pa.array([len(ids)], pa.int64()),
                    "ends": pa.array([ends], pa.list_(pa.int64())),
                })

    return blocks.mapInArrow(task, "file string, block long, first long, n long, ends array<bigint>")


def stitch(scanned: DataFrame) -> DataFrame:
    """Documents of scanned blocks: file, doc_index, start, n_tokens (without separator), ended.

    A prefix scan over the blocks of a file gives each block the number of documents that
    ended before it and where the one it opens with began. It moves one small row a
    block (how many separators, the last one); the arrays of separators stay where they
    are, meet the result by (file, block), and become documents there. Tokens after a
    file's last separator are a document with ended = false; two separators in a row
    enclose a document of no tokens. No blocks give no rows.
    """
    scanned = written(scanned, "separators")  # read twice, so that the files are not
    heads = scanned.select("file", "block", F.size("ends").alias("k"), F.array_max("ends").alias("last"), (F.col("first") + F.col("n")).alias("stop"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.select(
        "file",
        "block",
        F.coalesce(F.sum("k").over(earlier), F.lit(0)).alias("base"),
        F.coalesce(F.max("last").over(earlier) + 1, F.lit(0)).alias("open"),
        (F.col("stop") == F.max("stop").over(Window.partitionBy("file"))).alias("closes"),
    )
    s = scanned.join(written(heads, "block-heads"), ["file", "block"])
    begin = lambda i: F.when(i == 0, F.col("open")).otherwise(F.get("ends", i - 1) + 1)
    found = F.transform("ends", lambda x, i: F.struct((F.col("base") + i).alias("doc_index"), begin(i).alias("start"), (x - begin(i)).alias("n_tokens"), F.lit(True).alias("ended")))
    stop, open_ = F.col("first") + F.col("n"), F.coalesce(F.get("ends", F.size("ends") - 1) + 1, F.col("open"))
    rest = F.struct((F.col("base") + F.size("ends")).alias("doc_index"), open_.alias("start"), (stop - open_).alias("n_tokens"), F.lit(False).alias("ended"))
    rest = F.when(F.col("closes") & (open_ < stop), F.array(rest)).otherwise(F.filter(F.array(rest), lambda x: F.lit(False)))
    return s.select("file", F.explode(F.concat(found, rest)).alias("d")).select("file", "d.*")


def op10_token_counts(spark, sf_dir: str) -> DataFrame:
    """Every document's tokens, counted in flat files that hold the whole of ``documents``."""
    path = new_path(spark, "tokens")
    names = write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    if names.isEmpty():
        return spark.createDataFrame([], "doc_id long, file string, doc_index long, start long, n_tokens long")
    # Merged, not broadcast: the arrays of separators look small to the planner until they are exploded.
    counted = stitch(scan_separators(spark, path)).hint("merge")
    return names.join(counted, ["file", "doc_index"]).select("doc_id", "file", "doc_index", "start", "n_tokens")
