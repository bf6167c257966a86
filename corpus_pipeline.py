"""Corpus pipeline: documents through operators of the llm subpackage, one stage at a time.

toxicity -> quality -> near duplicates -> mixing -> packing. Each stage works on all
rows that its predecessor kept, with their columns; the last returns packed pieces.
The classifiers learn from the labelled rows among the documents that they are given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from pedigrove.llm import _common, mixing, ngram_jaccard, packing, quality, toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _labels(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def drop_toxic(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go.

    Null and empty texts are scored as texts without words, repeated rows alike; rows
    without an id are scored and kept or dropped by their texts. Without labels nothing
    goes; an empty table stays empty. Columns other than those of documents are left out.
    """
    return toxicity.drop_toxic(docs.select(COLUMNS), toxicity.train(docs, _labels(spark, sf_dir)))


def keep_good(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    Odd rows as in :func:`drop_toxic`: a null text is an empty one and is scored, repeated
    rows are scored alike, without labels nothing goes.
    """
    return quality.keep_good(docs.select(COLUMNS), quality.train(docs, _labels(spark, sf_dir)))


def drop_near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays.

    Repeated rows of one id stay or go together; rows without an id stay.
    """
    found = ngram_jaccard.similar_components(docs)
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.select(COLUMNS).join(gone, "doc_id", "left_anti").select(COLUMNS)


def mix_sources(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated or left out so that sources meet their target weights.

    A null source is one of its own, last. Rows without words are taken 0 times. Repeated
    rows and rows without an id are rows like others; an empty table stays empty.
    """
    return mixing.repeat_rows(mixing.mix(docs.select(COLUMNS))).select(COLUMNS)


def pack_sequences(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences: doc_id, start, length and place of each.

    A null text is an empty one and gives its end id; repeated rows are packed one by one,
    rows without an id too. An empty table gives no piece.
    """
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]
ORACLE_SQL = None  # stages cannot be said in SQL; tests/llm hold them against brute force


def run(spark, sf_dir: str) -> DataFrame:
    """The stages applied to documents in turn; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = _common.written(stage(spark, docs, sf_dir), name)
    return docs
