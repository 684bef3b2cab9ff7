"""Corpus pipeline: quality rules, line dedup, near-dedup, mixing and piece encoding of ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of ``documents``. The rows of a stage are written as Parquet and read again by the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.common import materialize
from helixframe.llm.line_dedup import dedup_lines
from helixframe.llm.mixing import mix_documents
from helixframe.llm.near_dedup import drop_near_duplicates
from helixframe.llm.quality_rules import keep_quality
from helixframe.llm.sentencepiece_sampling import sample_pieces
from helixframe.operators.shared import remove, temporary

#: Documents of this similarity or more of their five-word shingles, in percent, are near duplicates.
NEAR_PERCENT = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the compression bands keep.

    Null and empty texts go; a null id, source or length changes nothing. Repeated rows stay or go
    alike. Columns of any names pass. Texts of any length are judged whole. Empty gives empty.
    """
    return keep_quality(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that a document with a smaller id holds; n_chars counts what is left.

    Null texts become empty; rows with a null id are compared with nothing; rows with equal ids are
    one document. Tied lines of a document stay or go alike. Other columns pass, whatever their names.
    Texts of any length are read whole. Empty gives empty.
    """
    found = dedup_lines(docs).withColumn("text", F.col("kept_text")).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked by a similarity of 0.8 or more.

    Texts without words and rows with a null id stay. Rows that repeat the id which stays, stay with
    it. Columns of any names pass. Texts of any length are compared whole. Empty gives empty.
    """
    return drop_near_duplicates(docs, percent=NEAR_PERCENT)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    Texts without words are not taken; null sources are one source; a null id is an id like others.
    Ties in the random order are broken by id, size and text, and repeated rows are taken together.
    Columns of any names pass. Empty gives empty.
    """
    return mix_documents(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_pieces, ids_sha256, lossless, ids) of each document; copies of one document are segmented each in its own way.

    Null texts have no pieces; a null id is a key like others. Texts of any length are read whole.
    Other columns are left out, whatever their names. Empty gives empty.
    """
    return sample_pieces(docs, number_copies=True).withColumnRenamed("doc", "doc_id")


STAGES = [("quality rules", quality), ("line dedup", lines), ("near-dedup", near_duplicates), ("mixing", mixture), ("pieces", pieces)]

#: zstandard ratios, SuperMinHash and piece lattices are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What a stage wrote on its way is removed once its rows are written."""
    docs, kept = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for _, stage in STAGES[:-1]:
        with temporary(spark) as written:
            docs = materialize(stage(spark, docs, sf_dir))
            kept.append(written.pop())
        if len(kept) > 1:
            remove(spark, [kept.pop(0)])
    return STAGES[-1][1](spark, docs, sf_dir)
