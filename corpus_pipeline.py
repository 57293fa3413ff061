"""Corpus pipeline: quality classifier, SimHash near-duplicates, personal data, packing.

STAGES are functions (spark, docs, sf_dir) -> DataFrame. Each works on all documents that the stage
before it kept, and its result is written as Parquet and read again as the next one's docs. All but the
last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from brackwater.llm.common import column, saved, table
from brackwater.llm.packing import pack
from brackwater.llm.pii import sanitised
from brackwater.llm.quality import good_documents
from brackwater.llm.simhash import near_copies


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go, and with them null texts and texts without words. No rows: no rows."""
    return good_documents(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays.

    Near-duplicates are texts whose fingerprints differ in at most four bits, and texts whose sets of five-word
    shingles have a Jaccard similarity of 0.8 or more.
    Rows of one doc_id are one document and stay or go together; rows without a doc_id stay. Null and empty texts are
    near-duplicates of each other. No rows: no rows.
    """
    gone = near_copies(docs).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*map(column, docs.columns))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and terms that disclose it are replaced by their class; n_chars, if there is one, follows the text. Null and empty texts stay. No rows: no rows."""
    return sanitised(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 2048 tokens with every source at its share. Every row is packed: null and empty texts as the end id alone, repeated rows each. No rows: no rows."""
    files = [public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken")]
    return pack(docs, *files, public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", keep_quality),
    ("simhash near-dedup", drop_near_duplicates),
    ("personal data", mask_personal_data),
    ("packing", pack_windows),
]

#: SQL expresses neither the fingerprints nor the classifier; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
