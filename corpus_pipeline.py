"""Document pipeline: each stage is written as Parquet and reread as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wayloom.llm import exactdedup, langid, ngramjoin, queries, winnow
from wayloom.llm.common import materialize, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told go: no text, no letter, or far from every centroid."""
    model = langid.train(docs.where(langid.fold() != 2))
    return langid.identify(docs, model, keep=tuple(COLUMNS)).where("not rejected").select(*COLUMNS)


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, the one with the largest id."""
    return exactdedup.drop_exact_copies(docs).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked near copies stays, the one with the smallest id."""
    return ngramjoin.drop_near_duplicates(docs, width=5, percent=80).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by benchmark items go."""
    return winnow.drop_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's token ids (byte_bpe_50k and an end mark), cut into pieces and laid out in sequences of several lengths."""
    return queries.packed(docs)


STAGES = [
    ("language ID", language),
    ("exact dedup", copies),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", decontaminate),
    ("best-fit packing", pack),
]

#: SQL cannot express a trained language identifier or best-fit packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents that every stage keeps: doc_id, n_tokens, piece, piece_start, piece_len, bin_id, bin_offset, capacity, bin_crc32."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
