"""Corpus preparation as stages over ``documents``; each is written as Parquet and read by the next.

Every stage works on all rows that the one before kept. Toxicity, language identification and the
Jaccard join drop rows, substring deduplication cuts passages from ``text``, and packing turns the
documents into pieces with their places in sequences. All but the last return the columns of
``documents``. Empty tables, null cells and extra columns pass through the first four stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.llm import jaccard_join, language_id, packing, substring_dedup, toxicity
from shelfcast.llm.columns import documents, tokenizer_file
from shelfcast.session import new_shared_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that the classifier chain finds toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.fit(docs, labels))


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return language_id.keep_confident(docs, language_id.fit(docs))


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies."""
    return jaccard_join.keep_one_row_each(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that occur more than once."""
    return substring_dedup.cut_repeats(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and place."""
    packed = packing.pack(docs, tokenizer_file("byte_bpe_50k.json"))
    return packed.place(["doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")])


STAGES = [
    ("toxicity", drop_toxic),
    ("language ID", keep_known_languages),
    ("n-gram Jaccard join", keep_one_of_similar),
    ("substring dedup", cut_repeated_passages),
    ("best-fit packing", pack_sequences),
]

ORACLE_SQL = None  # the learned stages and the packing have no SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the whole table."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = new_shared_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
