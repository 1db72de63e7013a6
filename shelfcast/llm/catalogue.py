"""The numbered queries, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.llm import (
    byte_pairs,
    embedding_forest,
    jaccard_join,
    language_id,
    packing,
    periodic_runs,
    quality_outliers,
    substring_dedup,
    syncmers,
    token_alignment,
    token_counts,
    toxicity,
    wavelet,
)
from shelfcast.llm.columns import documents, tokenizer_file


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length histogram of all documents with the answers for every context limit."""
    lengths = token_counts.document_lengths(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.tiktoken"))
    return token_counts.limit_table(token_counts.length_histogram(lengths))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and place."""
    packed = packing.pack(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"))
    return packed.place(["doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")])


def op3_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and its likeness to its edited text and its successor."""
    return syncmers.compare_neighbours(documents(spark, sf_dir))


def op4_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, size and checksum of every document's ids, read back from wavelet shards."""
    shards = wavelet.write_shards(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"))
    return wavelet.read_shards(shards).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the bytes decoded from them."""
    ranks = tokenizer_file("byte_bpe_50k.tiktoken")
    decoded = byte_pairs.decode(byte_pairs.encode(documents(spark, sf_dir), ranks), ranks)
    return decoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; a quarter of the documents is never learned from."""
    docs = documents(spark, sf_dir)
    return language_id.identify(docs, language_id.fit(docs))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity verdict and category probabilities of every document."""
    docs = documents(spark, sf_dir)
    return toxicity.classify(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document, how many of them repeated passages cover, and the digest of the rest."""
    rest = substring_dedup.remove_repeats(documents(spark, sf_dir))
    return rest.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality_outliers.verdicts(documents(spark, sf_dir)).drop("lang", "source")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle count and component of every document."""
    return jaccard_join.join_components(documents(spark, sf_dir))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, with some tails made periodic, and digests of the runs and of the rest."""
    return periodic_runs.digest(periodic_runs.find_runs(periodic_runs.with_repeated_tails(documents(spark, sf_dir))))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers, scored by counts over all documents."""
    files = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    return token_alignment.alignment_counts(documents(spark, sf_dir), *files)


def op13_embedding_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector among those of its label."""
    return embedding_forest.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_packing": op2_packing,
    "op3_syncmers": op3_syncmers,
    "op4_wavelet": op4_wavelet,
    "op5_byte_pairs": op5_byte_pairs,
    "op6_language_id": op6_language_id,
    "op7_toxicity": op7_toxicity,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_quality_outliers": op9_quality_outliers,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_token_alignment": op12_token_alignment,
    "op13_embedding_forest": op13_embedding_forest,
}

ORACLE: dict[str, str] = {}
