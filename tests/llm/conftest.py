import sys
from pathlib import Path

import pytest
from pyspark.sql import types as T

from shelfcast.llm.columns import tokenizer_file

sys.path.insert(0, str(Path(__file__).resolve().parent))

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) pairs or full rows; several partitions."""

    def build(rows, **extra):
        full = [(*row, "en", "s", len(row[1] or ""))[:5] if len(row) == 2 else row for row in rows]
        docs = spark.createDataFrame(full, SCHEMA).repartition(3)
        for name, value in extra.items():
            docs = docs.selectExpr("*", f"{value} AS {name}")
        return docs

    return build


@pytest.fixture(scope="session")
def tokenizer_path():
    return tokenizer_file("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def ranks_path():
    return tokenizer_file("byte_bpe_50k.tiktoken")
