"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

``encode`` gives each text's ids as little-endian unsigned 32-bit integers in a binary column,
``decode`` the raw bytes of such ids. Long texts are encoded in stretches cut at safe boundaries: in
front of white space that follows something else, where no match of the pre-splitting pattern can
reach across.

Defined results: a null or empty text has no ids (empty binary); null ids decode to empty bytes; ids
outside the ranks raise; text that looks like a special token is ordinary text. Extra columns do not
pass through.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.llm.columns import ship
from shelfcast.llm.encoding import PATTERN

STRETCH = 1 << 16  # characters of a long text encoded at once
_CUT = regex.compile(r"(?<=\S)(?=\s)")
_codecs: dict[str, object] = {}


def codec(ranks: str):
    """The worker's tiktoken encoding for a rank file; loaded once per worker."""
    if ranks not in _codecs:
        import tiktoken

        with open(ranks, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        table = {base64.b64decode(token): int(rank) for token, rank in pairs}
        _codecs[ranks] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
    return _codecs[ranks]


def stretches(text: str, length: int = STRETCH):
    """``text`` in pieces of at least ``length`` characters that are encoded independently."""
    begin = 0
    while len(text) - begin > length:
        cut = _CUT.search(text, begin + length)
        if cut is None:
            break
        yield text[begin:cut.start()]
        begin = cut.start()
    yield text[begin:]


def encode_text(ranks: str, text: str | None) -> np.ndarray:
    if not text:
        return np.empty(0, "<u4")
    known = codec(ranks)
    if len(text) <= STRETCH:
        return np.array(known.encode_ordinary(text), "<u4")
    return np.concatenate([np.array(known.encode_ordinary(part), "<u4") for part in stretches(text)])


def _encoder(ranks: str):
    @F.arrow_udf("binary")
    def encode(texts: pa.Array) -> pa.Array:
        return pa.array([encode_text(ranks, text.as_py()).tobytes() for text in texts], pa.binary())

    return encode


def _counter(ranks: str):
    @F.arrow_udf("bigint")
    def count(texts: pa.Array) -> pa.Array:
        return pa.array([len(encode_text(ranks, text.as_py())) for text in texts], pa.int64())

    return count


def _decoder(ranks: str):
    @F.arrow_udf("binary")
    def decode(ids: pa.Array) -> pa.Array:
        known = codec(ranks)
        return pa.array(
            [known.decode_bytes(np.frombuffer(item.as_py() or b"", "<u4").tolist()) for item in ids], pa.binary()
        )

    return decode


def encode_ids(text: Column, ranks: str) -> Column:
    """Ids of a text column, 4 bytes each."""
    return _encoder(ranks)(text)


def count_ids(text: Column, ranks: str) -> Column:
    """Number of ids of a text column."""
    return _counter(ranks)(text)


def decode_ids(ids: Column, ranks: str) -> Column:
    """Raw bytes that ids stand for; they need not be valid UTF-8."""
    return _decoder(ranks)(ids)


def encode(docs: DataFrame, ranks: str) -> DataFrame:
    """``doc_id, ids, n_tokens`` of every text."""
    ship(docs.sparkSession)
    ids = docs.select("doc_id", encode_ids(F.col("text"), ranks).alias("ids"))
    return ids.withColumn("n_tokens", F.shiftright(F.octet_length("ids").cast("long"), 2))


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of ``ids``."""
    ship(encoded.sparkSession)
    return encoded.select("doc_id", "ids", "n_tokens", decode_ids(F.col("ids"), ranks).alias("decoded"))
