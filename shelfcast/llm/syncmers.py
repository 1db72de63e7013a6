"""Document fingerprints of closed syncmers.

A k-mer of bytes is a closed syncmer if the smallest of its hashed inner substrings stands at one of
its edges. Whether it is one depends on its own bytes only, so equal stretches of two texts give
equal anchors wherever they stand, and an edit disturbs no anchor beyond ``K`` bytes. A fingerprint
holds the anchors with the smallest hashes and their first places; two fingerprints are alike by the
share of their common smallest anchors that lie at matching distances.

Each document is also compared with its successor in ascending ``doc_id`` (the last with the first)
and with an edited text that ends in the successor's beginning. Documents are dealt to tasks by
ranges of ``doc_id``; the first one of each range is sent to the range before as well.

Defined results: a null or empty text has an empty fingerprint; a text without any syncmer has one
anchor, its own hash; equal fingerprints are alike to 1, an empty and another one to 0; equal
``doc_id`` are ordered by text, null comes first; a lone document succeeds itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from shelfcast.llm.columns import ship
from shelfcast.llm.encoding import slices

INNER = 8  # bytes of an inner substring; they are compared as one 64-bit word
SPREAD = 9  # inner substrings of a k-mer
K = INNER + SPREAD - 1
SKETCH = 64  # anchors of a fingerprint

Fingerprint = dict[int, int]  # 32-bit hash to place, in ascending order of the hash


def _mixed(words: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit hash of each word."""
    words = words * np.uint64(0x9E3779B97F4A7C15)
    words ^= words >> np.uint64(29)
    words *= np.uint64(0xBF58476D1CE4E5B9)
    words ^= words >> np.uint64(32)
    return words


def syncmers(data: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and 32-bit hashes of the closed syncmers of texts laid end to end; ``row`` tells texts apart."""
    if len(data) < K:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    words = data.astype(np.uint64)
    for shift in (1, 2, 4):
        words = words[:-shift] | words[shift:] << np.uint64(8 * shift)
    inner = _mixed(words)
    least = inner
    for shift in (1, 2, 4):
        least = np.minimum(least[:-shift], least[shift:])
    count = len(data) - K + 1
    least = np.minimum(least[:count], inner[SPREAD - 1:])
    closed = (inner[:count] == least) | (inner[SPREAD - 1:] == least)
    place = np.flatnonzero(closed & (row[:count] == row[K - 1:]))
    hashes = _mixed(inner[place] ^ (inner[place + SPREAD - 1] << np.uint64(1)))
    return place, (hashes >> np.uint64(32)).astype(np.uint32)


def fingerprints(texts: Sequence[bytes]) -> list[Fingerprint]:
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(texts), np.uint8)
    place, hashes = syncmers(data, np.repeat(np.arange(len(texts), dtype=np.int32), sizes))
    bounds = np.searchsorted(place, np.r_[begins, sizes.sum()])
    found = []
    for number, text in enumerate(texts):
        own = slice(bounds[number], bounds[number + 1])
        if own.start == own.stop:
            whole = int.from_bytes(hashlib.sha256(text).digest()[:4], "big")
            found.append({whole: 0} if text else {})
            continue
        keys, first = np.unique(hashes[own], return_index=True)
        places = place[own][first[:SKETCH]] - begins[number]
        found.append(dict(zip(keys[:SKETCH].tolist(), places.tolist())))
    return found


def to_text(fingerprint: Fingerprint) -> str:
    return " ".join(f"{key:08x}@{place}" for key, place in fingerprint.items())


def likeness(one: Fingerprint, two: Fingerprint) -> float:
    """Share of the smallest anchors of both that both have, shifted by about the same distance."""
    if one == two:
        return 1.0
    if not one or not two:
        return 0.0
    smallest = sorted(one.keys() | two.keys())[:SKETCH]
    shifts = sorted(two[key] - one[key] for key in smallest if key in one and key in two)
    if not shifts:
        return 0.0
    usual = shifts[len(shifts) // 2]
    slack = max(64, max(*one.values(), *two.values()) // 8)
    return sum(abs(shift - usual) <= slack for shift in shifts) / len(smallest)


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the beginning of ``following``, or all of it."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _with_ranges(docs: DataFrame, partitions: int) -> tuple[DataFrame, int]:
    """Rows with the number of their range, and the first row of each range once more for the one before.

    Only the first id of every range reaches the driver.
    """

    def first(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([TaskContext.get().partitionId()], pa.int32()), batch.column(0).slice(0, 1)], ["range", "doc_id"]
                )
                break

    ids = docs.select("doc_id").repartitionByRange(partitions, "doc_id").sortWithinPartitions("doc_id")
    schema = T.StructType([T.StructField("range", T.IntegerType()), docs.schema["doc_id"]])
    firsts = [row["doc_id"] for row in ids.mapInArrow(first, schema).orderBy("range").collect()]
    count = max(len(firsts), 1)
    later = np.array(firsts[1:])

    @F.arrow_udf("int")
    def number(doc_ids: pa.Array) -> pa.Array:
        known = doc_ids.drop_null().to_numpy(zero_copy_only=False)
        found = np.zeros(len(doc_ids), np.int32)
        present = doc_ids.is_valid().to_numpy(zero_copy_only=False)
        found[present] = np.searchsorted(later, known, side="right") if len(later) else 0
        return pa.array(found)

    placed = docs.select("doc_id", "text", number("doc_id").alias("range"))
    begins = F.lit(False)
    if firsts:
        begins = F.coalesce(F.col("doc_id").isin([x for x in firsts if x is not None]), F.lit(firsts[0] is None))
    own = F.struct(F.col("range"), F.lit(False).alias("extra"))
    before = F.struct(F.pmod(F.col("range") - 1, F.lit(count)).alias("range"), F.lit(True).alias("extra"))
    copies = placed.select("doc_id", "text", F.explode(F.when(begins, F.array(own, before)).otherwise(F.array(own))).alias("to"))
    return copies.select("doc_id", "text", "to.*"), count


def compare_neighbours(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` per row."""
    spark = docs.sparkSession
    ship(spark)
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows, count = _with_ranges(docs.select("doc_id", "text"), partitions)
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()), T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType()),
    ])

    def compare(batches):
        held = None  # the last document read, which still needs its successor
        ended = False
        for batch in batches:
            for begin, end in slices(batch.column(1), 1 << 20):
                part = batch.slice(begin, end - begin)
                keys, texts = part.column(0).to_pylist(), [text or "" for text in part.column(1).to_pylist()]
                extra = part.column(2).to_pylist()
                if ended:
                    break
                if any(extra):  # the first extra row is the successor of the range's last document
                    stop = extra.index(True) + 1
                    keys, texts, ended = keys[:stop], texts[:stop], True
                prints = fingerprints([text.encode() for text in texts])
                if held:
                    keys, texts, prints = [held[0], *keys], [held[1], *texts], [held[2], *prints]
                held = keys[-1], texts[-1], prints[-1]
                changed = [edited(text, following).encode() for text, following in zip(texts, texts[1:])]
                changed_prints = fingerprints(changed)
                pairs = list(zip(prints, changed_prints, prints[1:]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[:-1], part.schema.field(0).type),
                        pa.array([len(text) for text in texts[:-1]], pa.int64()),
                        pa.array([hashlib.sha256(text).hexdigest() for text in changed], pa.string()),
                        pa.array([to_text(own) for own in prints[:-1]], pa.string()),
                        pa.array([to_text(own) for own in changed_prints], pa.string()),
                        pa.array([likeness(own, other) for own, other, _ in pairs], pa.float64()),
                        pa.array([likeness(own, other) for own, _, other in pairs], pa.float64()),
                    ],
                    schema.names,
                )

    return (
        rows.repartitionById(count, F.col("range"))
        .sortWithinPartitions("extra", "doc_id", "text")
        .select("doc_id", "text", "extra")
        .mapInArrow(compare, schema)
    )
