"""Token ids in wavelet matrices, one per shard.

Documents are put in ascending order of their ids, encoded, and cut into shards at document ends. A
shard file holds the document table and a wavelet matrix of its ids: one bit-plane per bit of the
largest id, each with counts of ones per block. From the file alone ids can be read at any place,
counted and looked up. Shards are stored as rows of a Parquet table in the shared folder, with their
place among their task's ids; each task's first place follows from the totals per task.

Defined results: null and empty texts are a single end id; equal document ids are ordered by text,
null ids come first; an empty table gives no shards and no rows.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from shelfcast.llm.columns import ship
from shelfcast.llm.encoding import encoder, slices
from shelfcast.session import new_shared_path

MAGIC = b"WVMX"
HEADER = struct.Struct("<4sHHQQ")  # magic, version, planes, documents, ids
BLOCK = 512  # bits between stored counts
SHARD_IDS = 1 << 20
ENCODED_BYTES = 8 << 20  # of texts encoded at once; the more, the fewer chunks are looked up again


@dataclass(frozen=True)
class Plane:
    bits: np.ndarray  # packed, little end first
    ones: np.ndarray  # before each block
    zeros: int

    @staticmethod
    def of(bit: np.ndarray) -> "Plane":
        bits = np.packbits(bit, bitorder="little")
        padded = np.zeros(-(-len(bits) // (BLOCK // 8)) * (BLOCK // 8), np.uint8)
        padded[:len(bits)] = bits
        per_block = np.bitwise_count(padded.view(np.uint64)).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.uint32)
        ones = np.zeros(len(per_block) + 1, np.uint32)
        np.cumsum(per_block, out=ones[1:])
        return Plane(bits, ones, len(bit) - int(ones[-1]))

    def bit(self, at: int) -> int:
        return int(self.bits[at >> 3]) >> (at & 7) & 1

    def rank(self, at: int) -> int:
        """Ones before ``at``."""
        block = at // BLOCK
        whole = self.bits[block * (BLOCK // 8):at >> 3]
        count = int(self.ones[block]) + int(np.bitwise_count(whole).sum())
        return count + (int(self.bits[at >> 3]) & ((1 << (at & 7)) - 1)).bit_count() if at & 7 else count

    def select(self, bit: int, number: int) -> int:
        """Place of the one or zero with ``number`` such bits before it."""
        before = self.ones if bit else np.arange(len(self.ones)) * BLOCK - self.ones.astype(np.int64)
        block = int(np.searchsorted(before[:-1], number, side="right")) - 1
        part = np.unpackbits(self.bits[block * (BLOCK // 8):(block + 1) * (BLOCK // 8)], bitorder="little")
        return block * BLOCK + int(np.flatnonzero(part == bit)[number - int(before[block])])


class WaveletMatrix:
    """Ids as bit-planes, the highest bit first; in each plane zeros go before ones to the next."""

    def __init__(self, length: int, planes: list[Plane]):
        self.length, self.planes = length, planes

    @staticmethod
    def of(ids: np.ndarray) -> "WaveletMatrix":
        depth = max(int(ids.max()).bit_length(), 1) if len(ids) else 1
        rest = ids.astype(np.uint16 if depth <= 16 else np.uint32)
        planes = []
        for place in range(depth - 1, -1, -1):
            planes.append(Plane.of((rest >> place & 1).astype(bool)))
            # Arrow filters by packed bits, several times as fast as numpy by a mask of mixed values.
            ones = pa.BooleanArray.from_buffers(pa.bool_(), len(rest), [None, pa.py_buffer(planes[-1].bits)])
            parts = [pa.array(rest).filter(picked).to_numpy() for picked in (pc.invert(ones), ones)]
            rest = np.concatenate(parts)
        return WaveletMatrix(len(ids), planes)

    def ids(self) -> np.ndarray:
        """All ids, from the lowest plane up."""
        known = np.zeros(self.length, np.uint32 if len(self.planes) > 16 else np.uint16)
        for place, plane in enumerate(reversed(self.planes)):
            bit = np.unpackbits(plane.bits, count=self.length, bitorder="little").view(bool)
            above = np.empty_like(known)
            above[np.flatnonzero(~bit)] = known[:plane.zeros]
            above[np.flatnonzero(bit)] = known[plane.zeros:] | known.dtype.type(1 << place)
            known = above
        return known.astype("<u4")

    def access(self, at: int) -> int:
        """The id at a place."""
        value = 0
        for plane in self.planes:
            bit = plane.bit(at)
            at = plane.zeros + plane.rank(at) if bit else at - plane.rank(at)
            value = value << 1 | bit
        return value

    def _range(self, token: int, end: int) -> tuple[int, int]:
        low, high = 0, end
        if token >> len(self.planes):
            return 0, 0
        for place, plane in enumerate(self.planes):
            before_low, before_high = plane.rank(low), plane.rank(high)
            if token >> (len(self.planes) - 1 - place) & 1:
                low, high = plane.zeros + before_low, plane.zeros + before_high
            else:
                low, high = low - before_low, high - before_high
        return low, high

    def rank(self, token: int, end: int) -> int:
        """Occurrences of ``token`` before place ``end``."""
        low, high = self._range(token, end)
        return high - low

    def count(self, token: int) -> int:
        return self.rank(token, self.length)

    def select(self, token: int, number: int) -> int:
        """Place of the occurrence with ``number`` others before it."""
        low, high = self._range(token, self.length)
        if not 0 <= number < high - low:
            raise IndexError(f"token {token} occurs {high - low} times")
        at = low + number
        for place, plane in enumerate(reversed(self.planes)):
            bit = token >> place & 1
            at = plane.select(bit, at - plane.zeros if bit else at)
        return at

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, number) for number in range(self.count(token))]


@dataclass(frozen=True)
class Shard:
    doc_ids: list[int | None]
    sizes: np.ndarray
    matrix: WaveletMatrix

    def to_bytes(self) -> bytes:
        missing = np.array([doc_id is None for doc_id in self.doc_ids], np.uint8)
        keys = np.array([doc_id or 0 for doc_id in self.doc_ids], "<i8")
        planes = self.matrix.planes
        parts = [HEADER.pack(MAGIC, 1, len(planes), len(keys), self.matrix.length)]
        parts += [missing.tobytes(), keys.tobytes(), self.sizes.astype("<u8").tobytes()]
        parts += [plane.ones.astype("<u4").tobytes() + plane.bits.tobytes() for plane in planes]
        return b"".join(parts)

    @staticmethod
    def from_bytes(data: bytes) -> "Shard":
        magic, version, depth, documents, length = HEADER.unpack_from(data)
        if magic != MAGIC or version != 1:
            raise ValueError("not a wavelet shard of version 1")
        at = HEADER.size

        def read(kind: str, count: int) -> np.ndarray:
            nonlocal at
            values = np.frombuffer(data, kind, count, at)
            at += values.nbytes
            return values

        missing, keys, sizes = read("u1", documents), read("<i8", documents), read("<u8", documents)
        planes = []
        for _ in range(depth):
            ones = read("<u4", -(-(-(-length // 8)) // (BLOCK // 8)) + 1)
            planes.append(Plane(read("u1", -(-length // 8)), ones, length - int(ones[-1])))
        doc_ids = [None if gone else key for gone, key in zip(missing.tolist(), keys.tolist())]
        return Shard(doc_ids, sizes.astype(np.int64), WaveletMatrix(length, planes))


def write_shards(
    docs: DataFrame, tokenizer: str, end_id: int = 2, shard_ids: int = SHARD_IDS, partitions: int | None = None
) -> DataFrame:
    """Shards of all documents in ascending order of integer ``doc_id``, stored in the shared folder.

    Rows: ``task, shard, start_in_task, n_ids, data``. A shard ends with the slice of documents, of
    at most as many bytes, that brings it to ``shard_ids`` ids.
    """
    spark = docs.sparkSession
    ship(spark)
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = "task int, shard int, start_in_task bigint, n_ids bigint, data binary"

    def shards(batches):
        known, task, number, start = encoder(tokenizer), TaskContext.get().partitionId(), 0, 0
        keys, sizes, parts, held = [], [], [], 0

        def close():
            nonlocal number, start, keys, sizes, parts, held
            shard = Shard(keys, np.concatenate(sizes), WaveletMatrix.of(np.concatenate(parts)))
            row = [[task], [number], [start], [held], [shard.to_bytes()]]
            number, start = number + 1, start + held
            keys, sizes, parts, held = [], [], [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()])],
                ["task", "shard", "start_in_task", "n_ids", "data"],
            )

        for batch in batches:
            for begin, end in slices(batch.column(1), ENCODED_BYTES):
                own, texts = batch.column(0).slice(begin, end - begin).to_pylist(), batch.column(1).slice(begin, end - begin)
                ids, counts = known.encode(texts)
                ids, counts = np.insert(ids, np.cumsum(counts), end_id), counts + 1
                ends = np.r_[0, np.cumsum(counts)]
                for first, last in slices(texts, min(2 << 20, shard_ids)):
                    keys += own[first:last]
                    sizes.append(counts[first:last])
                    parts.append(ids[ends[first]:ends[last]])
                    held += len(parts[-1])
                    if held >= shard_ids:
                        yield close()
        if keys:
            yield close()

    path = new_shared_path(spark, "wavelet-shards")
    (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(partitions, "doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(shards, schema)
        .write.option("compression", "zstd").parquet(path)
    )
    return spark.read.schema(schema).parquet(path)


def read_shards(shards: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document, from the shard files alone.

    The only thing broadcast is one row per task that wrote shards.
    """
    ship(shards.sparkSession)
    totals = shards.groupBy("task").agg(F.sum("n_ids").alias("ids"))
    earlier = W.orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    bases = totals.select("task", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("base"))
    placed = shards.join(F.broadcast(bases), "task").select((F.col("base") + F.col("start_in_task")).alias("start"), "data")
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids binary"

    def documents(batches):
        for batch in batches:
            for start, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                shard = Shard.from_bytes(data.as_py())
                ids, ends = shard.matrix.ids(), np.cumsum(shard.sizes)
                offsets = np.r_[0, ends * 4].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard.doc_ids, pa.int64()), pa.array(start + ends - shard.sizes), pa.array(shard.sizes),
                        pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(ids)]),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return placed.mapInArrow(documents, schema)
