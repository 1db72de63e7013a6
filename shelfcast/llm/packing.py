"""Best-fit packing of token sequences by a configuration linear program.

Documents are encoded and cut into pieces of at most ``capacity`` ids. Only the histogram of piece
lengths, at most ``capacity`` numbers, reaches the driver, so planning costs the same for any number
of documents. There a configuration (how many pieces of which lengths share a sequence) is priced by
a knapsack dynamic program, multiplicative weights favour lengths that are covered too little, and
the averaged configurations are the fractional solution. It is rounded down, with a share of every
length held back, and best fit places what rounding left. Both work on counts, not pieces.

Pieces are then numbered within their length: by a running number within the task that wrote them
and the number of such pieces in earlier tasks, so that a length shared by a third of all pieces is
never gathered. A piece's number picks its sequence and place.

Defined results: null and empty texts are a single end id; every piece is placed exactly once; rows
of an empty table give no sequences; repeated rows are packed like any others.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from shelfcast.llm.columns import settle, ship
from shelfcast.llm.encoding import encoder, slices
from shelfcast.session import new_shared_path

ROUNDS = 40  # of multiplicative weights
NEAR_BEST = 0.03  # configurations this close to the best value are taken in a round
STEP = 0.5  # of a length's weight
PRICE_STEP = 0.002 # of its price
RESERVE = 0.25 # of each length's pieces, left for the repair after rounding

Configuration = tuple[tuple[int, int], ...]  # (length, pieces), longest first


def _knapsack(
    prices: np.ndarray, lengths: np.ndarray, weights: np.ndarray, capacity: int, random: np.random.Generator
) -> tuple[np.ndarray, np.ndarray]:
    """Best value for every room up to ``capacity``, and the length taken last (0: none fits).

    Among lengths of equal value the last one is drawn in proportion to ``weights``.
    """
    best, last = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    fitting = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    draw = np.log(weights)
    chances = random.gumbel(size=2 * len(lengths))
    shifts = random.integers(len(lengths), size=capacity + 1) if len(lengths) else None
    for room in range(1, capacity + 1):
        count = fitting[room]
        if count:
            values = best[room - lengths[:count]] + prices[:count]
            best[room] = top = values.max()
            ticket = draw[:count] + chances[shifts[room]:shifts[room] + count]
            last[room] = lengths[np.where(values >= top - 1e-9, ticket, -np.inf).argmax()]
    return best, last


def _configuration(first: int, last: np.ndarray, capacity: int) -> Configuration:
    pieces: dict[int, int] = defaultdict(int)
    pieces[first] += 1
    room = capacity - first
    while room and last[room]:
        pieces[int(last[room])] += 1
        room -= int(last[room])
    return tuple(sorted(pieces.items(), reverse=True))


def fractional_solution(counts: np.ndarray, capacity: int, rounds: int = ROUNDS) -> dict[Configuration, float]:
    """Configurations and how often each is used, covering the histogram approximately."""
    lengths = np.flatnonzero(counts)
    if not len(lengths):
        return {}
    demand = counts[lengths].astype(float)
    place = {int(length): number for number, length in enumerate(lengths)}
    prices, weights, covered = lengths / capacity, demand.copy(), np.zeros(len(lengths))
    random = np.random.default_rng(1)
    used: dict[Configuration, float] = defaultdict(float)
    for turn in range(1, rounds + 1):
        best, last = _knapsack(prices, lengths, weights, capacity, random)
        values = prices + best[capacity - lengths]
        chosen = np.flatnonzero(values >= (1 - NEAR_BEST) * values.max())
        patterns = [_configuration(int(lengths[number]), last, capacity) for number in chosen]
        cover, times = np.zeros(len(lengths)), []
        for number, pattern in zip(chosen, patterns):
            times.append(weights[number] / dict(pattern)[int(lengths[number])])
            for length, pieces in pattern:
                cover[place[length]] += times[-1] * pieces
        scale = float((demand * lengths).sum() / (cover * lengths).sum())
        for pattern, often in zip(patterns, times):
            used[pattern] += often * scale / rounds
        covered += cover * scale
        lacking = np.clip(1 - covered / (turn * demand), -1, 1)
        weights = weights * np.exp(STEP * lacking)
        prices = prices * np.exp(PRICE_STEP * lacking)
    return dict(used)


def best_fit(remaining: dict[int, int], capacity: int) -> list[tuple[Configuration, int]]:
    """Longest pieces first, each into the fullest sequence with room; equal sequences move as one."""
    rooms: list[int] = []  # sorted, of open sequences
    groups: dict[int, list[tuple[dict[int, int], int]]] = defaultdict(list)

    def put(pieces: dict[int, int], often: int, room: int) -> None:
        if often:
            if not groups[room]:
                insort(rooms, room)
            groups[room].append((pieces, often))

    for length in sorted(remaining, reverse=True):
        count = remaining[length]
        while count:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = capacity // length
                put({length: each}, count // each, capacity - each * length)
                if count % each:
                    put({length: count % each}, 1, capacity - count % each * length)
                break
            room = rooms[at]
            pieces, often = groups[room].pop()
            if not groups[room]:
                rooms.pop(at)
            taken = min(often, count)
            put(pieces, often - taken, room)
            put({**pieces, length: pieces.get(length, 0) + 1}, taken, room - length)
            count -= taken
    return [(tuple(sorted(p.items(), reverse=True)), often) for group in groups.values() for p, often in group]


def plan(counts: np.ndarray, capacity: int) -> list[tuple[Configuration, int]]:
    """Configurations with whole numbers of sequences that place every piece of the histogram.

    The share held back keeps some short pieces for the gaps that the last long ones leave.
    """
    left, reserve = counts.copy(), np.ceil(RESERVE * counts).astype(np.int64)
    result: list[tuple[Configuration, int]] = []
    for pattern, often in sorted(fractional_solution(counts, capacity).items(), key=lambda item: (-item[1], item[0])):
        whole = min(int(often), *(int(left[length] - reserve[length]) // pieces for length, pieces in pattern))
        if whole > 0:
            result.append((pattern, whole))
            for length, pieces in pattern:
                left[length] -= whole * pieces
    return result + best_fit({int(length): int(left[length]) for length in np.flatnonzero(left)}, capacity)


@dataclass(frozen=True)
class Layout:
    """Where the pieces of each length go, by their number within the length."""

    keys: np.ndarray  # length and first number, sorted
    sequence: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    sequences: int

    @staticmethod
    def of(configurations: list[tuple[Configuration, int]]) -> "Layout":
        rows, numbered, sequence = [], defaultdict(int), 0
        for pattern, often in configurations:
            offset = 0
            for length, pieces in pattern:
                rows.append(((length << 44) + numbered[length], sequence, pieces, offset))
                numbered[length] += often * pieces
                offset += length * pieces
            sequence += often
        table = np.array(sorted(rows), np.int64).reshape(-1, 4)
        return Layout(table[:, 0], table[:, 1], table[:, 2], table[:, 3], sequence)

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = (length << 44) + number
        row = np.searchsorted(self.keys, key, side="right") - 1
        turn = key - self.keys[row]
        return self.sequence[row] + turn // self.each[row], self.offset[row] + turn % self.each[row] * length


def _numbers_within(length: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Running number of each piece among those of its length; ``seen`` is carried on."""
    order = np.argsort(length, kind="stable")
    ordered = length[order]
    begins = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[begins, len(ordered)])
    numbers = np.empty(len(length), np.int64)
    numbers[order] = np.arange(len(ordered)) - np.repeat(begins, sizes) + seen[ordered]
    seen[ordered[begins]] += sizes
    return numbers


def encode_pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """Pieces of all documents, written to the shared folder: ``doc_id, piece, start, length, ids``.

    ``ids`` are little-endian unsigned 32-bit integers. ``task`` and ``number`` tell pieces of equal
    length apart.
    """
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("doc_id", kind), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("task", T.IntegerType()),
        T.StructField("number", T.LongType()), T.StructField("ids", T.BinaryType()),
    ])

    def cut(batches):
        known, seen, task = encoder(tokenizer), np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()
        for batch in batches:
            for begin, end in slices(batch.column(1)):
                ids, sizes = known.encode(batch.column(1).slice(begin, end - begin))
                ids = np.insert(ids, np.cumsum(sizes), end_id).astype("<u4")
                sizes = sizes + 1
                pieces = -(-sizes // capacity)
                row = np.repeat(np.arange(len(sizes)), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                first = sizes - (pieces - 1) * capacity
                length = np.where(piece == 0, first[row], capacity)
                start = np.where(piece == 0, 0, first[row] + (piece - 1) * capacity)
                offsets = np.r_[0, np.cumsum(length) * 4].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(begin, end - begin).take(pa.array(row)),
                        pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                        pa.array(np.full(len(row), task, np.int32)), pa.array(_numbers_within(length, seen)),
                        pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(offsets), pa.py_buffer(ids)]),
                    ],
                    schema.names,
                )

    path = new_shared_path(docs.sparkSession, "pieces")
    docs.select("doc_id", "text").mapInArrow(cut, schema).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def _placer(layout: Layout):
    @F.arrow_udf("struct<sequence_id: bigint, offset: bigint>")
    def place(length: pa.Array, number: pa.Array) -> pa.Array:
        sequence, offset = layout.find(length.to_numpy(), number.to_numpy())
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], ["sequence_id", "offset"])

    return place


@dataclass(frozen=True)
class Packing:
    """Stored pieces and the layout that places them."""

    pieces: DataFrame
    earlier: DataFrame
    layout: Layout

    def place(self, columns: list[Column | str]) -> DataFrame:
        """``columns`` of the pieces with ``sequence_id`` and ``offset``."""
        place = F.col("place")
        rows = self.pieces.select("length", "task", "number", F.struct(*columns).alias("row"))
        numbered = rows.join(self.earlier, ["length", "task"])
        found = numbered.withColumn("place", _placer(self.layout)("length", F.col("number") + F.col("before")))
        return found.select("row.*", place["sequence_id"].alias("sequence_id"), place["offset"].alias("offset"))

    def sequences(self) -> DataFrame:
        """``sequence_id, ids``: the packed ids of each sequence, at most ``capacity`` of them."""
        parts = self.place(["ids"]).groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
        joined = F.aggregate("parts", F.lit(b""), lambda whole, part: F.concat(whole, part["ids"]))
        return parts.select("sequence_id", joined.alias("ids"))


def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2) -> Packing:
    pieces = encode_pieces(docs, tokenizer, capacity, end_id)
    counted = settle(pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("pieces")))
    counts = np.zeros(capacity + 1, np.int64)
    for row in counted.groupBy("length").agg(F.sum("pieces").alias("pieces")).collect():
        counts[row["length"]] = row["pieces"]
    tasks = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    earlier = counted.select("length", "task", F.coalesce(F.sum("pieces").over(tasks), F.lit(0)).alias("before"))
    return Packing(pieces, earlier, Layout.of(plan(counts, capacity)))
