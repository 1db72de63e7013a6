"""Periodic runs of words, from the maximal pairs of each text.

A run is a stretch of words with smallest period ``q`` and at least ``repeats * q`` words (and at
least ``least``) that no neighbouring word extends. Its first word and the word ``q`` later begin a
maximal pair: the words from both on agree for ``length - q`` words, differ after them, and differ
before them. The other way round, a maximal pair at distance ``q`` that agrees for ``depth`` words is
such a stretch of ``depth + q`` words whenever ``depth >= max(least - q, (repeats - 1) * q)``, so
nothing has to be extended.

1. Only words that begin ``depth`` words found again in the same text can start such a pair, with the
   smallest ``depth`` a run allows. The texts that have any are sorted by prefix doubling, many texts
   at a time; words of different texts are different symbols.
2. The tree of LCP intervals is walked from its leaves up. Each node keeps its words' places in order,
   cut into blocks of one left word. Joining two children looks at the places of the smaller one
   within the distance that the depth allows and steps over blocks with the same left word, so what
   it visits are maximal pairs. Small lists go into large ones.
3. A stretch with period ``q`` also has the periods ``2q``, ``3q``, ...; the smallest is kept.

Texts are independent rows, so nothing is shuffled, and memory follows the longest text (some 60
bytes a word and 4 more for each doubling of its longest repeated stretch).

Defined results: null, empty and wordless texts have no runs; rows repeat as given, whatever their
``doc_id``; an empty table gives an empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfcast.llm.columns import ship
from shelfcast.llm.encoding import slices
from shelfcast.llm.word_hashes import Words, mixed, runs, words_of

LEAST = 6  # words of a run
REPEATS = 4  # periods of a run

Run = tuple[int, int, int]  # start, length, period


def least_depth(least: int, repeats: int) -> int:
    """Fewest words on which the two places of a run's pair agree."""
    return min(max(least - period, (repeats - 1) * period) for period in range(1, least + 1))


def _found_again(keys: np.ndarray) -> np.ndarray:
    """Places of keys that occur more than once."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    return np.sort(order[np.r_[False, same] | np.r_[same, False]]) if len(keys) else order


def suffix_ranks(symbols: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... symbols, until no two are equal.

    Equal ones share the place of the first of them. Each turn sorts only what is still equal.
    """
    count = len(symbols)
    order = np.argsort(symbols, kind="stable")
    fresh = np.r_[True, symbols[order[1:]] != symbols[order[:-1]]]
    first = np.maximum.accumulate(np.where(fresh, np.arange(count), 0))
    rank = np.empty(count, np.int32 if count < 1 << 31 else np.int64)
    rank[order] = first
    apart = fresh & np.r_[fresh[1:], True]
    levels, open_places, step = [rank], order[~apart], 1
    while len(open_places):
        later = open_places + step
        second = np.where(later < count, rank[np.minimum(later, count - 1)], -1)
        keys = rank[open_places].astype(np.int64) * (count + 1) + second + 1
        order = np.argsort(keys, kind="stable")
        keys, places = keys[order], open_places[order]
        group, number = rank[places], np.arange(len(keys))
        new_key = np.r_[True, keys[1:] != keys[:-1]]
        new_group = np.r_[True, group[1:] != group[:-1]]
        within = np.maximum.accumulate(np.where(new_key, number, 0)) - np.maximum.accumulate(np.where(new_group, number, 0))
        rank = rank.copy()
        rank[places] = group + within
        levels.append(rank)
        open_places = places[~(new_key & np.r_[new_key[1:], True])]
        step *= 2
    return levels


def common_lengths(levels: list[np.ndarray], one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Symbols on which the suffixes at two places agree."""
    total, last = np.zeros(len(one), np.int64), len(levels[0]) - 1
    for level in range(len(levels) - 1, -1, -1):
        a, b = one + total, two + total
        inside = (a <= last) & (b <= last)
        ranks = levels[level]
        total += (inside & (ranks[np.minimum(a, last)] == ranks[np.minimum(b, last)])).astype(np.int64) << level
    return total


class PairFinder:
    """Maximal pairs of an LCP-interval tree whose distance makes them runs."""

    def __init__(self, left: list[int], least: int, repeats: int):
        self.left, self.least, self.repeats = left, least, repeats
        self.found: list[tuple[int, int, int]] = []  # place, distance, depth

    def walk(self, order: list[int], depths: list[int], shallowest: int) -> None:
        """``order`` are places in suffix order, ``depths`` what each has in common with the one before."""
        stack: list[list] = []  # open intervals from the root down: depth, places, block starts
        places, blocks = [order[0]], [order[0]]
        for number in range(1, len(order) + 1):
            depth = depths[number] if number < len(order) else 0
            while stack and stack[-1][0] > depth:
                deeper, own, own_blocks = stack.pop()
                places, blocks = self._join(own, own_blocks, places, blocks, deeper)
            if stack and stack[-1][0] == depth:
                top = stack[-1]
                top[1], top[2] = self._join(top[1], top[2], places, blocks, depth)
            elif depth >= shallowest:
                stack.append([depth, places, blocks])
            if number < len(order):
                places, blocks = [order[number]], [order[number]]

    def _join(self, places, blocks, others, other_blocks, depth: int):
        """Pairs between two children of a node, and both in one."""
        if len(places) < len(others):
            places, blocks, others, other_blocks = others, other_blocks, places, blocks
        reach, nearest = depth // (self.repeats - 1), max(1, self.least - depth)
        for place in others:
            self._pairs_of(place, places, blocks, depth, reach, nearest)
        for place in others:
            self._insert(place, places, blocks)
        return places, blocks

    def _pairs_of(self, place: int, places, blocks, depth: int, reach: int, nearest: int) -> None:
        left = self.left
        word, at = left[place], bisect_left(places, place)
        number = at - 1
        while number >= 0 and place - places[number] <= reach:
            other = places[number]
            if left[other] == word:
                number = bisect_left(places, blocks[bisect_right(blocks, other) - 1]) - 1
            else:
                if place - other >= nearest:
                    self.found.append((other, place - other, depth))
                number -= 1
        number = at
        while number < len(places) and places[number] - place <= reach:
            other = places[number]
            if left[other] == word:
                following = bisect_right(blocks, other)
                if following == len(blocks):
                    return
                number = bisect_left(places, blocks[following])
            else:
                if other - place >= nearest:
                    self.found.append((place, other - place, depth))
                number += 1

    def _insert(self, place: int, places, blocks) -> None:
        left, at = self.left, bisect_left(places, place)
        word = left[place]
        if at < len(places):
            following = places[at]
            was = not at or left[places[at - 1]] != left[following]
            if was != (word != left[following]):
                if was:
                    del blocks[bisect_left(blocks, following)]
                else:
                    insort(blocks, following)
        if not at or left[places[at - 1]] != word:
            insort(blocks, place)
        places.insert(at, place)


def runs_of(words: Words, least: int = LEAST, repeats: int = REPEATS) -> dict[int, list[Run]]:
    """Runs of each text that has any, by start and period; places count within the text."""
    if least < 2 or repeats < 2:
        raise ValueError("a run has at least 2 words and 2 periods")
    depth = least_depth(least, repeats)
    row = np.repeat(np.arange(len(words.counts)), words.counts)
    last = np.repeat(words.firsts + words.counts, words.counts)
    keys = runs(words.hashes, depth)
    whole = np.flatnonzero(np.arange(len(keys)) + depth <= last[:len(keys)])
    again = whole[_found_again(mixed(keys[whole] ^ mixed(row[whole].astype(np.uint64))))]
    if not len(again):
        return {}
    used = np.zeros(len(words.counts), bool)
    used[row[again]] = True
    taken = np.flatnonzero(used[row])  # words of the texts to sort
    symbols = mixed(words.hashes[taken] ^ mixed(row[taken].astype(np.uint64)))
    levels = suffix_ranks(symbols)
    candidates = np.searchsorted(taken, again)
    candidates = candidates[np.argsort(levels[-1][candidates])]
    depths = np.r_[0, common_lengths(levels, candidates[:-1], candidates[1:])]
    first = np.r_[True, row[taken[1:]] != row[taken[:-1]]]
    left = np.r_[-1, levels[0][:-1]]
    left[first] = -1
    finder = PairFinder(left.tolist(), least, repeats)
    finder.walk(candidates.tolist(), np.where(depths >= depth, depths, 0).tolist(), depth)
    stretches: dict[tuple[int, int], int] = {}
    for place, period, common in finder.found:
        key = place, common + period
        stretches[key] = min(period, stretches.get(key, period))
    found: dict[int, list[Run]] = {}
    for (place, length), period in stretches.items():
        text = int(row[taken[place]])
        found.setdefault(text, []).append((int(taken[place] - words.firsts[text]), length, period))
    return {text: sorted(own, key=lambda run: (run[0], run[2])) for text, own in found.items()}


def collapsed(words: list[bytes], found: list[Run]) -> bytes:
    """Words joined by one space, without those that a run contains after its first period."""
    if not found:
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        edges[start + period] += 1
        edges[start + length] -= 1
    kept = np.cumsum(edges[:-1]) == 0
    return b" ".join([word for word, keep in zip(words, kept.tolist()) if keep])


def find_runs(docs: DataFrame, least: int = LEAST, repeats: int = REPEATS) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` per row.

    ``runs`` are structs of ``start, length, period`` in words, by start and period; ``collapsed`` is
    the text's words joined by one space, with one period left of every run.
    """
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    schema = f"doc_id {kind}, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"

    def find(batches):
        for batch in batches:
            for begin, end in slices(batch.column(1), 1 << 20):
                texts = [text or b"" for text in batch.column(1).slice(begin, end - begin).cast(pa.binary()).to_pylist()]
                words = words_of(texts)
                found = runs_of(words, least, repeats)
                own = [found.get(number, []) for number in range(len(texts))]
                flat = np.array([run for part in own for run in part], np.int64).reshape(-1, 3)
                offsets = np.r_[0, np.cumsum([len(part) for part in own])].astype(np.int32)
                structs = pa.StructArray.from_arrays([pa.array(flat[:, place]) for place in range(3)], fields=list(run_type))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(begin, end - begin), pa.array(words.counts.astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(offsets), structs),
                        pa.array([collapsed(text.split(), part).decode() for text, part in zip(texts, own)], pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return docs.select("doc_id", "text").mapInArrow(find, schema)


def _repeat_tail(text: str | None, doc_id: int | None) -> str | None:
    number = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    words = (text or "").encode().split()
    if number % 10 or not words:
        return text
    lot = number // 10
    start = lot % len(words)
    period = 1 + (len(words) - start) // (3 + lot % 8)
    tail = words[start:start + period]
    copies = -(-(len(words) - start) // period)
    return b" ".join([*words[:start], *(tail * copies)[:len(words) - start]]).decode()


def with_repeated_tails(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: of the documents whose id's CRC-32 is divisible by ten the tail becomes periodic."""
    ship(docs.sparkSession)
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, F.lit(False))

    @F.arrow_udf("string")
    def repeat(texts: pa.Array, ids: pa.Array) -> pa.Array:
        return pa.array(map(_repeat_tail, texts.to_pylist(), ids.to_pylist()), pa.string())

    changed = repeat(F.when(chosen, F.col("text")), F.when(chosen, F.col("doc_id")))
    return docs.select("doc_id", F.when(chosen, changed).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """``doc_id, n_runs``, the longest run (ties: smallest start, then period) and digests of ``find_runs``."""
    # Runs come by start and period, so the first of the greatest length is the wanted one.
    greatest = F.array_max(F.transform("runs", lambda run: run["length"]))
    longest = F.get(F.filter("runs", lambda run: run["length"] == F.col("greatest")), F.lit(0))
    lines = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    return (
        found.withColumn("greatest", greatest).withColumn("longest", longest)
        .select(
            "doc_id", F.size("runs").cast("long").alias("n_runs"), "longest.start", "longest.length", "longest.period",
            F.expr("longest.length * 1000 div longest.period").alias("exponent_milli"),
            F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
        )
    )
