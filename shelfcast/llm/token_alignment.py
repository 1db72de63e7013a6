"""Alignment of the tokens of two tokenizers by the bytes they spell.

Tokens of both that end at one byte close a group. A part of a document has a fragment: tokens up to
its first common end (they wait for what comes before), closed groups, and tokens after its last common
end (they wait for what follows). Fragments of neighbouring parts compose to the fragment of both, and
composition is associative, so a long document is cut into parts that different tasks encode, and
their fragments are composed in a tree. The two tokenizers are cut apart at places of their own, where
neither can have a token across: the byte-level one before a space that follows a non-space, the piece
one between characters that are neighbours in none of its pieces. A document of one part is the same
with nothing left open, and whole batches of those are aligned at once.

A link is a pair of tokens that share a byte. How many documents hold a pair of ids linked is counted
over the whole table; counts are looked up in a broadcast table of at most ``MOST_PAIRS`` pairs, the
commonest, and by a join for all others.

Defined results: null and empty texts have no tokens, nor have texts that either tokenizer does not
spell out byte by byte; special tokens' strings in a text are plain text; rows repeat as given and
each counts as a document, also under one ``doc_id`` or without one; an empty table gives an empty
result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfcast.llm.columns import ship
from shelfcast.llm.encoding import ChunkEncoder, _byte_letters, slices
from shelfcast.llm.tables import Put, scratch, stored

PART = 32_768  # characters of a part, about; bytes from which a text is cut into parts
MEMO_SHARE = 0.15  # of an encoder's memory bounds, as a worker has two of them and aligns their ids
BATCH = 1 << 18  # bytes of short texts aligned at once
FAN = 8  # fragments composed by one task at a time
MOST_PAIRS = 2_000_000  # in the broadcast table of counts: 32 MB
SPACE = "▁"  # fixed value: stands for a space in pieces
NONE = np.zeros(0, np.int64)


def _none() -> np.ndarray:
    return NONE


@dataclass(frozen=True)
class Spelling:
    """Bytes of every id, one after another."""

    data: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    @staticmethod
    def of(tokens: list[bytes]) -> "Spelling":
        sizes = np.array([len(token) for token in tokens], np.int64)
        return Spelling(np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(sizes) - sizes, sizes)

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        source = np.repeat(self.starts[ids] - (ends - sizes), sizes)
        source += np.arange(len(source))
        return self.data[source]


class ByteTokens:
    """A byte-level tokenizer file of the tokenizers library."""

    def __init__(self, path: str):
        self.known = ChunkEncoder(path, MEMO_SHARE)
        vocabulary = self.known.tokenizer.get_vocab()
        byte_of = {letter: byte for byte, letter in _byte_letters().items()}
        tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            if all(letter in byte_of for letter in token):
                tokens[number] = bytes(byte_of[letter] for letter in token)
        self.spelling = Spelling.of(tokens)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, counts = self.known.encode(pa.array(texts, pa.string()))
        return ids.astype(np.int64), counts

    def cut(self, text: str, at: int) -> int:
        """First place from ``at`` on where no token can go across."""
        while 0 < at < len(text):
            at = text.find(" ", at)
            if at < 0:
                return len(text)
            if not text[at - 1].isspace():
                return at
            at += 1
        return min(at, len(text))


class PieceEncoder(ChunkEncoder):
    """Remembers the ids of chunks like its parent, by a piece model that puts a space in front of a text.

    The chunks' cuts suit it as well where no piece has a space behind another character.
    """

    GUARD = "\n"  # in no piece, so nothing is merged with it

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.share = MEMO_SHARE
        self._empty_memo()

    def _ids_of(self, keys: list) -> tuple[np.ndarray, np.ndarray]:
        # A chunk's own space is the one the model puts in front; other chunks go behind a guard, which
        # is cut off again with its space.
        spaced = [key.__class__ is str and len(key) > 0 for key in keys]
        texts = [key if own else self.GUARD + (" " + key if key.__class__ is str else key[0]) for key, own in zip(keys, spaced)]
        found = self.model.encode(texts, num_threads=1)
        return self._flat([ids if own else ids[2:] for ids, own in zip(found, spaced)])


class PieceTokens:
    """A piece model file of the sentencepiece library."""

    def __init__(self, path: str):
        self.known = PieceEncoder(path)
        self.model = self.known.model
        tokens, self.neighbours = [], set()
        for number in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(number)
            if self.model.is_byte(number):
                tokens.append(bytes([int(piece[3:5], 16)]))
                continue
            tokens.append(piece.replace(SPACE, " ").encode())
            self.neighbours.update(zip(piece, piece[1:]))
            if PieceEncoder.GUARD in piece or SPACE in piece.lstrip(SPACE):
                raise ValueError("only piece models without line breaks and inner spaces in their pieces are supported")
        self.spelling = Spelling.of(tokens)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, counts = self.known.encode(pa.array(texts, pa.string()))
        return ids.astype(np.int64), counts

    def cut(self, text: str, at: int) -> int:
        while 0 < at < len(text) and tuple(text[at - 1:at + 1].replace(" ", SPACE)) in self.neighbours:
            at += 1
        return min(at, len(text))


@dataclass(frozen=True)
class Stream:
    """Tokens in a row and the byte at which each ends."""

    ids: np.ndarray = field(default_factory=_none)
    ends: np.ndarray = field(default_factory=_none)

    def __add__(self, other: "Stream") -> "Stream":
        return Stream(np.r_[self.ids, other.ids], np.r_[self.ends, other.ends])

    def cut(self, begin: int, end: int) -> "Stream":
        """Tokens that end after ``begin`` and up to ``end``."""
        low, high = np.searchsorted(self.ends, [begin, end], side="right")
        return Stream(self.ids[low:high], self.ends[low:high])


@dataclass(frozen=True)
class Groups:
    """Closed groups in a row: ``a1,a2|b1;a3|b2``, their links, and how often each pair is linked."""

    text: str = ""
    groups: int = 0
    links: int = 0
    pairs: np.ndarray = field(default_factory=_none)
    times: np.ndarray = field(default_factory=_none)

    def __add__(self, other: "Groups") -> "Groups":
        if not self.groups or not other.groups:
            return self if self.groups else other
        pairs, back = np.unique(np.r_[self.pairs, other.pairs], return_inverse=True)
        times = np.bincount(back, np.r_[self.times, other.times], len(pairs)).astype(np.int64)
        return Groups(f"{self.text};{other.text}", self.groups + other.groups, self.links + other.links, pairs, times)


def common_ends(a: Stream, b: Stream) -> np.ndarray:
    """Whether a token of ``a`` ends where one of ``b`` does."""
    if not len(b.ends):
        return np.zeros(len(a.ends), bool)
    at = np.minimum(np.searchsorted(b.ends, a.ends), len(b.ends) - 1)
    return b.ends[at] == a.ends


def pair_number(a, b, size_b: int):
    return a * size_b + b


@dataclass(frozen=True)
class Fragment:
    """Alignment of a part of a document.

    ``head`` are the tokens up to the first common end, or all of them if there is none (not ``cut``).
    """

    head: tuple[Stream, Stream] = (Stream(), Stream())
    cut: bool = False
    body: Groups = Groups()
    tail: tuple[Stream, Stream] = (Stream(), Stream())


class Aligner:
    """Groups and links of the tokens of two tokenizers."""

    def __init__(self, a, b):
        self.a, self.b = a, b
        self.size_b = len(b.spelling.sizes)
        self.names = [
            (np.array([f"{n}," for n in range(len(side.spelling.sizes))], object),
             np.array([f"{n}{mark}" for n in range(len(side.spelling.sizes))], object))
            for side, mark in ((a, "|"), (b, ";"))
        ]

    def groups(self, a: Stream, b: Stream, begin: int, bounds: np.ndarray) -> list[Groups]:
        """Groups between neighbouring ``bounds``, common ends all, of streams that start at ``begin``."""
        closes_a, closes_b = common_ends(a, b), common_ends(b, a)
        common = a.ends[closes_a]
        group_a, group_b = np.cumsum(closes_a) - closes_a, np.cumsum(closes_b) - closes_b
        size_a, size_b = np.bincount(group_a), np.bincount(group_b)
        words = np.empty(len(a.ids) + len(b.ids), object)
        words[np.arange(len(a.ids)) + (np.cumsum(size_b) - size_b)[group_a]] = np.where(
            closes_a, self.names[0][1][a.ids], self.names[0][0][a.ids]
        )
        words[np.arange(len(b.ids)) + np.cumsum(size_a)[group_b]] = np.where(
            closes_b, self.names[1][1][b.ids], self.names[1][0][b.ids]
        )
        starts_a, starts_b = np.r_[begin, a.ends[:-1]], np.r_[begin, b.ends[:-1]]
        first = np.searchsorted(b.ends, starts_a, side="right")
        linked = np.searchsorted(starts_b, a.ends) - first
        ends = np.cumsum(linked)
        of_a = np.repeat(np.arange(len(a.ids)), linked)
        of_b = np.arange(len(of_a)) + np.repeat(first - (ends - linked), linked)
        until_a = np.searchsorted(a.ends, bounds, side="right")
        owner = np.repeat(np.arange(len(bounds)), np.diff(until_a, prepend=0))
        space = len(self.names[0][0]) * self.size_b
        keys = owner[of_a] * space + pair_number(a.ids[of_a], b.ids[of_b], self.size_b)
        keys, times = np.unique(keys, return_counts=True)
        whose, pairs = keys // space, keys % space
        cuts = np.searchsorted(whose, np.arange(len(bounds) + 1))
        tokens = until_a + np.searchsorted(b.ends, bounds, side="right")
        groups = np.bincount(np.searchsorted(bounds, common), minlength=len(bounds))
        links = np.bincount(owner, linked, len(bounds)).astype(np.int64)
        words, found, before = words.tolist(), [], 0
        for number, after in enumerate(tokens.tolist()):
            own = slice(cuts[number], cuts[number + 1])
            text = "".join(words[before:after])[:-1]
            found.append(Groups(text, int(groups[number]), int(links[number]), pairs[own], times[own]))
            before = after
        return found

    def _closed(self, a: Stream, b: Stream, begin: int) -> Groups:
        return self.groups(a, b, begin, a.ends[-1:])[0] if len(a.ids) else Groups()

    def fragment(self, a: Stream, b: Stream, at_boundary: bool = False) -> Fragment:
        """Fragment of tokens, whose first ones start together if ``at_boundary``.

        Where that is makes no difference to groups and links, so 0 stands for it.
        """
        common = a.ends[common_ends(a, b)]
        if at_boundary:
            first, head = 0, (Stream(), Stream())
        elif len(common):
            first = int(common[0])
            head = a.cut(-1, first), b.cut(-1, first)
        else:
            return Fragment((a, b))
        last = int(common[-1]) if len(common) else first
        body = self._closed(a.cut(first, last), b.cut(first, last), first)
        most = max([last, *a.ends[-1:].tolist(), *b.ends[-1:].tolist()])
        return Fragment(head, True, body, (a.cut(last, most), b.cut(last, most)))

    def compose(self, one: Fragment, two: Fragment) -> Fragment:
        """Fragment of two neighbouring parts; associative, an empty fragment changes nothing."""
        before = one.tail if one.cut else one.head
        a, b = before[0] + two.head[0], before[1] + two.head[1]
        if one.cut:
            middle = self.fragment(a, b, at_boundary=True)
            head, body = one.head, one.body + middle.body
        else:
            middle = self.fragment(a, b)
            if not middle.cut:
                return middle
            head, body = middle.head, middle.body
        if two.cut:
            return Fragment(head, True, body + two.body, two.tail)
        return Fragment(head, True, body, middle.tail)


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(byte_file: str, piece_file: str) -> Aligner:
    """The worker's aligner for two tokenizer files; loaded once per worker."""
    key = byte_file, piece_file
    if key not in _aligners:
        _aligners[key] = Aligner(ByteTokens(byte_file), PieceTokens(piece_file))
    return _aligners[key]


def _spelled_out(tokens, ids: np.ndarray, counts: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Which texts their tokens spell byte by byte."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    spelled = np.add.reduceat(np.r_[tokens.spelling.sizes[ids], 0], np.minimum(np.cumsum(counts) - counts, len(ids)))
    right = np.where(counts > 0, spelled, 0) == sizes
    own = tokens.spelling.bytes_of(ids[np.repeat(right, counts)])
    raw = np.frombuffer(b"".join([text for text, keep in zip(texts, right.tolist()) if keep]), np.uint8)
    wrong = np.flatnonzero(own != raw)
    kept = np.flatnonzero(right)
    right[kept[np.searchsorted(np.cumsum(sizes[kept]), wrong, side="right")]] = False
    return right


def _aligned_batch(own: Aligner, texts: list[str]) -> list[tuple[int, int, Groups]]:
    """Counts of tokens, and groups, of whole texts."""
    spaced = [" " + text if text else "" for text in texts]
    raw = [text.encode() for text in spaced]
    found = [side.encode(spaced) for side in (own.a, own.b)]
    right = np.array([bool(text) for text in texts], bool)
    for side, (ids, counts) in zip((own.a, own.b), found):
        right &= _spelled_out(side, ids, counts, raw)
    streams = []
    for side, (ids, counts) in zip((own.a, own.b), found):
        ids = ids[np.repeat(right, counts)]
        streams.append(Stream(ids, np.cumsum(side.spelling.sizes[ids])))
    bounds = np.cumsum([len(text) for text, keep in zip(raw, right.tolist()) if keep], dtype=np.int64)
    groups = iter(own.groups(*streams, 0, bounds) if len(bounds) else ())
    nothing = (0, 0, Groups())
    totals = zip(right.tolist(), found[0][1].tolist(), found[1][1].tolist())
    return [(n_a, n_b, next(groups)) if keep else nothing for keep, n_a, n_b in totals]


FOUND = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, pairs array<bigint>, times array<bigint>"


def _found_arrays(found: list[tuple[int, int, Groups]]) -> list[pa.Array]:
    def lists(arrays: list[np.ndarray]) -> pa.Array:
        offsets = np.r_[0, np.cumsum([len(own) for own in arrays])].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([NONE, *arrays])))

    groups = [own for _, _, own in found]
    return [
        *[pa.array(values, pa.int64()) for values in (
            [n_a for n_a, _, _ in found], [n_b for _, n_b, _ in found],
            [own.groups for own in groups], [own.links for own in groups],
        )],
        pa.array([own.text for own in groups], pa.string()),
        lists([own.pairs for own in groups]), lists([own.times for own in groups]),
    ]


def _names(schema: str) -> list[str]:
    return [column.split()[0] for column in schema.split(", ")]


def _align_short(docs: DataFrame, files: tuple[str, str]) -> DataFrame:
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {FOUND}"

    def align(batches):
        for batch in batches:
            for begin, end in slices(batch.column(1), BATCH):
                part = batch.slice(begin, end - begin)
                found = _aligned_batch(aligner(*files), [text or "" for text in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), *_found_arrays(found)], ["doc_id", *_names(FOUND)])

    return docs.select("doc_id", "text").mapInArrow(align, schema)


def parts_of(own: Aligner, text: str, size: int) -> list[tuple[str, str, int, int]]:
    """Parts of a text with its space: those of either tokenizer, and the bytes before them."""
    spaced, found = " " + text, []
    a = b = bytes_a = bytes_b = 0
    for target in range(size, len(spaced) + size, size):
        last = target >= len(spaced)
        next_a = len(spaced) if last else max(a, own.a.cut(spaced, target))
        next_b = len(spaced) if last else max(b, own.b.cut(spaced, target))
        found.append((spaced[a:next_a], spaced[b:next_b], bytes_a, bytes_b))
        bytes_a += len(found[-1][0].encode())
        bytes_b += len(found[-1][1].encode())
        a, b = next_a, next_b
    return found


def part_fragment(own: Aligner, first: bool, text_a: str, text_b: str, bytes_a: int, bytes_b: int):
    """Whether both tokenizers spell a part out, their counts of tokens, and the fragment."""
    streams, right = [], True
    for side, text, before in ((own.a, text_a, bytes_a), (own.b, text_b, bytes_b)):
        ids, counts = side.encode([text])
        right &= bool(_spelled_out(side, ids, counts, [text.encode()])[0])
        streams.append(Stream(ids, before + np.cumsum(side.spelling.sizes[ids])))
    counts = len(streams[0].ids), len(streams[1].ids)
    return right, *counts, own.fragment(*streams, at_boundary=first) if right else Fragment()


def _align_long(docs: DataFrame, files: tuple[str, str], size: int, put: Put) -> DataFrame | None:
    """The same for texts of many parts; None if there are none."""
    keyed = put(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "long-texts")
    longest = keyed.agg(F.max(F.length("text"))).first()[0]
    if longest is None:
        return None

    def cut(batches):
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                parts = parts_of(aligner(*files), text.as_py(), size)
                columns = list(zip(*parts))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row] * len(parts), pa.int64()), pa.array(range(len(parts)), pa.int32()),
                        *[pa.array(column, kind) for column, kind in zip(columns, [pa.string()] * 2 + [pa.int64()] * 2)],
                    ],
                    ["row", "part", "text_a", "text_b", "bytes_a", "bytes_b"],
                )

    found = "right boolean, n_a bigint, n_b bigint, fragment binary"

    def encode(batches):
        for batch in batches:
            for number in range(batch.num_rows):
                row, part, *rest = (column[number].as_py() for column in batch.columns)
                right, n_a, n_b, own = part_fragment(aligner(*files), part == 0, *rest)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([value]) for value in (row, np.int32(part), right, n_a, n_b, pickle.dumps(own))],
                    ["row", "part", *_names(found)],
                )

    @F.arrow_udf("binary")
    def compose(parts: pa.Array) -> pa.Array:
        whole = [reduce(aligner(*files).compose, map(pickle.loads, own.as_py())) for own in parts]
        return pa.array([pickle.dumps(own) for own in whole], pa.binary())

    parts = keyed.select("row", "text").mapInArrow(
        cut, "row bigint, part int, text_a string, text_b string, bytes_a bigint, bytes_b bigint"
    )
    fragments = put(
        parts.repartition("row", "part").mapInArrow(encode, f"row bigint, part int, {found}"), "fragments"
    )
    count = longest // size + 2
    while count > 1:
        together = fragments.groupBy("row", F.expr(f"part div {FAN}").cast("int").alias("part")).agg(
            F.bool_and("right").alias("right"), F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"),
            F.transform(
                F.sort_array(F.collect_list(F.struct(F.col("part").alias("place"), "fragment"))), lambda own: own["fragment"]
            ).alias("fragments"),
        )
        fragments = put(together.select("row", "part", "right", "n_a", "n_b", compose("fragments").alias("fragment")), "fragments")
        count = -(-count // FAN)
    whole = fragments.join(keyed.select("row", "doc_id"), "row").select("doc_id", *_names(found))

    def finish(batches):
        for batch in batches:
            values = zip(*[batch.column(name).to_pylist() for name in _names(found)])
            done = [
                (n_a, n_b, pickle.loads(own).body) if right else (0, 0, Groups()) for right, n_a, n_b, own in values
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *_found_arrays(done)], ["doc_id", *_names(FOUND)])

    return whole.mapInArrow(finish, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {FOUND}")


def align(docs: DataFrame, byte_file: str, piece_file: str, part: int = PART, put: Put = stored) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups, pairs, times`` per row.

    ``groups`` is ``a1,a2|b1;a3|b2,b3``, ids of both tokenizers in order; ``pairs`` are the distinct
    linked pairs, ``a * (size of the second vocabulary) + b``, and ``times`` how often each is linked.
    """
    ship(docs.sparkSession)
    long = F.coalesce(F.octet_length("text") > part, F.lit(False))
    files = byte_file, piece_file
    short = _align_short(docs.select("doc_id", "text").filter(~long), files)
    rest = _align_long(docs.select("doc_id", "text").filter(long), files, part, put)
    return short if rest is None else short.unionByName(rest)


def _lookup(aligned: DataFrame, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """Adds ``n_best, count_sum`` over the pairs in ``table`` (sorted pairs, counts, whether best); keeps the others."""
    known = aligned.sparkSession.sparkContext.broadcast(table)
    plain = [name for name in aligned.columns if name not in ("pairs", "times")]
    schema = ", ".join(f"{name} {aligned.schema[name].dataType.simpleString()}" for name in plain)
    names = [*plain, "n_best", "count_sum", "pairs", "times"]

    def add(batches):
        all_pairs, counts, best = known.value
        for batch in batches:
            lists = batch.column("pairs")
            pairs, times = lists.flatten().to_numpy(), batch.column("times").flatten().to_numpy()
            sizes = np.diff(lists.offsets.to_numpy())
            owner = np.repeat(np.arange(len(sizes)), sizes)
            at = np.minimum(np.searchsorted(all_pairs, pairs), max(len(all_pairs) - 1, 0))
            there = all_pairs[at] == pairs if len(all_pairs) else np.zeros(len(pairs), bool)
            at, own, weight = at[there], owner[there], times[there]
            sums = [np.zeros(len(sizes), np.int64) for _ in range(2)]
            np.add.at(sums[0], own, weight * best[at])
            np.add.at(sums[1], own, weight * counts[at])
            offsets = pa.array(np.r_[0, np.cumsum(np.bincount(owner[~there], minlength=len(sizes)))].astype(np.int32))
            rest = [pa.ListArray.from_arrays(offsets, pa.array(values[~there])) for values in (pairs, times)]
            yield pa.RecordBatch.from_arrays([*[batch.column(name) for name in plain], *map(pa.array, sums), *rest], names)

    return aligned.mapInArrow(add, f"{schema}, n_best bigint, count_sum bigint, pairs array<bigint>, times array<bigint>")


def _scored(aligned: DataFrame, size_b: int, most: int, put: Put) -> DataFrame:
    """Adds ``n_best, count_sum`` to rows with ``row, pairs, times``."""
    counts = put(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("docs")), "pair-counts")
    ids = F.expr(f"pair div {size_b}")
    highest = put(counts.groupBy(ids.alias("a")).agg(F.max("docs").alias("highest")), "highest-counts")
    table = counts.withColumn("a", ids).join(highest, "a")
    table = put(table.select("pair", "docs", (F.col("docs") == F.col("highest")).alias("best")), "pair-table")
    distinct, least = table.count(), 0
    if distinct > most:
        least = table.agg(F.percentile_approx("docs", 1 - most / distinct, 10_000)).first()[0]
    common = table.filter(F.col("docs") > least).sort("pair").toArrow()
    found = _lookup(aligned, tuple(common.column(name).to_numpy() for name in ("pair", "docs", "best")))
    if distinct <= most:
        return found
    found = put(found, "common-pairs")
    rest = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select("row", "link.pairs", "link.times")
    rare = rest.join(table.filter(F.col("docs") <= least), F.col("pairs") == F.col("pair")).groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("docs")).alias("more_sum")
    )
    return found.join(rare, "row", "left").withColumns({
        "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)),
        "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0)),
    })


def alignment_counts(
    docs: DataFrame, byte_file: str, piece_file: str, part: int = PART, most_pairs: int = MOST_PAIRS
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` per row.

    A pair's count is the number of documents that hold it linked. ``n_best`` are the links whose count
    is the highest of their first id's, ``count_sum`` adds up the counts of all links.
    """
    spark = docs.sparkSession
    with scratch(spark) as put:
        digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise(F.lit("")).alias("groups_sha256")
        aligned = put(
            align(docs, byte_file, piece_file, part, put)
            .select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_a", "n_b", "n_groups", "n_links", digest, "pairs", "times"),
            "aligned",
        )
        size_b = len(aligner(byte_file, piece_file).b.spelling.sizes)
        scored = _scored(aligned, size_b, most_pairs, put)
        return stored(
            scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"), "alignment"
        )
