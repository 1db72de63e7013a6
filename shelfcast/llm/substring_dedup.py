"""Removal of passages that occur more than once, with suffix automata of reference shards.

A window is ``length`` words in a row. Each word covered by a window whose words also start anywhere
else, in the same document or another, is removed from every place.

1. Of each window the smallest hash of ``ANCHOR`` words in a row is its anchor. Equal windows have
   equal anchors, so only windows whose anchor occurs twice can be repeated. Anchors are about a
   tenth of the words, and are counted before they are joined.
2. Candidate windows are counted by a 96-bit hash; each repeated one gets its first occurrence as
   reference. Windows in a row with references in a row become one segment.
3. Reference passages are dealt to shards, segments to the shard of their reference. Each task builds
   the suffix automata of its shards and streams the segments through them; where the matching
   statistic, the longest match that ends at a word, reaches ``length``, the window is removed. The
   automata compare the words themselves. A shard with many segments is repeated and its segments
   are spread over the copies, so a passage of a third of all documents does not meet in one task.

Automata are sent to the tasks that need them instead of to all: the repeated text grows with the
corpus, and streaming every document through every shard would grow with its square.

Defined results: null and empty texts have no words and are not changed; a row repeated whole, or
rows of equal text, repeat all their windows; texts shorter than a window are never changed; null
``doc_id`` is a document like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.llm.columns import fresh, ship
from shelfcast.llm.encoding import slices
from shelfcast.llm.tables import Put, scratch, stored
from shelfcast.llm.word_hashes import Words, runs, sliding, words_of

LENGTH = 35
ANCHOR = 16
SHARD_WORDS = 20_000  # reference words of a shard, about
STREAM_WORDS = 100_000  # segment words per copy of a shard, about
TASK_SHIFT = 44  # bits for words of one task in a global word number

_LARGEST = np.uint64(0xFFFFFFFFFFFFFFFF)


def _word_batches(column: pa.Array, at_once: int = 1 << 20):
    """Row ranges of a text column with their words."""
    for begin, end in slices(column, at_once):
        texts = column.slice(begin, end - begin).cast(pa.binary()).to_pylist()
        yield begin, end, words_of([text or b"" for text in texts])


def _windows(words: Words, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text of each word, which words begin a window, anchor hash at each word, smallest in each window."""
    row = np.repeat(np.arange(len(words.counts)), words.counts)
    last = np.repeat(words.firsts + words.counts, words.counts)
    anchors = runs(words.hashes, ANCHOR)
    smallest = sliding(anchors, length - ANCHOR + 1, np.minimum) if len(words.hashes) >= length else anchors[:0]
    whole = np.arange(len(smallest)) + length <= last[:len(smallest)]
    return row, whole, anchors, smallest


def _chosen(whole: np.ndarray, anchors: np.ndarray, smallest: np.ndarray, length: int) -> np.ndarray:
    """Words at which the anchor of some window stands."""
    width = length - ANCHOR + 1
    if not len(smallest):
        return np.zeros(0, np.int64)
    reach = np.r_[
        np.zeros(width - 1, np.uint64), np.where(whole, smallest, 0).astype(np.uint64),
        np.zeros(len(anchors) - len(smallest), np.uint64),
    ]
    return np.flatnonzero((sliding(reach, width, np.maximum) == anchors) & (anchors > 0))


def _anchors(docs: DataFrame, length: int) -> DataFrame:
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_hash bigint, anchor bigint, place int"

    def find(batches):
        for batch in batches:
            for begin, end, words in _word_batches(batch.column(1)):
                row, whole, anchors, smallest = _windows(words, length)
                place = _chosen(whole, anchors, smallest, length)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(begin, end - begin).take(pa.array(row[place])),
                        batch.column(2).slice(begin, end - begin).take(pa.array(row[place])),
                        pa.array(anchors[place].view(np.int64)),
                        pa.array((place - words.firsts[row[place]]).astype(np.int32)),
                    ],
                    ["doc_id", "text_hash", "anchor", "place"],
                )

    return docs.select("doc_id", "text", "text_hash").mapInArrow(find, schema)


def _same_document(one: DataFrame, two: DataFrame) -> Column:
    return one["doc_id"].eqNullSafe(two["doc_id"]) & (one["text_hash"] == two["text_hash"])


def _candidates(docs: DataFrame, length: int, put: Put) -> DataFrame:
    """Documents with an anchor that occurs twice: ``base, text, places`` and the document's key.

    ``base`` numbers the words of all candidates: a document's words are ``base``, ``base + 1``, ...
    """
    anchors = _anchors(docs, length)
    # Stored, so that the join reads two plain exchanges and Spark can split a very common anchor.
    repeated = put(anchors.groupBy("anchor").count().filter("count > 1").select("anchor"), "repeated-anchors")
    places = put(
        anchors.join(repeated, "anchor").groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("place")).alias("places")),
        "anchor-places",
    )
    # Rows of one key have equal texts up to a hash; each stays a row of its own.
    joined = docs.join(places, _same_document(docs, places)).select(docs["doc_id"], docs["text_hash"], "text", "places")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text_hash bigint, text string, places array<int>, base bigint"

    def number(batches):
        base = TaskContext.get().partitionId() << TASK_SHIFT
        for batch in batches:
            sizes = [len(text.encode().split()) if text else 0 for text in batch.column(2).to_pylist()]
            ends = np.cumsum(sizes, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(base + ends - np.array(sizes, np.int64))], [*batch.schema.names, "base"]
            )
            base += int(ends[-1]) if len(ends) else 0

    return put(joined.mapInArrow(number, schema), "candidate-documents")


def _window_hashes(candidates: DataFrame, length: int) -> DataFrame:
    """``one, two, base, start`` of every window whose anchor occurs twice."""

    def find(batches):
        for batch in batches:
            places = batch.column(2)
            for begin, end, words in _word_batches(batch.column(1)):
                row, whole, anchors, smallest = _windows(words, length)
                if not len(smallest):
                    continue
                part = places.slice(begin, end - begin)
                owner = np.repeat(np.arange(len(part)), np.diff(part.offsets.to_numpy()))
                known = words.firsts[owner] + part.flatten().to_numpy(zero_copy_only=False)
                twice = np.full(len(anchors), _LARGEST)
                known = known[known < len(anchors)]
                twice[known] = anchors[known]
                start = np.flatnonzero(whole & (sliding(twice, length - ANCHOR + 1, np.minimum) == smallest))
                bases = batch.column(0).slice(begin, end - begin).to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(runs(words.hashes, length)[start].view(np.int64)),
                        pa.array((runs(words.hashes, length, 1)[start] >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                        pa.array(bases[row[start]]),
                        pa.array((start - words.firsts[row[start]]).astype(np.int32)),
                    ],
                    ["one", "two", "base", "start"],
                )

    return candidates.select("base", "text", "places").mapInArrow(find, "one bigint, two int, base bigint, start int")


def _segments(windows: DataFrame, references: DataFrame) -> DataFrame:
    """Repeated windows in a row whose references are in a row: ``base, start, windows, ref_base``."""
    rows = windows.join(references, ["one", "two"]).select("base", "start", "ref_base", (F.col("ref_word") - F.col("ref_base")).cast("int").alias("ref_start"))
    schema = "base bigint, start int, windows int, ref_base bigint, ref_start int"

    def join(batches):
        tail = None
        for batch in batches:
            base, start, ref_base, ref_start = (column.to_numpy() for column in batch.columns)
            if not len(base):
                continue
            follows = (
                (base[1:] == base[:-1]) & (start[1:] == start[:-1] + 1)
                & (ref_base[1:] == ref_base[:-1]) & (ref_start[1:] == ref_start[:-1] + 1)
            )
            begins = np.flatnonzero(np.r_[True, ~follows])
            found = [base[begins], start[begins], np.diff(np.r_[begins, len(base)]), ref_base[begins], ref_start[begins]]
            if tail is not None:
                b, s, n, rb, rs = tail
                if (found[0][0], found[1][0], found[3][0], found[4][0]) == (b, s + n, rb, rs + n):
                    found[1][0], found[2][0], found[4][0] = s, n + found[2][0], rs
                else:
                    found = [np.r_[value, column] for value, column in zip(tail, found)]
            tail = tuple(int(column[-1]) for column in found)
            yield _segment_batch([column[:-1] for column in found])
        if tail is not None:
            yield _segment_batch([np.array([value]) for value in tail])

    def _segment_batch(columns):
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32()]
        return pa.RecordBatch.from_arrays(
            [pa.array(column.astype(kind.to_pandas_dtype())) for column, kind in zip(columns, kinds)],
            ["base", "start", "windows", "ref_base", "ref_start"],
        )

    ordered = rows.repartition("base").sortWithinPartitions("base", "start")
    return ordered.mapInArrow(join, schema)


def _passages(spans: DataFrame, candidates: DataFrame, length: int) -> DataFrame:
    """Adds the words of ``spans`` (``base, start, windows, ...``) joined by one space, as ``words``."""

    @F.arrow_udf("array<string>")
    def cut(texts: pa.Array, starts: pa.Array, windows: pa.Array) -> pa.Array:
        found = []
        for text, own, counts in zip(texts, starts.to_pylist(), windows.to_pylist()):
            words = text.as_py().encode().split()
            found.append([b" ".join(words[start:start + count + length - 1]).decode() for start, count in zip(own, counts)])
        return pa.array(found, pa.list_(pa.string()))

    # A text meets its spans once, however many they are.
    rest = [column for column in spans.columns if column != "base"]
    grouped = spans.groupBy("base").agg(F.collect_list(F.struct(*rest)).alias("spans"))
    joined = grouped.join(candidates.select("base", "text"), "base")
    cuts = joined.select("base", F.explode(F.arrays_zip("spans", cut("text", "spans.start", "spans.windows").alias("words"))).alias("cut"))
    return cuts.select("base", *[F.col(f"cut.spans.{column}").alias(column) for column in rest], "cut.words").select(*spans.columns, "words")


class SuffixAutomaton:
    """Suffix automaton of several word sequences."""

    def __init__(self):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, moves: dict, length: int, link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, state: int, word: bytes, target: int) -> int:
        """A copy of ``target`` for the shorter matches that reach it from ``state``."""
        copy = self._state(dict(self.next[target]), self.length[state] + 1, self.link[target])
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def add(self, words: list[bytes]) -> None:
        last = 0
        for word in words:
            target = self.next[last].get(word)
            if target is not None:
                last = target if self.length[target] == self.length[last] + 1 else self._split(last, word, target)
                continue
            new = self._state({}, self.length[last] + 1, 0)
            state = last
            while state >= 0 and word not in self.next[state]:
                self.next[state][word] = new
                state = self.link[state]
            if state >= 0:
                target = self.next[state][word]
                self.link[new] = target if self.length[target] == self.length[state] + 1 else self._split(state, word, target)
            last = new

    def matches(self, words: list[bytes]):
        """Matching statistics: the longest match that ends at each word."""
        state = longest = 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                longest = self.length[state]
            target = self.next[state].get(word)
            if target is None:
                longest = 0
            else:
                state, longest = target, longest + 1
            yield longest


def matched_spans(automaton: SuffixAutomaton, words: list[bytes], length: int) -> list[tuple[int, int]]:
    """Maximal spans of words covered by matches of at least ``length`` words."""
    spans: list[tuple[int, int]] = []
    for place, longest in enumerate(automaton.matches(words)):
        if longest >= length:
            begin = place - length + 1
            if spans and begin <= spans[-1][1]:
                spans[-1] = spans[-1][0], place + 1
            else:
                spans.append((begin, place + 1))
    return spans


def _stream(routed: DataFrame, length: int) -> DataFrame:
    """Spans of segments found in the automaton of their shard."""
    schema = "base bigint, begin int, end int"

    def run(batches):
        shard, automaton = None, SuffixAutomaton()
        for batch in batches:
            bases, begins, ends = [], [], []
            columns = [batch.column(name).to_pylist() for name in ("shard", "copy", "reference", "base", "start", "words")]
            for number, copy, reference, base, start, words in zip(*columns):
                if (number, copy) != shard:
                    shard, automaton = (number, copy), SuffixAutomaton()
                words = words.encode().split()
                if reference:
                    automaton.add(words)
                    continue
                for begin, end in matched_spans(automaton, words, length):
                    bases.append(base)
                    begins.append(start + begin)
                    ends.append(start + end)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bases, pa.int64()), pa.array(begins, pa.int32()), pa.array(ends, pa.int32())], ["base", "begin", "end"]
            )

    ordered = routed.repartition("shard", "copy").sortWithinPartitions("shard", "copy", F.desc("reference"), "base", "start")
    return ordered.select("shard", "copy", "reference", "base", "start", "words").mapInArrow(run, schema)


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, text_hash, spans``: word spans to remove, for documents that have any.

    ``docs`` has ``doc_id, text, text_hash``.
    """
    with scratch(docs.sparkSession) as put:
        return _found_spans(docs, length, put)


def _found_spans(docs: DataFrame, length: int, put: Put) -> DataFrame:
    candidates = _candidates(docs, length, put)
    windows = _window_hashes(candidates, length)
    references = put(
        windows.groupBy("one", "two")
        .agg(F.count(F.lit(1)).alias("times"), F.min("base").alias("ref_base"), F.min(F.col("base") + F.col("start")).alias("ref_word"))
        .filter("times > 1").drop("times"),
        "window-references",
    )
    segments = put(_segments(windows, references), "segments")
    own = segments.filter("base = ref_base AND start = ref_start")  # all references lie in these
    total = own.agg(F.sum(F.col("windows") + F.lit(length - 1))).first()[0] or 0
    shards = max(1, -(-int(total) // SHARD_WORDS))

    def shard(base: str) -> Column:
        return F.pmod(F.xxhash64(base), F.lit(shards)).alias("shard")

    copies = (
        segments.groupBy(shard("ref_base"))
        .agg(F.ceil(F.sum(F.col("windows") + F.lit(length - 1)) / STREAM_WORDS).cast("int").alias("copies"))
    )
    copies = put(copies, "shard-copies")
    passages = _passages(own.select("base", "start", "windows", shard("base")), candidates, length)
    parts = _passages(segments.select("base", "start", "windows", shard("ref_base")), candidates, length)
    every = F.explode(F.sequence(F.lit(0), F.col("copies") - 1))
    routed = (
        passages.join(copies, "shard").select("shard", every.alias("copy"), F.lit(True).alias("reference"), "base", "start", "words")
        .unionByName(
            parts.join(copies, "shard").select(
                "shard", F.pmod(F.xxhash64("base", "start"), F.col("copies")).cast("int").alias("copy"),
                F.lit(False).alias("reference"), "base", "start", "words",
            )
        )
    )
    found = _stream(routed, length)
    return stored(
        found.join(candidates.select("base", "doc_id", "text_hash"), "base")
        .groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set(F.struct("begin", "end"))).alias("spans")),
        "repeated-spans",
    )


def _kept_mask(count: int, spans) -> np.ndarray:
    edges = np.zeros(count + 1, np.int64)
    for span in spans or ():
        edges[min(span["begin"], count)] += 1
        edges[min(span["end"], count)] -= 1
    return np.cumsum(edges[:-1]) == 0


def kept_words(text: str | None, spans) -> tuple[int, int, str]:
    """Words, removed words, and the kept words joined by one space."""
    words = (text or "").encode().split()
    if not spans:
        return len(words), 0, b" ".join(words).decode()
    mask = _kept_mask(len(words), spans)
    kept = [word for word, keep in zip(words, mask.tolist()) if keep]
    return len(words), len(words) - len(kept), b" ".join(kept).decode()


def kept_text(text: str | None, spans) -> str | None:
    """``text`` without its removed words; white space between kept words stays as it is."""
    if not text or not spans:
        return text
    words = words_of([text.encode()])
    mask = _kept_mask(len(words.begins), spans)
    edges = np.flatnonzero(np.diff(np.r_[0, mask.astype(np.int8), 0]))
    parts = [words.data[words.begins[b]:words.ends[e - 1]] for b, e in zip(edges[0::2], edges[1::2])]
    return b" ".join(parts).decode()


def _digest(texts: pa.Array, spans: pa.Array) -> pa.Array:
    found = [kept_words(text.as_py(), own.as_py()) for text, own in zip(texts, spans)]
    columns = list(zip(*found)) or [[], [], []]
    return pa.StructArray.from_arrays(
        [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())],
        ["n_words", "n_removed", "kept"],
    )


def _rest(texts: pa.Array, spans: pa.Array) -> pa.Array:
    return pa.array([kept_text(text.as_py(), own.as_py()) for text, own in zip(texts, spans)], pa.string())


def _with_spans(docs: DataFrame, length: int) -> tuple[DataFrame, str]:
    """``docs`` with its spans to remove in a new column."""
    ship(docs.sparkSession)
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    spans = repeated_spans(docs.select("doc_id", "text", text_hash.alias("text_hash")), length)
    name, key = fresh(docs, "spans"), fresh(docs, "text_hash")
    spans = spans.select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"), F.col("spans").alias(name))
    keyed = docs.withColumn(key, text_hash)
    joined = keyed.join(spans, keyed["doc_id"].eqNullSafe(spans["__doc"]) & (keyed[key] == spans["__hash"]), "left")
    return joined.select(*[keyed[column] for column in docs.columns], name), name


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` per row; ``kept`` are the kept words joined by one space."""
    found, name = _with_spans(docs.select("doc_id", "text"), length)
    digest = F.arrow_udf(_digest, "struct<n_words: bigint, n_removed: bigint, kept: string>")
    return found.select("doc_id", digest("text", name).alias("found")).select("doc_id", "found.*")


def cut_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with repeated passages cut from ``text``, and ``n_chars`` to match; all rows stay."""
    found, name = _with_spans(docs, length)
    text = F.when(F.col(name).isNotNull(), F.arrow_udf(_rest, "string")("text", name)).otherwise(F.col("text"))
    cut = found.withColumn("text", text)
    if "n_chars" in docs.columns:
        count = F.length("text").cast(docs.schema["n_chars"].dataType)
        cut = cut.withColumn("n_chars", F.when(F.col(name).isNotNull(), count).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)
