"""Language identification by a byte convolutional network.

The network reads fixed windows of bytes: filters of several widths, each a table of weights per byte
and place, then the maximum over the window and a softmax over the languages. It is trained in numpy
on windows of a bounded sample of labelled documents and applied to every window of every text, so
whole texts count. A text's probabilities are the mean of its windows', weighted by their bytes.

The sample bounds: about ``per_language`` documents of each language, picked by a hash of their id,
with ``windows_each`` windows per document; only those windows reach the driver.

Defined results: a null text, or one without a letter, is ``und`` with score 0; without any labelled
document every text is; equal texts get equal predictions; rows repeat as given.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.llm.columns import fresh, ship
from shelfcast.llm.encoding import slices

UNKNOWN = "und"
WINDOW = 128  # bytes
WIDTHS = (2, 3, 4)
FILTERS = 8  # per width
MOST_LANGUAGES = 1000


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    filters: list[np.ndarray]  # per width: place in the filter, byte, filter
    bias: np.ndarray
    weights: np.ndarray  # pooled filters by languages
    offset: np.ndarray


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept out of training: crc32 of its id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def windows(data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte windows of texts laid end to end, the row of each and its count of bytes.

    A text's last window is filled with zero bytes; an empty text has none.
    """
    per_row = -(-sizes // WINDOW)
    row = np.repeat(np.arange(len(sizes)), per_row)
    number = np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    begin = (np.cumsum(sizes) - sizes)[row] + number * WINDOW
    length = np.minimum(sizes[row] - number * WINDOW, WINDOW)
    places = begin[:, None] + np.arange(WINDOW)
    block = data[np.minimum(places, max(len(data) - 1, 0))] if len(row) else np.zeros((0, WINDOW), np.uint8)
    block[np.arange(WINDOW) >= length[:, None]] = 0
    return block, row, length


def _responses(model_filters: list[np.ndarray], block: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per width: the largest response of each filter in each window, and its place."""
    tops, places = [], []
    for table in model_filters:
        width, count = len(table), block.shape[1] - len(table) + 1
        response = table[0][block[:, :count]]
        for place in range(1, width):
            response += table[place][block[:, place:place + count]]
        best = response.argmax(axis=1)
        places.append(best)
        tops.append(np.take_along_axis(response, best[:, None, :], axis=1)[:, 0])
    return tops, places


def _softmax(scores: np.ndarray) -> np.ndarray:
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    return scores / scores.sum(axis=1, keepdims=True)


def train(blocks: np.ndarray, labels: Sequence[str], epochs: int = 6, rate: float = 0.01, seed: int = 7) -> LanguageModel:
    """Fits the network on byte windows with Adam; the gradient of a maximum goes to its place only."""
    languages = sorted(set(labels))
    target = np.array([languages.index(label) for label in labels])
    random = np.random.default_rng(seed)
    filters = [random.normal(0, 0.3, (width, 256, FILTERS)).astype(np.float32) for width in WIDTHS]
    pooled = FILTERS * len(WIDTHS)
    bias = np.zeros(pooled, np.float32)
    weights = random.normal(0, 0.1, (pooled, len(languages))).astype(np.float32)
    offset = np.zeros(len(languages), np.float32)
    values = [*filters, bias, weights, offset]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    share = np.bincount(target, minlength=len(languages)) / max(len(target), 1)
    importance = (1 / np.maximum(share, 1e-9) / len(languages)).astype(np.float32)  # languages count alike
    step = 0
    for _ in range(epochs):
        order = random.permutation(len(blocks))
        for begin in range(0, len(order), 128):
            picked = order[begin:begin + 128]
            block, goal = blocks[picked], target[picked]
            tops, places = _responses(filters, block)
            raw = np.concatenate(tops, axis=1) + bias
            active = np.maximum(raw, 0)
            chance = _softmax(active @ weights + offset)
            chance[np.arange(len(goal)), goal] -= 1
            chance *= (importance[goal] / len(goal))[:, None]
            back = (chance @ weights.T) * (raw > 0)
            gradients = []
            for number, (table, place) in enumerate(zip(filters, places)):
                gradient = np.zeros_like(table)
                part = back[:, number * FILTERS:(number + 1) * FILTERS]
                for shift in range(len(table)):
                    byte = np.take_along_axis(block, place + shift, axis=1)
                    np.add.at(gradient[shift], (byte, np.arange(FILTERS)), part)
                gradients.append(gradient)
            gradients += [back.sum(axis=0), active.T @ chance, chance.sum(axis=0)]
            step += 1
            for value, gradient, one, two in zip(values, gradients, first, second):
                one += 0.1 * (gradient - one)
                two += 0.001 * (gradient * gradient - two)
                value -= rate * (one / (1 - 0.9**step)) / (np.sqrt(two / (1 - 0.999**step)) + 1e-8)
    return LanguageModel(languages, filters, bias, weights, offset)


def window_probabilities(model: LanguageModel, block: np.ndarray) -> np.ndarray:
    """Language probabilities of each window; pairs of places are looked up at once.

    A filter's places are added in pairs beforehand, so that a pair of bytes is one table row.
    """
    pairs = block[:, :-1].astype(np.int32) * 256 + block[:, 1:]
    tops = []
    for table, joint in zip(model.filters, _joint_tables(model)):
        width, count = len(table), block.shape[1] - len(table) + 1
        response = joint[0].take(pairs[:, :count], axis=0)
        if width == 3:
            response += table[2].take(block[:, 2:2 + count], axis=0)
        elif width == 4:
            response += joint[1].take(pairs[:, 2:2 + count], axis=0)
        tops.append(response.max(axis=1))
    raw = np.maximum(np.concatenate(tops, axis=1) + model.bias, 0)
    return _softmax(raw @ model.weights + model.offset)


_joint: dict[int, list[list[np.ndarray]]] = {}


def _joint_tables(model: LanguageModel) -> list[list[np.ndarray]]:
    key = hash(model.weights.tobytes())
    if key not in _joint:
        _joint.clear()
        _joint[key] = [
            [
                (table[place][:, None, :] + table[place + 1][None, :, :]).reshape(65536, -1)
                for place in range(0, len(table) - 1, 2)
            ]
            for table in model.filters
        ]
    return _joint[key]


def text_probabilities(model: LanguageModel, texts: pa.Array, at_once: int = 2048) -> np.ndarray:
    """Language probabilities per text; rows of empty texts are 0."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    block, row, length = windows(data, sizes)
    total = np.zeros((len(sizes), len(model.languages)))
    for begin in range(0, len(block), at_once):
        part = slice(begin, begin + at_once)
        np.add.at(total, row[part], window_probabilities(model, block[part]) * length[part, None])
    return total / np.maximum(sizes, 1)[:, None]


def training_windows(
    docs: DataFrame, per_language: int, windows_each: int
) -> tuple[np.ndarray, list[str]]:
    """Windows and languages of the sample: whole windows spread evenly over each picked text."""
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {row[0]: row[1] for row in labelled.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not counts:
        return np.zeros((0, WINDOW), np.uint8), []
    ticket = F.pmod(F.xxhash64(F.lit("language sample"), F.col("doc_id").cast("string")), F.lit(1_000_003)) / 1_000_003
    chance = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, per_language / n))])
    picked = labelled.filter(ticket < chance[F.col("lang")])
    raw = F.col("text").cast("binary")
    room = F.greatest(F.octet_length("text") - WINDOW, F.lit(0))
    starts = F.transform(
        F.sequence(F.lit(0), F.lit(windows_each - 1)),
        lambda number: F.floor(room * number / max(windows_each - 1, 1)).cast("int"),
    )
    parts = F.transform(F.array_distinct(starts), lambda start: F.substring(raw, start + 1, F.lit(WINDOW)))
    rows = picked.select("lang", F.explode(parts).alias("part"), "doc_id").orderBy("doc_id", "part").collect()
    data = np.frombuffer(b"".join(bytes(row["part"]).ljust(WINDOW, b"\0") for row in rows), np.uint8)
    return data.reshape(-1, WINDOW), [row["lang"] for row in rows]


def fit(docs: DataFrame, per_language: int = 1500, windows_each: int = 4) -> LanguageModel | None:
    """A model learned from the sample; None without labelled text."""
    blocks, labels = training_windows(docs, per_language, windows_each)
    return train(blocks, labels) if labels else None


def _predictor(model: LanguageModel):
    @F.arrow_udf("struct<lang: string, score: double>")
    def predict(texts: pa.Array) -> pa.Array:
        names, scores = [], []
        for begin, end in slices(texts):
            chances = text_probabilities(model, texts.slice(begin, end - begin))
            names += [model.languages[best] for best in chances.argmax(axis=1)]
            scores += chances.max(axis=1).clip(0, 1).tolist()
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    return predict


def predictions(docs: DataFrame, model: LanguageModel | None, name: str) -> DataFrame:
    """``docs`` with a struct column ``name`` of ``lang`` and ``score``."""
    ship(docs.sparkSession)
    nothing = F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"))
    if model is None:
        return docs.withColumn(name, nothing)
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    found = _predictor(model)(F.when(lettered, F.col("text")))
    return docs.withColumn(name, found).withColumn(name, F.when(lettered, F.col(name)).otherwise(nothing))


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` per row."""
    found = predictions(docs.select("doc_id", "text"), model, "found")
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("found.lang").alias("lang_pred"),
        F.col("found.score").alias("score"),
    )


def keep_confident(docs: DataFrame, model: LanguageModel | None, least: float = 0.5) -> DataFrame:
    """Rows of ``docs`` whose language is known with a score of at least ``least``; same columns."""
    name = fresh(docs, "language")
    kept = predictions(docs, model, name).filter((F.col(f"{name}.lang") != UNKNOWN) & (F.col(f"{name}.score") >= least))
    return kept.drop(name)
