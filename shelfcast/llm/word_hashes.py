"""Hashes of words and of runs of words, for whole batches of texts."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_random = np.random.default_rng(20240501)
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[np.frombuffer(b" \t\n\v\f\r", np.uint8)] = 0
_IS_SPACE = _BYTE == 0
_BASE = np.uint64(0xD1342543DE82EF95)


@dataclass(frozen=True)
class Words:
    """Words of several texts, one after another."""

    hashes: np.ndarray  # 64 bits per word
    counts: np.ndarray  # words per text
    begins: np.ndarray  # first byte of each word in ``data``
    ends: np.ndarray  # byte after each word
    data: bytes  # the texts, each followed by a space

    @property
    def firsts(self) -> np.ndarray:
        """Number of the first word of each text."""
        return np.cumsum(self.counts) - self.counts


def mixed(words: np.ndarray) -> np.ndarray:
    words = words * np.uint64(0x9E3779B97F4A7C15)
    words ^= words >> np.uint64(32)
    words *= np.uint64(0xD6E8FEB86659FD93)
    words ^= words >> np.uint64(32)
    return words


def _powers(count: int) -> np.ndarray:
    return np.multiply.accumulate(np.full(max(count, 1), _BASE))


def words_of(texts: list[bytes]) -> Words:
    """Words are runs of bytes other than space, tab and line breaks."""
    data = b" ".join([*texts, b""])
    raw = np.frombuffer(data, np.uint8)
    space = _IS_SPACE[raw]
    edges = np.flatnonzero(np.diff(np.r_[True, space].astype(np.int8)))  # alternately begin and end
    begins, ends = edges[0::2], edges[1::2]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    counts = np.diff(np.searchsorted(begins, np.r_[0, np.cumsum(sizes)]))
    if not len(begins):
        return Words(np.zeros(0, np.uint64), counts, begins, ends, data)
    lengths = ends - begins
    place = np.arange(len(raw))
    place -= np.repeat(begins, np.diff(np.r_[begins, len(raw)])) if begins[0] == 0 else np.r_[
        np.zeros(begins[0], np.int64), np.repeat(begins, np.diff(np.r_[begins, len(raw)]))
    ]
    np.minimum(place, lengths.max(), out=place)
    hashes = np.add.reduceat(_BYTE[raw] * _powers(int(lengths.max()) + 1)[place], begins)
    return Words(mixed(hashes + lengths.astype(np.uint64)), counts, begins, ends, data)


def runs(hashes: np.ndarray, length: int, salt: int = 0) -> np.ndarray:
    """Hash of the ``length`` words from each word on; fewer by ``length - 1``, empty if too short."""
    if len(hashes) < length:
        return np.zeros(0, np.uint64)
    result, done, power, width = None, 0, mixed(hashes + np.uint64(salt)), 1
    rest = length
    while True:
        if rest & 1:
            if result is None:
                result, done = power, width
            else:
                count = min(len(result), len(power) - done)
                result, done = mixed(result[:count] * np.uint64(3) ^ power[done:done + count]), done + width
        rest >>= 1
        if not rest:
            return result[:len(hashes) - length + 1]
        power, width = mixed(power[:-width] * np.uint64(5) ^ power[width:]), 2 * width


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of each ``width`` values in a row."""
    power, span = values, 1
    while 2 * span <= width:
        power = pick(power[:-span], power[span:])
        span *= 2
    return power if span == width else pick(power[:len(values) - width + 1], power[width - span:])
