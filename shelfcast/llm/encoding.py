"""Byte-level BPE ids by the tokenizers library, for whole batches of texts.

Natural text repeats its words, so each worker encodes a chunk (a space and what follows up to the
next space) once and remembers its ids within fixed bounds. No match of the pre-tokenizer's pattern
reaches from a non-space into white space, and its only lookahead stays within white space, so
cutting before a space that follows a non-space changes no ids. For the same reason the library
encodes many new chunks as one text; every chunk begins with its only space, so its first token tells
where it begins. Other chunks are cut into the pattern's matches, which the library's model encodes.
"""

from __future__ import annotations

import os
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

# Bounds of a worker's memory. Beyond the first, only the earliest chunks are kept.
MEMO_CHUNKS = 1_000_000
MEMO_KEPT = 700_000
LONGEST_MEMO = 64  # characters of a chunk that is remembered beyond its batch
JOINED = 50  # new chunks that are encoded as one text

# Fixed value: the pattern of a byte-level pre-tokenizer without settings of its own.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_encoders: dict[str, "ChunkEncoder"] = {}


def encoder(path: str) -> "ChunkEncoder":
    """The worker's encoder for a tokenizer file; loaded once per worker."""
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


def chunks_of(text: str) -> list[str]:
    """Cuts before every space that follows a non-space; joined they are ``text``."""
    parts = text.split(" ")
    chunks = [parts[0]]
    for part in parts[1:]:
        if chunks[-1] and not chunks[-1][-1].isspace():
            chunks.append(" " + part)
        else:
            chunks[-1] += " " + part
    return chunks


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return {byte: chr(byte if byte in printable else next(others)) for byte in range(256)}


class _Memo(dict):
    """Chunk numbers by key. A key is what follows the space, or a 1-tuple of a chunk without one."""

    def __missing__(self, key) -> int:
        self[key] = number = len(self)
        return number


class ChunkEncoder:
    """Encodes texts to ids, remembering the ids of chunks within ``share`` of the memory bounds."""

    def __init__(self, path: str, share: float = 1.0):
        self.share = share
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self._check_kind()
        self.matches = regex.compile(PATTERN).findall
        self.letters = _byte_letters()
        vocabulary = self.tokenizer.get_vocab()
        self.begins = np.zeros(max(vocabulary.values(), default=0) + 1, bool)  # tokens that begin with a space
        self.begins[[number for token, number in vocabulary.items() if token[:1] == self.letters[0x20]]] = True
        self._empty_memo()

    def _empty_memo(self) -> None:
        self.memo = _Memo()
        self.known = 0  # chunks whose ids are stored
        self.ids = np.empty(1 << 18, np.uint32)
        self.starts = np.zeros(1 << 16, np.int64)
        self.sizes = np.zeros(1 << 16, np.int64)
        self.open = np.zeros(1 << 16, bool)  # what follows may not be cut off here

    def _check_kind(self) -> None:
        """Refuses tokenizer files whose parts are not the ones this class relies on."""
        import json

        whole = json.loads(self.tokenizer.to_str())
        before = whole["pre_tokenizer"] or {}
        plain = whole["normalizer"] is None and whole["model"]["type"] == "BPE"
        if not plain or before.get("type") != "ByteLevel" or not before.get("use_regex") or before.get("add_prefix_space"):
            raise ValueError("only byte-level BPE files without a normalizer and prefix space are supported")

    def _ids_of(self, keys: list) -> tuple[np.ndarray, np.ndarray]:
        """All ids of chunks one after another, and each chunk's count of ids."""
        # What ends in white space may not be cut off behind; long chunks would make long texts.
        plain = [key.__class__ is str and 0 < len(key) <= LONGEST_MEMO and key[-1].isprintable() for key in keys]
        joined = [key for key, own in zip(keys, plain) if own]
        texts = [" " + " ".join(joined[at:at + JOINED]) for at in range(0, len(joined), JOINED)]
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(one.ids for one in encoded), np.uint32)
        firsts = np.flatnonzero(self.begins[ids])
        if len(firsts) != len(joined):  # a vocabulary without a letter for the space
            return self._flat(self._ids_of_matches(keys))
        others = self._ids_of_matches([key for key, own in zip(keys, plain) if not own])
        sizes = np.zeros(len(keys), np.int64)
        sizes[np.flatnonzero(plain)] = np.diff(np.r_[firsts, len(ids)])
        if others:
            sizes[np.flatnonzero(~np.array(plain))] = [len(own) for own in others]
            whole = np.empty(int(sizes.sum()), np.uint32)
            from_joined = np.repeat(plain, sizes)
            whole[from_joined], whole[~from_joined] = ids, self._flat(others)[0]
            ids = whole
        return ids, sizes

    @staticmethod
    def _flat(found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def _ids_of_matches(self, keys: list) -> list[list[int]]:
        """Ids of chunks: of every match of the pre-tokenizer's pattern, one after another."""
        tokenize, letters, matches, pieces = self.tokenizer.model.tokenize, self.letters, self.matches, {}
        remembered, known, space = self.memo.get, self.known, self.letters[0x20]
        found = []
        for key in keys:
            if key.__class__ is str and key.isalpha():
                parts = (" " + key,)
            else:
                parts = matches(" " + key if key.__class__ is str else key[0])
            ids = []
            for part in parts:
                own = pieces.get(part)
                if own is None:
                    spaced = part[0] == " "
                    number = remembered(part[1:], known) if spaced else known
                    if number < known:  # the match is a chunk that was seen before
                        start = self.starts[number]
                        own = self.ids[start:start + self.sizes[number]].tolist()
                    else:
                        if spaced and part[1:].isalnum() and part.isascii():  # bytes that stand for themselves
                            word = space + part[1:]
                        else:
                            word = part.encode().decode("latin-1").translate(letters)
                        own = [token.id for token in tokenize(word)]
                    pieces[part] = own
                ids += own
            found.append(ids)
        return found

    def _learn(self) -> None:
        """Stores the ids of the chunks numbered since the last call."""
        new = list(islice(self.memo, self.known, None))
        if not new:
            return
        found, sizes = self._ids_of(new)
        begin = int(self.starts[self.known - 1] + self.sizes[self.known - 1]) if self.known else 0
        total, end = len(self.memo), begin + int(sizes.sum())
        for name in ("starts", "sizes", "open"):
            if total > len(getattr(self, name)):
                setattr(self, name, np.resize(getattr(self, name), 2 * total))
        if end > len(self.ids):
            self.ids = np.resize(self.ids, 2 * end)
        self.ids[begin:end] = found
        self.sizes[self.known:total] = sizes
        self.starts[self.known:total] = begin + np.cumsum(sizes) - sizes
        self.open[self.known:total] = [key.__class__ is str and (not key or key[-1].isspace()) for key in new]
        self.known = total

    def _bound(self) -> None:
        """Forgets the latest chunks when there are too many."""
        if len(self.memo) <= self.share * MEMO_CHUNKS:
            return
        kept = [key for key in islice(self.memo, int(self.share * MEMO_KEPT)) if len(key) <= LONGEST_MEMO]
        numbers = np.fromiter((self.memo[key] for key in kept), np.int64, len(kept))
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        ids = self.ids[np.repeat(self.starts[numbers] - (ends - sizes), sizes) + np.arange(int(ends[-1]))]
        self.memo = _Memo(zip(kept, range(len(kept))))
        self.known = len(kept)
        self.ids, self.sizes, self.starts, self.open = ids, sizes, ends - sizes, self.open[numbers]

    def _number(self, chunks: list[str]) -> list[int]:
        number = self.memo.__getitem__
        return [number(chunk[1:] if chunk[:1] == " " and chunk[1:2].strip() else (chunk,)) for chunk in chunks]

    def _numbers(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all texts' chunks, cut at every space, and each text's count of them.

        Arrow cuts the texts and finds the different chunks, so that each is looked up once.
        """
        number = self.memo.__getitem__
        parts = pc.split_pattern(texts, " ")
        counts = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        chunks = parts.flatten()
        begins = np.cumsum(counts) - counts
        firsts = chunks.take(pa.array(begins)).to_pylist()
        chunks = chunks.dictionary_encode()
        different = chunks.dictionary.to_numpy(zero_copy_only=False).tolist()
        flat = np.fromiter(map(number, different), np.int64, len(different))[chunks.indices.to_numpy()]
        flat[begins] = [number((first,)) for first in firsts]
        return flat, counts

    def _whole(self, flat: np.ndarray, counts: np.ndarray, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same with the texts cut anew that have a chunk that may not be cut off."""
        loose = np.unique(np.searchsorted(np.cumsum(counts), np.flatnonzero(self.open[flat]), side="right"))
        if not len(loose):
            return flat, counts
        ends = np.cumsum(counts)
        cut = [self._number(chunks_of(text)) for text in texts.take(pa.array(loose)).to_pylist()]
        self._learn()
        parts, done, counts = [], 0, counts.copy()
        for row, own in zip(loose.tolist(), cut):
            parts += [flat[done:ends[row] - counts[row]], np.array(own, np.int64)]
            done, counts[row] = int(ends[row]), len(own)
        return np.concatenate([*parts, flat[done:]]), counts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` one after another, and each text's count of ids. Null: none."""
        self._bound()
        texts = pc.fill_null(texts, "")
        if not len(texts):
            return np.empty(0, np.uint32), np.zeros(0, np.int64)
        flat, counts = self._numbers(texts)
        self._learn()
        flat, counts = self._whole(flat, counts, texts)
        # As rows of bytes, the chunks' ids are copied by Arrow, one after another.
        offsets = 4 * np.r_[self.starts[:self.known], self.starts[self.known - 1] + self.sizes[self.known - 1]]
        chunks = pa.Array.from_buffers(pa.large_binary(), self.known, [None, pa.py_buffer(offsets), pa.py_buffer(self.ids)])
        taken = chunks.take(pa.array(flat))
        ends = np.frombuffer(taken.buffers()[1], np.int64, len(flat) + 1, 8 * taken.offset) // 4
        ids = np.frombuffer(taken.buffers()[2], np.uint32, int(ends[-1])) if ends[-1] else np.empty(0, np.uint32)
        return ids, np.diff(ends[np.r_[0, np.cumsum(counts)]])


def slices(column: pa.Array, max_bytes: int = 4 << 20):
    """Row ranges of a text column of about ``max_bytes`` each, at least one row."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), np.int64)
    begin, total = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if row > begin and total + size > max_bytes:
            yield begin, row
            begin, total = row, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)
