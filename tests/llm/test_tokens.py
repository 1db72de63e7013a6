"""Token counts, byte pairs, packing and wavelet shards against plain Python."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from llm_cases import ODD, whole_ids
from shelfcast.llm import byte_pairs, encoding, packing, token_counts, wavelet

ROWS = [(number * 3, text) for number, text in enumerate(ODD)] + [(0, None)]


def test_byte_pairs_round_trip(make, ranks_path):
    docs = make(ROWS, ids="1", n_tokens="2", decoded="3")
    known = byte_pairs.codec(ranks_path)
    got = byte_pairs.decode(byte_pairs.encode(docs, ranks_path), ranks_path).collect()
    texts = dict(ROWS)
    assert len(got) == len(ROWS)
    for row in got:
        text = texts[row["doc_id"]] or ""
        ids = np.frombuffer(row["ids"], "<u4").tolist()
        assert ids == known.encode_ordinary(text) and row["n_tokens"] == len(ids)
        assert bytes(row["decoded"]) == text.encode()


def test_histogram_answers_every_limit(make, ranks_path, monkeypatch):
    monkeypatch.setattr(token_counts, "SPAN", 7)
    lengths = np.array([len(byte_pairs.encode_text(ranks_path, text)) for _, text in ROWS])
    table = token_counts.limit_table(token_counts.length_histogram(token_counts.document_lengths(make(ROWS), ranks_path)))
    rows = table.collect()
    assert sorted(row["n_tokens"] for row in rows) == sorted(set(lengths.tolist()))
    for row in rows:
        assert row["n_docs"] == (lengths == row["n_tokens"]).sum() and row["docs_longer"] == (lengths > row["n_tokens"]).sum()
        assert row["tokens_truncated"] == np.minimum(lengths, row["n_tokens"]).sum()
        assert (row["docs_total"], row["tokens_total"]) == (len(lengths), lengths.sum())
    for limit in (0, 1, 4, 1000, 10**6):
        assert token_counts.tokens_within(table, limit) == np.minimum(lengths, limit).sum()
    ordered = np.sort(lengths)
    shares = [0.1, 0.5, 0.9, 1.0]
    assert token_counts.quantiles(table, shares) == [int(ordered[int(np.ceil(s * len(ordered))) - 1]) for s in shares]


def test_histogram_of_nothing(make, ranks_path):
    table = token_counts.limit_table(token_counts.length_histogram(token_counts.document_lengths(make([]), ranks_path)))
    assert table.count() == 0 and token_counts.tokens_within(table, 5) == 0 and token_counts.quantiles(table, [0.5]) == [None]


def check_packing(rows, texts, path, capacity):
    ids = {key: np.array([*own, 2], "<u4") for key, own in zip([k for k, _ in texts], whole_ids(path, [t for _, t in texts]))}
    by_doc, by_sequence = {}, {}
    for row in rows:
        by_doc.setdefault(row["doc_id"], []).append(row)
        by_sequence.setdefault(row["sequence_id"], []).append(row)
    assert set(by_doc) == set(ids)
    for key, pieces in by_doc.items():
        pieces.sort(key=lambda row: row["piece"])
        assert [row["piece"] for row in pieces] == list(range(len(pieces)))
        assert b"".join(bytes(row["ids"]) for row in pieces) == ids[key].tobytes()
        assert all(row["length"] == capacity or row["piece"] == 0 for row in pieces)
    for pieces in by_sequence.values():
        pieces.sort(key=lambda row: row["offset"])
        ends = np.cumsum([row["length"] for row in pieces])
        assert [row["offset"] for row in pieces] == [0, *ends[:-1]] and ends[-1] <= capacity


def test_packing_places_every_piece(make, tokenizer_path):
    texts = [row for row in ROWS[:-1]]
    packed = packing.pack(make(texts, ids="1", length="2"), tokenizer_path, capacity=64)
    rows = packed.place(["doc_id", "piece", "start", "length", "ids"]).collect()
    check_packing(rows, texts, tokenizer_path, 64)
    sequences = {row["sequence_id"]: bytes(row["ids"]) for row in packed.sequences().collect()}
    for row in rows:
        at = row["offset"] * 4
        assert sequences[row["sequence_id"]][at:at + row["length"] * 4] == bytes(row["ids"])


def test_packing_of_nothing_and_of_equal_rows(make, tokenizer_path):
    assert packing.pack(make([]), tokenizer_path).place(["doc_id"]).count() == 0
    rows = packing.pack(make([(1, "same")] * 50), tokenizer_path, capacity=10).place(["length"]).collect()
    places = {(row["sequence_id"], row["offset"]) for row in rows}
    each = 10 // rows[0]["length"]
    assert len(places) == 50 and len({sequence for sequence, _ in places}) == -(-50 // each)


def naive_best_fit(lengths, capacity):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fitting = [number for number, room in enumerate(rooms) if room >= length]
        if fitting:
            rooms[min(fitting, key=rooms.__getitem__)] -= length
        else:
            rooms.append(capacity - length)
    return len(rooms)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120))
def test_plan_places_all_and_is_no_worse_than_best_fit(lengths):
    counts = np.bincount(lengths, minlength=41) if lengths else np.zeros(41, np.int64)
    plan = packing.plan(counts, 40)
    placed = np.zeros(41, np.int64)
    for pattern, often in plan:
        assert sum(length * pieces for length, pieces in pattern) <= 40 and often > 0
        for length, pieces in pattern:
            placed[length] += often * pieces
    assert (placed == counts).all()
    bound = -(-sum(lengths) // 40)
    assert bound <= sum(often for _, often in plan) <= naive_best_fit(lengths, 40) + 1 + bound // 20


def test_plan_grows_with_lengths_only():
    counts = np.zeros(129, np.int64)
    counts[1:129] = np.arange(128, 0, -1) * 10**9
    plan = packing.plan(counts, 128)
    bound = -(-int((counts * np.arange(129)).sum()) // 128)
    assert sum(often for _, often in plan) <= bound * 1.002 and len(plan) < 20_000


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 70_000), max_size=1300))
def test_wavelet_matrix_against_lists(values):
    ids = np.array(values, np.uint32)
    shard = wavelet.Shard.from_bytes(wavelet.Shard([7], np.array([len(ids)]), wavelet.WaveletMatrix.of(ids)).to_bytes())
    matrix = shard.matrix
    assert matrix.ids().tolist() == values and shard.doc_ids == [7]
    for at in range(0, len(values), max(1, len(values) // 7)):
        assert matrix.access(at) == values[at] and matrix.rank(values[at], at) == values[:at].count(values[at])
    for token in {*values[:3], 5, 1 << 20}:
        assert matrix.count(token) == values.count(token)
        assert matrix.occurrences(token) == [at for at, value in enumerate(values) if value == token]


def test_each_chunk_is_looked_up_once_per_call(tokenizer_path, monkeypatch):
    looked_up = []

    class Counting(encoding._Memo):
        def __getitem__(self, key):
            looked_up.append(key)
            return super().__getitem__(key)

    monkeypatch.setattr(encoding, "_Memo", Counting)
    texts = ["one two, two"] + [" ".join(["two", "one", "Ünï 12.5", "two,"] * 40)] * 20
    known = encoding.ChunkEncoder(tokenizer_path)
    ids, counts = known.encode(pa.array(texts))
    assert len(looked_up) <= 2 * len(texts) + 6  # beside the first chunk of each text, the different ones
    expected = whole_ids(tokenizer_path, texts)
    assert counts.tolist() == list(map(len, expected)) and ids.tolist() == sum(expected, [])


def test_many_new_chunks_at_once(tokenizer_path):
    kinds = ["w{}", "{},", "\n{}", "{}\n", "", "é{}\u3000", "{}<|endoftext|>", "\x1f{}\x1f", "{}" + 70 * "long", "'s{}"]
    texts = [" ".join(kinds[(row + at) % len(kinds)].format(row * 50 + at) for at in range(50)) for row in range(30)]
    texts = [None, *texts, ""]
    ids, counts = encoding.ChunkEncoder(tokenizer_path).encode(pa.array(texts))
    expected = whole_ids(tokenizer_path, texts)
    assert counts.tolist() == list(map(len, expected)) and ids.tolist() == sum(expected, [])


def test_wavelet_select_beyond_the_last():
    with pytest.raises(IndexError):
        wavelet.WaveletMatrix.of(np.array([3, 3])).select(3, 2)
    with pytest.raises(ValueError):
        wavelet.Shard.from_bytes(b"x" * 100)


def test_shards_keep_document_order(make, tokenizer_path):
    texts = [(key if key else None, text) for key, text in ROWS[:-1]]
    docs = make(texts, data="1", task="2")
    shards = wavelet.write_shards(docs, tokenizer_path, shard_ids=500, partitions=3)
    assert shards.count() > 3
    got = sorted(wavelet.read_shards(shards).collect(), key=lambda row: row["start"])
    want = sorted(texts, key=lambda row: (row[0] is not None, row[0]))
    ids = [np.array([*own, 2], "<u4") for own in whole_ids(tokenizer_path, [text for _, text in want])]
    assert [row["doc_id"] for row in got] == [key for key, _ in want]
    assert [row["start"] for row in got] == np.cumsum([0, *map(len, ids)])[:-1].tolist()
    assert [zlib.crc32(row["ids"]) for row in got] == [zlib.crc32(own.tobytes()) for own in ids]
    assert wavelet.read_shards(wavelet.write_shards(make([]), tokenizer_path)).count() == 0
