import numpy as np
import pyarrow as pa
import tiktoken
from hypothesis import given, settings, strategies as st

from llm_cases import whole_ids
from shelfcast.llm import byte_pairs, encoding
from shelfcast.llm.columns import tokenizer_file
from shelfcast.llm.encoding import ChunkEncoder, chunks_of, slices

ODD = ["", " ", "  \n\t ", "a  b", " a ", "x\n\n y", "　wide  a", "<|endoftext|> a", "don't we'll", "é \x1c \x85z"]


def split(ids, sizes):
    return [part.tolist() for part in np.split(ids, np.cumsum(sizes)[:-1])]


def test_chunks_join_to_the_text():
    for text in ODD:
        assert "".join(chunks_of(text)) == text


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab'sé 1\n\t. 　\x1c"), max_size=12), min_size=1, max_size=4))
def test_ids_equal_the_librarys(texts):
    path = tokenizer_file("byte_bpe_50k.json")
    ids, sizes = encoding.encoder(path).encode(pa.array(texts, pa.string()))
    assert split(ids, sizes) == whole_ids(path, texts)


def test_memo_stays_bounded(monkeypatch, tokenizer_path):
    monkeypatch.setattr(encoding, "MEMO_CHUNKS", 50)
    monkeypatch.setattr(encoding, "MEMO_KEPT", 20)
    own = ChunkEncoder(tokenizer_path)
    texts = [" ".join(f"w{n}x{k}" for n in range(30)) for k in range(10)]
    for text in texts:
        ids, sizes = own.encode(pa.array([text, None, text]))
        assert split(ids, sizes) == whole_ids(tokenizer_path, [text, "", text])
        assert len(own.memo) <= 50 + 40


def test_slices_cover_all_rows():
    column = pa.array(["x" * 10, None, "y" * 100, "", "z"])
    assert list(slices(column, 20)) == [(0, 2), (2, 3), (3, 5)]
    assert list(slices(column.slice(0, 0), 20)) == []


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab' 1\n.　"), max_size=60))
def test_stretches_encode_like_the_whole(text):
    ranks = tokenizer_file("byte_bpe_50k.tiktoken")
    known = byte_pairs.codec(ranks)
    assert isinstance(known, tiktoken.Encoding)
    parts = [id_ for part in byte_pairs.stretches(text, 5) for id_ in known.encode_ordinary(part)]
    assert parts == known.encode_ordinary(text)
