"""Alignment of two tokenizers against their definition on whole texts."""

import hashlib
from collections import Counter
from functools import reduce

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from llm_cases import ODD, whole_ids
from shelfcast.llm import catalogue, encoding, token_alignment
from shelfcast.llm.columns import tokenizer_file

SF_DIR = "/root/testdata/sf0.001"
ROWS = [(number * 7, text) for number, text in enumerate(ODD)] + [
    (0, "x y"), (None, "x y"), (1, "▁ space sign"), (2, "<0x41> </s> <unk>"), (3, "Größe 日本語 \U0001F469‍\U0001F469 x\r\n" * 40), (4, "z" * 70 + "é"),
]


@pytest.fixture(scope="module")
def files():
    return tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def own(files):
    return token_alignment.aligner(*files)


def brute(own, files, texts):
    """Groups text, links and counts of every text, from whole texts and byte ranges."""
    ids_a = whole_ids(files[0], [" " + (text or "") for text in texts])
    ids_b = own.b.model.encode([text or "" for text in texts], num_threads=1)
    found = []
    for text, a, b in zip(texts, ids_a, ids_b):
        bytes_a = [own.a.spelling.bytes_of(np.array([number])).tobytes() for number in a]
        bytes_b = [own.b.spelling.bytes_of(np.array([number])).tobytes() for number in b]
        raw = (" " + (text or "")).encode()
        if not text or b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            found.append(("", 0, 0, 0, Counter()))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        groups, at_a, at_b, links = [], 0, 0, Counter()
        for end in sorted(set(ends_a) & set(ends_b)):
            to_a, to_b = ends_a.index(end, at_a) + 1, ends_b.index(end, at_b) + 1
            groups.append(f"{','.join(map(str, a[at_a:to_a]))}|{','.join(map(str, b[at_b:to_b]))}")
            for i in range(at_a, to_a):
                for j in range(at_b, to_b):
                    if max(ends_a[i] - len(bytes_a[i]), ends_b[j] - len(bytes_b[j])) < min(ends_a[i], ends_b[j]):
                        links[a[i], b[j]] += 1
            at_a, at_b = to_a, to_b
        found.append((";".join(groups), len(a), len(b), len(groups), links))
    return found


def expected_rows(own, files, rows):
    found = brute(own, files, [text for _, text in rows])
    counts = Counter(pair for *_, links in found for pair in links)
    highest = {}
    for (a, _), count in counts.items():
        highest[a] = max(count, highest.get(a, 0))
    return sorted(
        (
            str(doc_id), n_a, n_b, n_groups, sum(links.values()),
            sum(times for pair, times in links.items() if counts[pair] == highest[pair[0]]),
            sum(times * counts[pair] for pair, times in links.items()),
            hashlib.sha256(groups.encode()).hexdigest() if groups else "",
        )
        for (doc_id, _), (groups, n_a, n_b, n_groups, links) in zip(rows, found)
    )


def as_tuples(df):
    return sorted((str(row[0]), *row[1:]) for row in df.collect())


@settings(max_examples=200, deadline=None)
@given(st.data())
def test_fragments_compose_in_any_order(own, data):
    total = data.draw(st.integers(1, 30))
    streams = []
    for _ in range(2):
        ends = sorted({*data.draw(st.lists(st.integers(1, total), max_size=20)), total})
        streams.append(token_alignment.Stream(np.arange(10, 10 + len(ends)), np.array(ends)))
    whole = own.fragment(*streams, at_boundary=True)
    # Parts of each stream are cut where they like.
    count, parts = data.draw(st.integers(1, 6)), []
    cuts = [[0, *sorted(data.draw(st.lists(st.integers(0, total), min_size=count - 1, max_size=count - 1))), total] for _ in range(2)]
    for number in range(count):
        part = [stream.cut(cut[number], cut[number + 1]) for stream, cut in zip(streams, cuts)]
        parts.append(own.fragment(*part, at_boundary=number == 0))
    while len(parts) > 1:
        at = data.draw(st.integers(0, len(parts) - 2))
        parts[at:at + 2] = [own.compose(parts[at], parts[at + 1])]
    assert parts[0].body.text == whole.body.text and parts[0].body.links == whole.body.links
    assert parts[0].body.pairs.tolist() == whole.body.pairs.tolist() and parts[0].body.times.tolist() == whole.body.times.tolist()
    assert not any(len(stream.ids) for stream in (*parts[0].head, *parts[0].tail))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from("abthe .,1é\n日 "), max_size=80), st.integers(1, 20))
def test_parts_give_the_whole(own, files, text, size):
    parts = [
        token_alignment.part_fragment(own, number == 0, *part) for number, part in enumerate(token_alignment.parts_of(own, text, size))
    ]
    groups, n_a, n_b, n_groups, links = brute(own, files, [text])[0]
    if not all(right for right, *_ in parts):
        assert not n_a
        return
    whole = reduce(own.compose, [fragment for *_, fragment in parts])
    if text:
        assert (whole.body.text, sum(p[1] for p in parts), sum(p[2] for p in parts)) == (groups, n_a, n_b)
        assert whole.body.links == sum(links.values())


@pytest.mark.parametrize("part, most_pairs", [(token_alignment.PART, 1000), (64, 1000), (token_alignment.PART, 20), (50, 0)])
def test_rows_are_those_of_the_definition(make, own, files, part, most_pairs):
    rows = ROWS if part > 1000 else [row for row in ROWS if len(row[1] or "") < 10_000]
    docs = make(rows, row="1", pairs="2", n_a="'x'")
    got = token_alignment.alignment_counts(docs, *files, part=part, most_pairs=most_pairs)
    assert as_tuples(got) == expected_rows(own, files, rows)


def test_an_empty_table(make, files):
    assert token_alignment.alignment_counts(make([(1, "a")]).limit(0), *files).collect() == []


def test_query_equals_brute_force(spark, own, files):
    rows = [(row["doc_id"], row["text"]) for row in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert as_tuples(catalogue.QUERIES["op12_token_alignment"](spark, SF_DIR)) == expected_rows(own, files, rows)


def test_the_two_memos_of_a_worker_share_its_bound(files, monkeypatch):
    monkeypatch.setattr(encoding, "MEMO_CHUNKS", 1000)
    monkeypatch.setattr(encoding, "MEMO_KEPT", 700)
    both = token_alignment.ByteTokens(files[0]), token_alignment.PieceTokens(files[1])
    for batch in range(40):
        for side in both:
            side.encode([" ".join(f"w{batch}x{number}" for number in range(30))])
    assert sum(len(side.known.memo) for side in both) <= 500
