import hashlib

import numpy as np
from hypothesis import given, settings, strategies as st

from llm_cases import ODD
from shelfcast.llm import syncmers
from shelfcast.llm.syncmers import INNER, K, SPREAD, edited, fingerprints, likeness, to_text


def naive_places(text: bytes) -> list[int]:
    """Places whose k-mer has its smallest inner hash at an edge."""
    words = [int.from_bytes(text[at:at + INNER], "little") for at in range(len(text) - INNER + 1)]
    order = syncmers._mixed(np.array(words, np.uint64)).tolist()
    found = []
    for at in range(len(text) - K + 1):
        inner = order[at:at + SPREAD]
        if min(inner) in (inner[0], inner[-1]):
            found.append(at)
    return found


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=90), min_size=1, max_size=4))
def test_places_against_the_definition(texts):
    sizes = [len(text) for text in texts]
    data = np.frombuffer(b"".join(texts), np.uint8)
    place, _ = syncmers.syncmers(data, np.repeat(np.arange(len(texts)), sizes))
    begins = np.cumsum([0, *sizes])
    assert place.tolist() == [begin + at for text, begin in zip(texts, begins) for at in naive_places(text)]


def test_fingerprints_are_context_free():
    first, second = b"the quick brown fox jumps over the lazy dog " * 2, b"lorem ipsum dolor sit amet consectetur"
    alone, joined = fingerprints([second])[0], fingerprints([first + second])[0]
    inside = {key for key, place in alone.items()}
    kept = {key for key in inside if key in joined}
    assert len(kept) > 0.5 * len(inside) or len(joined) == syncmers.SKETCH


def test_likeness_orders_texts():
    text = " ".join(f"word{n}" for n in range(400))
    near, half, far = text.replace("word7 ", "other "), text[:len(text) // 2] + "x" * 900, " ".join(f"far{n}" for n in range(400))
    own, *others = fingerprints([t.encode() for t in (text, near, half, far)])
    near, half, far = (likeness(own, other) for other in others)
    assert likeness(own, own) == 1 and 1 > near > half > far and far < 0.05
    assert likeness(own, {}) == 0 and likeness({}, {}) == 1


def check(rows, texts):
    order = sorted(texts, key=lambda row: (row[0] is not None, row[0], row[1] is not None, row[1] or ""))
    prints = fingerprints([(text or "").encode() for _, text in order])
    want = []
    for number, (key, text) in enumerate(order):
        following = (number + 1) % len(order)
        changed = edited(text or "", order[following][1] or "")
        own = fingerprints([changed.encode()])[0]
        want.append((key, len(text or ""), hashlib.sha256(changed.encode()).hexdigest(), to_text(prints[number]), to_text(own),
                     likeness(prints[number], own), likeness(prints[number], prints[following])))
    sort = lambda row: (row[0] is not None, row[0] or 0, row[1:])
    assert sorted(map(tuple, rows), key=sort) == sorted(want, key=sort)


def test_neighbours_over_ranges(make):
    texts = [(number * 7 % 101, text) for number, text in enumerate([*ODD, *[f"text {n} " * (n % 9) for n in range(60)]])]
    for partitions in (1, 7, 200):
        check(syncmers.compare_neighbours(make(texts, range="1", extra="true"), partitions).collect(), texts)


def test_null_id_lone_document_and_nothing(make):
    check(syncmers.compare_neighbours(make([(None, "null first"), (3, "abc" * 20), (1, None)])).collect(),
          [(None, "null first"), (3, "abc" * 20), (1, None)])
    check(syncmers.compare_neighbours(make([(5, "only one document here, and no other")])).collect(), [(5, "only one document here, and no other")])
    assert syncmers.compare_neighbours(make([])).count() == 0
