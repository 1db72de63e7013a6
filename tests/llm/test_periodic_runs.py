"""Runs of words against their definition."""

import hashlib
import time
import zlib

from hypothesis import given, settings, strategies as st

from llm_cases import ODD
from shelfcast.llm import catalogue, periodic_runs
from shelfcast.llm.word_hashes import words_of

SF_DIR = "/root/testdata/sf0.001"


def smallest_period(words):
    """By the failure function."""
    fall = [0] * len(words)
    for at in range(1, len(words)):
        length = fall[at - 1]
        while length and words[length] != words[at]:
            length = fall[length - 1]
        fall[at] = length + (words[length] == words[at])
    return len(words) - fall[-1]


def brute_runs(words, least=6, repeats=4):
    found = []
    for period in range(1, len(words) // repeats + 1):
        at = 0
        while at + period < len(words):
            begin = at
            while at + period < len(words) and words[at] == words[at + period]:
                at += 1
            length = at - begin + period
            if length >= max(least, repeats * period) and smallest_period(words[begin:begin + length]) == period:
                found.append((begin, length, period))
            at += 1
    return sorted(found, key=lambda run: (run[0], run[2]))


def kept(words, found):
    gone = {at for start, length, period in found for at in range(start + period, start + length)}
    return [word for at, word in enumerate(words) if at not in gone]


def spoiled(words, doc_id):
    number = zlib.crc32(str(doc_id).encode())
    if number % 10 or not words:
        return words
    start = number // 10 % len(words)
    period = 1 + (len(words) - start) // (3 + number // 10 % 8)
    return [word if at < start else words[start + (at - start) % period] for at, word in enumerate(words)]


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.lists(st.tuples(st.text("ab", min_size=1, max_size=3), st.integers(1, 9)), max_size=5), min_size=1, max_size=4),
    st.sampled_from([(6, 4), (2, 2), (7, 3), (12, 5)]),
)
def test_runs_are_those_of_the_definition(texts, limits):
    texts = [[letter for part, times in parts for letter in part * times] for parts in texts]
    found = periodic_runs.runs_of(words_of([" ".join(words).encode() for words in texts]), *limits)
    for number, words in enumerate(texts):
        assert found.get(number, []) == brute_runs(words, *limits), words


def test_long_texts_take_time_in_proportion():
    texts = [
        b"a " * 200_000, b"a b c " * 60_000, b"one two three four five six x%d " * 20_000 % tuple(range(20_000)),
        b" ".join(b"w%d" % (bin(number).count("1") % 2) for number in range(60_000)),
    ]
    begin = time.time()
    found = periodic_runs.runs_of(words_of(texts))
    assert time.time() - begin < 60
    assert found == {0: [(0, 200_000, 1)], 1: [(0, 180_000, 3)]}  # the last text has no three equal parts in a row


def test_runs_of_odd_documents(make):
    rows = [(number * 7, text) for number, text in enumerate(ODD)] + [(0, "x y " * 5), (None, "z " * 9), (None, None)]
    got = periodic_runs.find_runs(make(rows, runs="1", start="2", collapsed="'c'")).collect()
    assert len(got) == len(rows)
    expected = []
    for doc_id, text in rows:
        words = (text or "").encode().split()
        found = [(0, len(words), 1)] if len(words) > 1000 else brute_runs(words)
        expected.append((str(doc_id), len(words), found, b" ".join(kept(words, found)).decode()))
    assert sorted((str(row["doc_id"]), row["n_words"], [tuple(run) for run in row["runs"]], row["collapsed"]) for row in got) == sorted(expected)


def test_an_empty_table(make):
    docs = make([(1, "a")]).limit(0)
    assert periodic_runs.digest(periodic_runs.find_runs(periodic_runs.with_repeated_tails(docs))).collect() == []


def test_query_equals_brute_force(spark):
    texts = {row["doc_id"]: row["text"] for row in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    got = {row["doc_id"]: row.asDict() for row in catalogue.QUERIES["op11_periodic_runs"](spark, SF_DIR).collect()}
    assert got.keys() == texts.keys()
    for doc_id, text in texts.items():
        words = spoiled((text or "").encode().split(), doc_id)
        found = brute_runs(words)
        best = min(found, key=lambda run: (-run[1], run[0], run[2]), default=(None, None, None))
        lines = "".join(f"{start},{length},{period}\n" for start, length, period in found)
        assert got[doc_id] == {
            "doc_id": doc_id, "n_runs": len(found), "start": best[0], "length": best[1], "period": best[2],
            "exponent_milli": 1000 * best[1] // best[2] if found else None,
            "runs_sha256": hashlib.sha256(lines.encode()).hexdigest(),
            "collapsed_sha256": hashlib.sha256(b" ".join(kept(words, found))).hexdigest(),
        }
    assert sum(row["n_runs"] > 0 for row in got.values()) > 5
