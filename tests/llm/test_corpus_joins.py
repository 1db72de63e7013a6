"""Quality rules, substring deduplication, Jaccard join and the pipeline against brute force."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import regex
from hypothesis import given, settings, strategies as st

import corpus_pipeline
from llm_cases import ODD, whole_ids
from shelfcast.llm import jaccard_join, language_id, quality_outliers, substring_dedup, toxicity, word_hashes
from shelfcast.llm.columns import documents, tokenizer_file

SF_DIR = "/root/testdata/sf0.001"


def split(text):
    return (text or "").encode().split()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab \t\n\x0b\x0cé　", max_size=30), min_size=1, max_size=5))
def test_words_are_those_of_bytes(texts):
    raw = [text.encode() for text in texts]
    words = word_hashes.words_of(raw)
    flat = [words.data[b:e] for b, e in zip(words.begins, words.ends)]
    assert flat == [word for text in raw for word in text.split()] and words.counts.tolist() == [len(text.split()) for text in raw]
    assert len(set(zip(flat, words.hashes.tolist()))) == len(set(flat)) == len(set(words.hashes.tolist()))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.integers(1, 40))
def test_runs_hash_like_tuples(values, length):
    hashes = word_hashes.runs(np.array(values, np.uint64), length)
    tuples = [tuple(values[at:at + length]) for at in range(len(values) - length + 1)]
    assert len(hashes) == len(tuples) and len(set(zip(tuples, hashes.tolist()))) == len(set(tuples)) == len(set(hashes.tolist()))


# Quality rules


def naive_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[at:at + 5]) for at in range(len(words) - 4))
    covered = {at + k for at in range(len(words) - 4) if windows[tuple(words[at:at + 5])] > 1 for k in range(5)}
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_counts_match_the_rules(make):
    texts = [*ODD, "a b c d e a b c d e", "x y z w v " * 30, "one\none\n \n\ntwo\none", "# $ | <b> 50%", "q r s t u v w q r s t u x"]
    got = {row["doc_id"]: row for row in quality_outliers.base_counts(make(list(enumerate(texts)))).collect()}
    for key, text in enumerate(texts):
        row, want = got[key], naive_counts(text)
        assert tuple(row[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want, (key, want, row)
        assert row["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])


@pytest.mark.parametrize("most_groups", [quality_outliers.MAX_GROUPS, 0])
def test_outliers_of_their_group_are_rejected(make, monkeypatch, most_groups):
    monkeypatch.setattr(quality_outliers, "MAX_GROUPS", most_groups)
    random = np.random.default_rng(2)

    def prose(letters):
        return " ".join("".join(random.choice(list("abcdefgh"), letters)) for _ in range(60))

    rows = [(n, prose(5), "aa", "s", 1) for n in range(60)] + [(100 + n, prose(12), "bb", None, 1) for n in range(60)]
    rows += [(200, prose(40), "aa", "s", 1), (201, " ".join("%$#" + w for w in prose(5).split()), "aa", "s", 1), (202, prose(12), None, None, None)]
    rows += [(300 + n, text, "aa", "s", 1) for n, text in enumerate(ODD)]
    got = {row["doc_id"]: row for row in quality_outliers.verdicts(make(rows, distance="1", kept="2")).collect()}
    assert len(got) == len(rows) and all(not got[300 + n]["kept"] or naive_counts(text)[0] >= 10 for n, text in enumerate(ODD))
    assert not got[200]["kept"] and not got[201]["kept"] and got[202]["kept"]
    assert np.mean([got[n]["kept"] for n in range(60)]) > 0.9 and np.mean([got[100 + n]["kept"] for n in range(60)]) > 0.9


def test_repeats_in_a_clean_group_are_rejected(make):
    random = np.random.default_rng(3)

    def lines(n=50):
        return [" ".join("".join(random.choice(list("abcdefgh"), random.integers(3, 8))) for _ in range(4)) for _ in range(n)]

    def doubled(n):  # 2 * n lines of 4 words, each of n there twice, but no window of 5 words
        own = lines(50 - n)
        return "\n".join([*own[:n], *own[n:], *own[:n][::-1]])

    def phrases(n):
        own = lines()
        for k in range(n):
            own[10 * k] = own[10 * k + 5] = f"say{k} it{k} once{k} more{k} now{k}"
        return "\n".join(own).replace("\n", " ")

    rows = [(n, "\n".join(lines())) for n in range(60)] + [(100, doubled(1)), (101, phrases(1))]
    rows += [(200, doubled(10)), (201, phrases(3))]
    got = {row["doc_id"]: row for row in quality_outliers.verdicts(make(rows)).collect()}
    assert got[200]["n_dup_lines"] == 10 and not got[200]["n_repeat_words"] and 30 <= got[201]["n_repeat_words"] <= 40
    assert not got[200]["base_failed"] and not got[201]["base_failed"]
    assert not got[200]["kept"] and not got[201]["kept"]
    assert got[100]["kept"] and got[101]["kept"] and np.mean([got[n]["kept"] for n in range(60)]) > 0.9


def test_quality_of_nothing_and_chi_square(make):
    assert quality_outliers.verdicts(make([])).count() == 0
    assert quality_outliers.chi_square_quantile(0.95, 4) == pytest.approx(9.4877, abs=1e-3)
    plan = quality_outliers.base_counts(make([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# Substring deduplication


def naive_removal(texts, length):
    counts = Counter()
    for _, text in texts:
        words = split(text)
        counts.update(tuple(words[at:at + length]) for at in range(len(words) - length + 1))
    result = []
    for key, text in texts:
        words = split(text)
        gone = {at + k for at in range(len(words) - length + 1) if counts[tuple(words[at:at + length])] > 1 for k in range(length)}
        result.append((key, len(words), len(gone), b" ".join(w for n, w in enumerate(words) if n not in gone).decode()))
    return result


def passages(random, n, length):
    shared = [" ".join(f"p{k}w{w}" for w in range(length + 3 * k)) for k in range(4)]
    rows = []
    for key in range(n):
        parts = [" ".join(f"d{key}x{w}" for w in range(random.integers(1, 30)))]
        for k in random.choice(5, 2):
            parts.append(shared[k] if k < 4 else "the same few words")
        rows.append((key, ("\n" if key % 2 else " ").join(parts)))
    return rows


@pytest.mark.parametrize("stream", [substring_dedup.STREAM_WORDS, 100])
def test_removal_equals_brute_force(make, monkeypatch, stream):
    monkeypatch.setattr(substring_dedup, "STREAM_WORDS", stream)
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", 50)
    rows = passages(np.random.default_rng(4), 60, 35)
    rows += [(500, rows[0][1]), (500, rows[0][1]), (501, "tail " + rows[1][1] + " tail"), (None, rows[2][1])]
    rows += [(600, " ".join(f"own{n}" for n in range(50)) + " " + " ".join(f"own{n}" for n in range(50)))]
    rows += [(1000 + n, text) for n, text in enumerate(ODD)]
    got = substring_dedup.remove_repeats(make(rows, spans="1", kept="2")).collect()
    sort = lambda row: (row[0] is None, row[0] or 0, row[1:])
    assert sorted(map(tuple, got), key=sort) == sorted(naive_removal(rows, 35), key=sort)


def test_cut_text_keeps_the_rest_as_it_is(make):
    passage = " ".join(f"w{n}" for n in range(40))
    rows = [(1, f"first\n\nline {passage}\nand\tmore"), (2, passage), (3, "left  alone\n"), (4, None)]
    docs = make(rows, base="1", text_hash="2")
    got = {row["doc_id"]: row for row in substring_dedup.cut_repeats(docs).collect()}
    assert got[1]["text"] == "first\n\nline and\tmore" and got[1]["n_chars"] == len(got[1]["text"])
    assert got[2]["text"] == "" and got[3]["text"] == "left  alone\n" and got[4]["text"] is None
    assert substring_dedup.cut_repeats(make([])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=25), max_size=5), st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=25))
def test_matching_statistics(references, words):
    automaton = substring_dedup.SuffixAutomaton()
    for reference in references:
        automaton.add(reference)
    known = {tuple(r[i:j]) for r in references for i in range(len(r)) for j in range(i + 1, len(r) + 1)}
    longest = [max([0, *(n for n in range(1, at + 2) if tuple(words[at + 1 - n:at + 1]) in known)]) for at in range(len(words))]
    assert list(automaton.matches(words)) == longest


# Jaccard join


def naive_components(texts):
    sets = []
    for _, text in texts:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[at:at + 5]) for at in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set()))
    parent = list(range(len(texts)))

    def find(at):
        while parent[at] != at:
            at = parent[at]
        return at

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for at, (key, _) in enumerate(texts):
        least[find(at)] = min(least.get(find(at), key), key)
    return sorted((key, len(sets[at]), least[find(at)]) for at, (key, _) in enumerate(texts))


def near_copies(random, groups, members):
    rows = []
    for group in range(groups):
        base = [f"g{group}w{w}" for w in range(random.integers(8, 90))]
        for member in range(members):
            words = list(base)
            for _ in range(random.integers(0, 4)):
                words[random.integers(len(words))] = f"new{random.integers(10**6)}"
            rows.append((group * 100 + member, " ".join(words).upper() if member % 3 == 0 else " ".join(words)))
    return rows


@pytest.mark.parametrize("common", [jaccard_join.COMMON_TILE, 3])
def test_components_equal_brute_force(make, monkeypatch, common):
    monkeypatch.setattr(jaccard_join, "COMMON_TILE", common)
    monkeypatch.setattr(jaccard_join, "MEMBERS", 2)
    monkeypatch.setattr(jaccard_join, "BLOCK", 3)
    rows = near_copies(np.random.default_rng(6), 12, 9)
    rows += [(5000 + n, f"the same opening line of many words here then {n} " + " ".join(f"u{n}v{k}" for k in range(20))) for n in range(30)]
    rows += [(6000, rows[0][1]), (6000, rows[0][1]), (6001, rows[0][1].lower()), (6002, "Short one"), (6003, "short ONE")]
    rows += [(7000 + n, text) for n, text in enumerate(ODD)]
    got = jaccard_join.join_components(make(rows, size="1", node="2", text_hash="3")).collect()
    assert sorted(map(tuple, got)) == naive_components(rows)


def test_large_tiles_pass_their_closest_pairs_first(make, monkeypatch):
    passed, across = [], jaccard_join._across

    def counted(*given):
        pairs = across(*given)
        passed.append(pairs.filter("a <> b").count())
        return pairs

    monkeypatch.setattr(jaccard_join, "_across", counted)
    for name, value in (("FEW", 0), ("LEADERS", 1), ("COMMON_TILE", 3), ("CLOSEST", 1), ("MORE", 4)):
        monkeypatch.setattr(jaccard_join, name, value)
    # Texts of one passage and ten words of their own: every two of them pass by signature, many do not link.
    shared, random = [f"s{n}" for n in range(60)], np.random.default_rng(3)
    rows = [(n, " ".join([*shared[:random.integers(48, 60)], *[f"o{n}x{k}" for k in range(10)]])) for n in range(40)]
    got = jaccard_join.join_components(make(rows)).collect()
    assert sorted(map(tuple, got)) == naive_components(rows)
    assert passed[0] <= 6 * len(rows)


def test_near_copies_are_emitted_in_one_tile(spark):
    # The shared shingles that come first in hash order are very common, so shingles of their own come before
    # the other shared ones.
    random, copies = np.random.default_rng(8), []
    shared = np.sort(random.integers(0, 1 << 63, 400, dtype=np.uint64))
    for _ in range(30):
        kept = random.permutation(400)[:350]
        copies.append(np.sort(np.r_[shared[kept], random.integers(0, 1 << 63, 50, dtype=np.uint64)]))
    prefixes = [jaccard_join.prefix(own, shared[:100]) for own in copies]
    tiles, emitted = {}, []
    for node, own in enumerate(prefixes):
        for shingle in own.tolist():
            tiles.setdefault(shingle, []).append(node)
    rows = [(shingle, node) for shingle, nodes in tiles.items() for node in nodes if len(nodes) > 1]
    known = jaccard_join._firsts(spark.createDataFrame(rows, "shingle bigint, node bigint")).orderBy("node").collect()
    firsts = np.array([row["firsts"] for row in known], np.uint64)
    for shingle, nodes in tiles.items():
        one, two = (np.array(nodes)[rows] for rows in np.triu_indices(len(nodes), 1))
        here = jaccard_join._meet_first(firsts, np.full(len(copies), shingle, np.uint64), one, two)
        emitted += zip(one[here].tolist(), two[here].tolist())
    pairs = {(one, two) for nodes in tiles.values() for one in nodes for two in nodes if one < two}
    assert set(emitted) == pairs and len(emitted) <= 1.1 * len(pairs)


def test_one_document_of_each_group_stays(make):
    base = " ".join(f"w{n}" for n in range(40))
    rows = [(4, base), (2, base), (9, base + " more"), (5, "something else entirely in five"), (6, None), (7, ""), (None, base)]
    docs = make(rows, text_hash="1")
    kept = jaccard_join.keep_one_each(docs)
    assert kept.columns == docs.columns
    assert sorted((row["doc_id"] is None, row["doc_id"]) for row in kept.collect()) == [
        (False, 2), (False, 5), (False, 6), (False, 7), (True, None)
    ]
    assert jaccard_join.join_components(make([])).count() == 0


def test_one_row_of_each_group_stays_whatever_its_id(spark, make):
    base, lone, null = (" ".join(f"{w}{n}" for n in range(40)) for w in ("w", "x", "y"))
    rows = [
        (2, base), (2, base), (2, base + " more"), (9, base + " most"), (None, base), (None, base),  # one group
        (2, lone), (2, lone), (None, lone + " again"),  # another one under the same ids
        (None, null), (None, null), (None, null + " more"),  # no id at all
        (5, "something else entirely in five"), (6, None), (6, None), (7, ""), (None, None),
    ]
    docs = make(rows, row_key="1")
    kept = corpus_pipeline.keep_one_of_similar(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    got = Counter((row["doc_id"], row["text"]) for row in kept.collect())
    for group in (base, lone, null):
        members = {key: count for key, count in got.items() if (key[1] or "").startswith(group)}
        assert sum(members.values()) == 1 and {key[0] for key in members} == ({None} if group == null else {2})
    assert {key: count for key, count in got.items() if not (key[1] or "").startswith((base, lone, null))} == {
        (5, rows[12][1]): 1, (6, None): 2, (7, ""): 1, (None, None): 1
    }
    assert corpus_pipeline.keep_one_of_similar(spark, make([]), SF_DIR).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.sets(st.integers(0, 400), max_size=90), st.sets(st.integers(0, 400), max_size=90))
def test_signatures_never_prune_a_link(one, two):
    arrays = [np.sort(word_hashes.mixed(np.array(sorted(own), np.uint64))) for own in (one, two)]
    bits = [np.frombuffer(jaccard_join.signature(own), np.uint64) for own in arrays]
    differing = int(jaccard_join._differing(*bits))
    assert differing <= len(one ^ two) and (len(one ^ two) - differing) % 2 == 0
    if one and two and 100 * len(one & two) >= 75 * len(one | two):
        assert jaccard_join._may_link(len(one) + len(two), differing)
        prefixes = [set(jaccard_join.prefix(own, np.zeros(0, np.uint64)).tolist()) for own in arrays]
        assert prefixes[0] & prefixes[1]


# Pipeline


def plainly_not_toxic(spark, rows, docs):
    """Words and chained logistic regressions of one text at a time."""
    model = toxicity.fit(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    kept = []
    for row in rows:
        words = set(regex.split(r"[^\p{L}\p{N}]+", (row["text"] or "").lower()))
        x = [float(word in words) for word in model.words]
        for weights in model.weights:
            x.append(1 / (1 + math.exp(-(sum(a * b for a, b in zip(x, weights)) + weights[-1]))))
        lettered = regex.search(r"[\p{L}\p{N}]", row["text"] or "")
        if not lettered or x[len(model.words)] < 0.3:
            kept.append(row)
    return kept


def plainly_known(rows, docs):
    """The network's windows of one text at a time."""
    model = language_id.fit(docs)
    chances = [language_id.text_probabilities(model, pa.array([row["text"] or ""])).max() for row in rows]
    return [row for row, chance in zip(rows, chances) if regex.search(r"\p{L}", row["text"] or "") and chance >= 0.5]


def plainly_one_each(rows):
    components = {key: component for key, _, component in naive_components([(row["doc_id"], row["text"]) for row in rows])}
    return [row for row in rows if components[row["doc_id"]] == row["doc_id"]]


def test_stages_equal_plain_versions_row_by_row(spark):
    """Each stage on its own input: kept rows, cut texts, pieces and their places."""
    docs = documents(spark, SF_DIR)
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    plain = {
        "toxicity": lambda rows, docs: plainly_not_toxic(spark, rows, docs),
        "language ID": plainly_known,
        "n-gram Jaccard join": lambda rows, docs: plainly_one_each(rows),
    }
    for name, expected in plain.items():
        rows = docs.collect()
        found = stages[name](spark, docs, SF_DIR)
        assert found.columns == columns, name
        docs = found.checkpoint()
        assert sorted(docs.collect()) == sorted(expected(rows, spark.createDataFrame(rows, docs.schema))), name
        assert 100 < docs.count() <= len(rows)
    rows = {row["doc_id"]: row for row in docs.collect()}
    cut = stages["substring dedup"](spark, docs, SF_DIR).checkpoint()
    after = {row["doc_id"]: row for row in cut.collect()}
    naive = {key: (gone, kept) for key, _, gone, kept in naive_removal([(key, row["text"]) for key, row in rows.items()], substring_dedup.LENGTH)}
    assert after.keys() == rows.keys() and any(gone for gone, _ in naive.values())
    for key, (gone, kept) in naive.items():
        if gone:
            assert b" ".join(split(after[key]["text"])).decode() == kept
            assert after[key]["n_chars"] == len(after[key]["text"])
        else:
            assert after[key] == rows[key]
    pieces = stages["best-fit packing"](spark, cut, SF_DIR).collect()
    expected, keys = [], sorted(after)
    for key, ids in zip(keys, whole_ids(tokenizer_file("byte_bpe_50k.json"), [after[key]["text"] for key in keys])):
        ids, own = [*ids, 2], sorted((row for row in pieces if row["doc_id"] == key), key=lambda row: row["piece"])
        begin = 0
        for number, row in enumerate(own):
            part = ids[begin:begin + row["length"]]
            assert (row["piece"], row["start"], row["ids_crc32"]) == (number, begin, zlib.crc32(np.array(part, "<u4").tobytes()))
            assert 0 < row["length"] <= 1024 and (number == 0 or number == len(own) - 1 or row["length"] == 1024)
            begin += row["length"]
        assert begin == len(ids) and len(own) == -(-len(ids) // 1024)
        expected += own
    assert len(expected) == len(pieces)
    places: dict[int, list] = {}
    for row in pieces:
        places.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for own in places.values():
        ends = [0, *np.cumsum([length for _, length in sorted(own)]).tolist()]
        assert [offset for offset, _ in sorted(own)] == ends[:-1] and ends[-1] <= 1024


def test_stages_of_nothing(spark):
    docs = documents(spark, SF_DIR).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, SF_DIR)
        assert found.collect() == [], name


def test_whole_pipeline_runs(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    totals = Counter()
    for row in rows:
        totals[row["sequence_id"]] += row["length"]
    assert rows and max(totals.values()) <= 1024
