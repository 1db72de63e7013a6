"""Language identification and toxicity on small labelled tables."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from llm_cases import ODD
from shelfcast.llm import language_id, toxicity

WORDS = {"aa": ["lorem", "ipsum", "dolor", "sit"], "bb": ["żółw", "gęś", "jaźń", "łódź"], "cc": ["zug", "weg", "buch", "tisch"]}


def sentence(random, lang, n=40):
    return " ".join(random.choice(WORDS[lang], n))


@pytest.fixture(scope="module")
def spoken(make):
    random = np.random.default_rng(3)
    rows = [(n, sentence(random, lang := list(WORDS)[n % 3]), lang, "s", 1) for n in range(240)]
    rows += [(1000 + n, text, None, None, None) for n, text in enumerate(ODD)]
    return make(rows, score="1", found="2"), {row[0]: row for row in rows}


def test_held_out_rows_are_recognised(spoken):
    docs, rows = spoken
    model = language_id.fit(docs)
    found = {row["doc_id"]: row for row in language_id.identify(docs, model).collect()}
    assert set(found) == set(rows)
    hits = []
    for key, row in found.items():
        assert row["held_out"] == (zlib.crc32(str(key).encode()) % 4 == 2) and 0 <= row["score"] <= 1
        text = rows[key][1]
        if not text or not any(letter.isalpha() for letter in text):
            assert (row["lang_pred"], row["score"]) == ("und", 0)
        else:
            assert row["lang_pred"] in WORDS
        if row["held_out"] and key < 1000:
            hits.append(row["lang_pred"] == rows[key][2])
    assert np.mean(hits) > 0.95
    kept = language_id.keep_confident(docs, model)
    assert kept.columns == docs.columns
    assert {row["doc_id"] for row in kept.collect()} == {k for k, r in found.items() if r["lang_pred"] != "und" and r["score"] >= 0.5}


def test_held_out_rows_teach_nothing(make):
    rows = [(n, "lorem ipsum", "aa" if zlib.crc32(str(n).encode()) % 4 == 2 else "bb", "s", 1) for n in range(40)]
    model = language_id.fit(make(rows))
    assert model.languages == ["bb"]


def test_without_labels_every_text_is_unknown(make):
    docs = make([(1, "text", None, "s", 1), (2, None, "aa", "s", 1)])
    assert language_id.fit(docs) is None
    assert [tuple(row)[2:] for row in language_id.identify(docs, None).collect()] == [("und", 0.0)] * 2
    assert language_id.keep_confident(docs, None).count() == 0 and language_id.identify(make([]), None).count() == 0


def test_windows_cover_every_byte():
    texts = [b"x" * 300, b"", b"abc", b"y" * 256]
    data = np.frombuffer(b"".join(texts), np.uint8)
    block, row, length = language_id.windows(data, np.array([len(text) for text in texts]))
    assert row.tolist() == [0, 0, 0, 2, 3, 3] and length.tolist() == [128, 128, 44, 3, 128, 128]
    for number, text in enumerate(texts):
        assert b"".join(bytes(b[:n]) for b, n in zip(block[row == number], length[row == number])) == text


def test_joint_tables_equal_the_filters():
    random = np.random.default_rng(0)
    blocks = random.integers(0, 256, (20, language_id.WINDOW)).astype(np.uint8)
    model = language_id.train(blocks, ["a", "b"] * 10, epochs=1)
    tops, _ = language_id._responses(model.filters, blocks)
    raw = np.maximum(np.concatenate(tops, axis=1) + model.bias, 0)
    assert np.allclose(language_id.window_probabilities(model, blocks), language_id._softmax(raw @ model.weights + model.offset), atol=1e-5)
    whole = language_id.text_probabilities(model, pa.array(["ab" * 100, None, ""]))
    assert whole[0].sum() == pytest.approx(1) and not whole[1:].any()


@pytest.fixture(scope="module")
def rated(spark, make):
    random = np.random.default_rng(5)
    rows, marks = [], []
    for n in range(300):
        words = random.choice([f"plain{k}" for k in range(60)], 30).tolist()
        toxic = n % 5 == 0
        if toxic:
            words[random.integers(30)] = str(random.choice(["Vile!", "nasty,", "(awful)"]))
        rows.append((n, " ".join(words)))
        if n % 3:
            marks.append((n, int(n % 2), int(toxic)))
    rows += [(1000 + n, text) for n, text in enumerate(ODD)]
    labels = spark.createDataFrame(marks + [(None, 1, 1), (5000, None, None)], "doc_id long, quality int, toxic int")
    return make(rows, chances="1"), labels, dict(rows)


def test_toxic_documents_are_found(rated):
    docs, labels, rows = rated
    model = toxicity.fit(docs, labels)
    assert set(model.words) >= {"vile", "nasty", "awful"}
    found = {row["doc_id"]: row for row in toxicity.classify(docs, model).collect()}
    assert set(found) == set(rows)
    for key, row in found.items():
        assert row["toxic"] == (key < 300 and key % 5 == 0)
        assert all(0 <= row[f"p_{name}"] <= 1 for name in toxicity.CATEGORIES)
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and {row["doc_id"] for row in kept.collect()} == {k for k, r in found.items() if not r["toxic"]}


def test_without_both_classes_nothing_is_toxic(rated, make):
    docs, labels, rows = rated
    assert toxicity.fit(docs, labels.filter("toxic = 0")) is None and toxicity.fit(make([]), labels) is None
    found = toxicity.classify(docs, None).collect()
    assert len(found) == len(rows) and not any(row["toxic"] for row in found)


def test_chain_feeds_probabilities_on():
    random = np.random.default_rng(1)
    x = random.integers(0, 2, (200, 3)).astype(float)
    labels = np.stack([x[:, 0], x[:, 0] * x[:, 1]], axis=1)
    weights = toxicity.fit_chain(x, labels, np.arange(200) % 4)
    assert [len(part) for part in weights] == [4, 5]
    found = toxicity.predict_chain(x, weights)
    assert ((found > 0.5) == labels.astype(bool)).mean() > 0.95
    assert toxicity.fit_chain(x, labels, np.zeros(200))[1].shape == (5,)


def test_verdicts_do_not_depend_on_the_sampling(spark, make):
    """A word with a natural chance of about one in six is below the threshold in any sample of the corpus."""
    random = np.random.default_rng(7)
    rows, marks = [], []
    for n in range(1800):
        words = random.choice([f"plain{k}" for k in range(40)], 12).tolist()
        toxic = n % 9 == 0
        if toxic:
            words[0] = "grim" if n % 27 == 0 else "vile"
        elif n % 9 in (1, 2) and n % 3 != n // 9 % 3:
            words[0] = "grim"
        rows.append((n, " ".join(words)))
        marks.append((n, int(n % 2), int(toxic)))
    docs, labels = make(rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    found = []
    for per_class in (10_000, 200):
        model = toxicity.fit(docs, labels, per_class=per_class)
        assert {"grim", "vile"} <= set(model.words)
        found.append({row["doc_id"]: row for row in toxicity.classify(docs, model).collect()})
    natural, even = ({key: row["toxic"] for key, row in own.items()} for own in found)
    assert natural == even
    assert not any(even[key] for key, text in rows if "grim" in text) and all(even[key] for key, text in rows if "vile" in text)
    assert max(abs(found[0][key]["p_toxic"] - found[1][key]["p_toxic"]) for key, _ in rows) < 0.2
