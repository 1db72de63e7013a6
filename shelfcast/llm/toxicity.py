"""Toxicity by a chain of linear classifiers.

Categories are predicted one after another; each later model sees the probabilities of the earlier
ones besides the words. So that it learns from probabilities as they will be at prediction time, the
earlier categories' training values are out of fold: predicted by models that have not seen the row.

The words are those of a bounded sample of labelled documents that tell its categories apart, by the
likelihood ratio of their document counts. Only sampled documents' distinct words reach the driver.
Where the sample holds a smaller share of one class than of the other, its rows count for more, so
that probabilities are those of the labels' own mix whatever the table's size.
Prediction looks up the learned words in each whole text with SQL functions and passes just those on.

Defined results: a null, empty or wordless text has the probabilities of a text without any learned
word and is never toxic; without both labelled classes nothing is toxic and all probabilities are 0;
several labels of a document count each; equal texts get equal results, and rows repeat as given.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.llm.columns import fresh, ship

# A category is named and told from the label columns. The order is that of the chain.
CATEGORIES = {
    "toxic": "toxic = 1",
    "toxic_good_text": "toxic = 1 AND quality = 1",
    "toxic_poor_text": "toxic = 1 AND quality = 0",
}
NOT_WORD = r"[^\p{L}\p{N}]+"
LEAST_EVIDENCE = 15.0  # likelihood ratio statistic from which a word is learned
FOLDS = 4


@dataclass(frozen=True)
class ToxicityModel:
    words: list[str]
    categories: list[str]
    weights: list[np.ndarray]  # per category: words, earlier categories, constant


def words_of(text: Column) -> Column:
    return F.array_distinct(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD))


def _likelihood_ratio(inside: np.ndarray, outside: np.ndarray, n_inside: int, n_outside: int) -> np.ndarray:
    """Twice the log-likelihood gained by two rates of a word instead of one."""

    def entropy(hits, total):
        rate = np.clip(hits / max(total, 1), 1e-12, 1 - 1e-12)
        return hits * np.log(rate) + (total - hits) * np.log(1 - rate)

    both = entropy(inside + outside, n_inside + n_outside)
    return 2 * (entropy(inside, n_inside) + entropy(outside, n_outside) - both)


def select_words(rows: Sequence[Sequence[str]], labels: np.ndarray, most: int) -> list[str]:
    """At most ``most`` words whose document counts differ most between classes, in any category."""
    every = Counter(word for row in rows for word in row if word)
    frequent = [word for word, count in every.items() if count >= 5]
    best: dict[str, float] = {}
    for column in labels.T:
        within = Counter(word for row, hit in zip(rows, column) if hit for word in row)
        inside = np.array([within[word] for word in frequent], float)
        outside = np.array([every[word] for word in frequent], float) - inside
        ratio = _likelihood_ratio(inside, outside, int(column.sum()), int(len(column) - column.sum()))
        for word, value in zip(frequent, ratio.tolist()):
            best[word] = max(best.get(word, 0.0), value)
    ranked = sorted((-value, word) for word, value in best.items() if value >= LEAST_EVIDENCE)
    return [word for _, word in ranked[:most]]


def fit_linear(x: np.ndarray, y: np.ndarray, ridge: float = 0.2, rounds: int = 25, counts: np.ndarray | None = None) -> np.ndarray:
    """Logistic regression by Newton steps; the last weight is the constant, which is not shrunk.

    ``counts`` says for how many rows each row stands, one by default.
    """
    x = np.hstack([x, np.ones((len(x), 1))])
    counts = np.ones(len(x)) if counts is None else counts
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    weights = np.zeros(x.shape[1])
    for _ in range(rounds):
        chance = _logistic(x @ weights)
        gradient = x.T @ (counts * (chance - y)) + penalty * weights
        curvature = (x * (counts * chance * (1 - chance))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curvature, gradient)
        weights -= step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return weights


def _logistic(score: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(score, -30, 30)))


def fit_chain(x: np.ndarray, labels: np.ndarray, fold: np.ndarray, counts: np.ndarray | None = None) -> list[np.ndarray]:
    """One weight vector per category, in order; earlier categories enter out of fold."""
    weights = []
    counts = np.ones(len(x)) if counts is None else counts
    for column in labels.T:
        weights.append(fit_linear(x, column, counts=counts))
        unseen = np.zeros(len(x))
        for number in np.unique(fold):
            inside = fold == number
            part = fit_linear(x[~inside], column[~inside], counts=counts[~inside]) if (~inside).any() else weights[-1]
            unseen[inside] = _logistic(np.hstack([x[inside], np.ones((inside.sum(), 1))]) @ part)
        x = np.hstack([x, unseen[:, None]])
    return weights


def predict_chain(x: np.ndarray, weights: Sequence[np.ndarray]) -> np.ndarray:
    """Probabilities per category, each fed to the next."""
    found = []
    for part in weights:
        chance = _logistic(np.hstack([x, np.ones((len(x), 1))]) @ part)
        found.append(chance)
        x = np.hstack([x, chance[:, None]])
    return np.stack(found, axis=1)


def fit(
    docs: DataFrame, labels: DataFrame, categories: dict[str, str] | None = None,
    per_class: int = 2000, most_words: int = 400,
) -> ToxicityModel | None:
    """A model from about ``per_class`` documents with and without the first category, by a hash of the id.

    ``labels`` has ``doc_id`` and the columns that the category conditions name. None unless both
    classes occur. The picked ids, twice ``per_class`` of them, are broadcast, so texts stay in place.
    """
    categories = categories or CATEGORIES
    names = list(categories)
    hits = [F.coalesce(F.expr(condition), F.lit(False)).alias(f"hit{n}") for n, condition in enumerate(categories.values())]
    marked = labels.filter(F.col("doc_id").isNotNull()).select("doc_id", *hits)
    sizes = {row["hit0"]: row["count"] for row in marked.groupBy("hit0").count().collect()}
    if len(sizes) < 2:
        return None
    hashed = F.pmod(F.xxhash64(F.lit("toxicity sample"), F.col("doc_id").cast("string")), F.lit(1_000_003))
    shares = {hit: min(1.0, per_class / size) for hit, size in sizes.items()}
    picked = marked.filter(hashed / 1_000_003 < F.when(F.col("hit0"), shares[True]).otherwise(shares[False]))
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(picked), "doc_id")
        .select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).alias("fold"), words_of(F.col("text")).alias("words"), *[f"hit{n}" for n in range(len(names))])
        .orderBy("doc_id", *[f"hit{n}" for n in range(len(names))])
        .collect()
    )
    y = np.array([[row[f"hit{n}"] for n in range(len(names))] for row in rows], float)
    if not len(y) or y[:, 0].min() == y[:, 0].max():
        return None
    words = select_words([row["words"] for row in rows], y, most_words)
    place = {word: number for number, word in enumerate(words)}
    x = np.zeros((len(rows), len(words)))
    for number, row in enumerate(rows):
        x[number, [place[word] for word in row["words"] if word in place]] = 1
    # The class with the larger share counts once, so that evidence never outgrows the sample's.
    counts = np.where(y[:, 0] == 1, max(shares.values()) / shares[True], max(shares.values()) / shares[False])
    return ToxicityModel(words, names, fit_chain(x, y, np.array([row["fold"] for row in rows]), counts))


def _chances(model: ToxicityModel):
    place = {word: number for number, word in enumerate(model.words)}

    @F.pandas_udf("array<double>")
    def chances(found: pd.Series) -> pd.Series:
        x = np.zeros((len(found), len(place)))
        for number, words in enumerate(found):
            x[number, [place[word] for word in words]] = 1
        return pd.Series(list(predict_chain(x, model.weights)))

    return chances


def with_probabilities(docs: DataFrame, model: ToxicityModel | None, name: str) -> DataFrame:
    """``docs`` with ``name``, an array of probabilities in the order of the categories."""
    ship(docs.sparkSession)
    if model is None:
        return docs.withColumn(name, F.array(*[F.lit(0.0) for _ in CATEGORIES]))
    if not model.words:
        return docs.withColumn(name, F.array(*[F.lit(float(p)) for p in predict_chain(np.zeros((1, 0)), model.weights)[0]]))
    learned = F.array(*[F.lit(word) for word in model.words])
    return docs.withColumn(name, _chances(model)(F.array_intersect(words_of(F.col("text")), learned)))


def _is_toxic(chances: Column, text: Column, threshold: float) -> Column:
    worded = F.coalesce(text.rlike(r"[\p{L}\p{N}]"), F.lit(False))
    return worded & (chances[0] >= threshold)


def classify(docs: DataFrame, model: ToxicityModel | None, threshold: float = 0.3) -> DataFrame:
    """``doc_id, toxic`` and a probability ``p_<category>`` per category, for every row."""
    names = model.categories if model else list(CATEGORIES)
    found = with_probabilities(docs.select("doc_id", "text"), model, "chances")
    return found.select(
        "doc_id",
        _is_toxic(F.col("chances"), F.col("text"), threshold).alias("toxic"),
        *[F.col("chances")[number].alias(f"p_{name}") for number, name in enumerate(names)],
    )


def drop_toxic(docs: DataFrame, model: ToxicityModel | None, threshold: float = 0.3) -> DataFrame:
    """Rows of ``docs`` that are not toxic; same columns."""
    name = fresh(docs, "chances")
    found = with_probabilities(docs, model, name)
    return found.filter(~_is_toxic(F.col(name), F.col("text"), threshold)).drop(name)
