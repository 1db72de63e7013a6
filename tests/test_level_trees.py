"""Trees grown by levels, forests and boosting against plain numpy on small tables."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from shelfcast.ml import growing, level_learners
from shelfcast.ml.growing import draw, draw_column, poisson_count
from shelfcast.ml.level_learners import Boosting, LevelTrees, rules_text
from shelfcast.ml.models import fit_model, predict
from shelfcast.ml.params import grid_points
from shelfcast.operators.quantiles import group_quantiles


def loss_of(y, criterion):
    """Impurity of some targets, summed; infinite if they may not be a leaf's."""
    if criterion == "absolute_error":
        return np.abs(y - np.median(y)).sum()
    if criterion == "poisson":
        if y.sum() <= 0:
            return np.inf
        return (np.where(y > 0, y * np.log(np.where(y > 0, y, 1)), 0)).sum() - y.sum() * np.log(y.mean())
    return ((y - y.mean()) ** 2).sum()


def numpy_tree(x, y, depth, criterion="squared_error", least_split=2, least_leaf=1, least_decrease=0.0, whole=None, path=1, order=None, one_cut=None):
    """A nested tree: (feature, cut, left, right) or a value."""
    whole = whole or len(y)
    value = np.median(y) if criterion == "absolute_error" else y.mean()
    if depth == 0 or len(y) < least_split or y.min() == y.max():
        return value
    best = None
    varying = [feature for feature in range(x.shape[1]) if x[:, feature].min() < x[:, feature].max()]
    for feature in order(path, varying) if order else varying:
        values = np.unique(x[:, feature])
        cuts = [one_cut(path, feature, values[0], values[-1])] if one_cut else (values[1:] + values[:-1]) / 2
        for cut in cuts:
            left = x[:, feature] <= cut
            if min(left.sum(), (~left).sum()) < least_leaf:
                continue
            gain = loss_of(y, criterion) - loss_of(y[left], criterion) - loss_of(y[~left], criterion)
            if np.isfinite(gain) and (best is None or gain > best[0] + 1e-9 * abs(best[0]) or (gain > best[0] - 1e-9 * abs(best[0]) and (feature, cut) < best[1:])):
                best = max(gain, best[0]) if best else gain, feature, cut
    if best is None or best[0] / whole < least_decrease:
        return value
    _, feature, cut = best
    left = x[:, feature] <= cut
    sides = [
        numpy_tree(x[side], y[side], depth - 1, criterion, least_split, least_leaf, least_decrease, whole, 2 * path + place, order, one_cut)
        for place, side in enumerate((left, ~left))
    ]
    return feature, cut, *sides


def value_of(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def predicted(tree, x):
    return np.array([value_of(tree, row) for row in x])


@pytest.fixture(scope="module")
def table():
    draws = np.random.default_rng(11)
    x = np.column_stack([draws.integers(0, 12, 160), draws.integers(0, 2, 160), draws.normal(size=160).round(2), np.zeros(160)]).astype(float)
    return x, np.abs(np.round(3 * x[:, 0] + 10 * x[:, 1] * (x[:, 2] > 0) + draws.normal(size=160), 3))


def vectors(spark, x, y, parts=3):
    rows = [(number, row.tolist(), float(value)) for number, (row, value) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id int, x array<double>, label double").repartition(parts, "id").withColumn("features", array_to_vector("x"))


def fitted(learner, df):
    rows = learner.fit(df).transform(df).orderBy("id").collect()
    return np.array([row["prediction"] for row in rows])


def tree(trees=1, bootstrap=False, **rules):
    return LevelTrees(rules=rules_text(**rules), trees=trees, bootstrap=bootstrap)


@pytest.mark.parametrize("on_driver", [True, False])
@pytest.mark.parametrize("rules, plain", [
    ({"max_depth": 3}, {"depth": 3}),
    ({"max_depth": 3, "criterion": "poisson"}, {"depth": 3, "criterion": "poisson"}),
    ({"max_depth": 4, "min_samples_split": 50, "min_samples_leaf": 9}, {"depth": 4, "least_split": 50, "least_leaf": 9}),
    ({"max_depth": 4, "min_impurity_decrease": 0.9}, {"depth": 4, "least_decrease": 0.9}),
    ({"max_depth": 4, "min_weight_fraction_leaf": 0.1}, {"depth": 4, "least_leaf": 16}),
])
def test_trees_are_those_of_numpy(spark, table, monkeypatch, on_driver, rules, plain):
    monkeypatch.setattr(growing, "FEW_CELLS", growing.FEW_CELLS if on_driver else 0)
    x, y = table
    grown = numpy_tree(x, y, **plain)
    assert isinstance(grown, tuple)
    assert fitted(tree(**rules), vectors(spark, x, y)) == pytest.approx(predicted(grown, x))


def test_trees_by_medians(spark, table):
    x, y = table
    grown = numpy_tree(x, y, 2, "absolute_error", least_leaf=7)
    assert fitted(tree(max_depth=2, criterion="absolute_error", min_samples_leaf=7), vectors(spark, x, y)) == pytest.approx(predicted(grown, x))


def test_random_cuts_and_features_are_drawn_from_digests(spark, table):
    x, y = table

    def order(path, varying):
        return sorted(varying, key=lambda feature: draw(5, 0, path, feature, "feature"))[:2]

    grown = numpy_tree(x, y, 3, order=order, one_cut=lambda path, feature, low, high: low + draw(5, 0, path, feature, "cut") * (high - low))
    learner = tree(max_depth=3, max_features=2, splitter="random", seed=5)
    for parts in (1, 9):
        assert fitted(learner, vectors(spark, x, y, parts)) == pytest.approx(predicted(grown, x))


def test_draws_are_the_same_in_columns(spark):
    row = spark.range(1).select(draw_column(42, F.lit("7"), "x").alias("u")).first()
    assert row["u"] == draw(42, 7, "x") and 0 <= row["u"] < 1
    chances = [0.0, 0.36, 0.37, 0.73, 0.74, 0.9199, 0.98, 0.999999999]
    counts = spark.createDataFrame([(c,) for c in chances], "u double").select(poisson_count(F.col("u")).alias("n")).collect()
    assert [row["n"] for row in counts] == [0, 0, 1, 1, 2, 3, 3, 11]


def test_forests_do_not_depend_on_partitions(spark, table):
    x, y = table
    x, y = np.r_[x, x[:20], x[:20]], np.r_[y, y[:20], y[:20]]  # with copies of rows
    learner = tree(4, True, max_depth=4, max_features=2, seed=3)
    few, many = (fitted(learner, vectors(spark, x, y, parts)) for parts in (3, 17))
    assert few == pytest.approx(many, rel=1e-12)
    assert ((y - few) ** 2).sum() < 0.5 * ((y - y.mean()) ** 2).sum()
    assert not np.allclose(few, fitted(tree(4, True, max_depth=4, max_features=2, seed=4), vectors(spark, x, y)))


def test_many_values_are_put_into_bins(spark, monkeypatch):
    x = np.column_stack([np.arange(100.0), np.arange(100) % 2])
    model = tree(max_depth=5, max_bins=4).fit(vectors(spark, x, x[:, 0]))
    cuts = sorted({node[1] for node in zip(model.node_tables[0].feature, model.node_tables[0].cut, model.node_tables[0].left) if node[2] and node[0] == 0})
    assert cuts == [24.0, 49.0, 74.0]
    assert sorted(set(fitted(tree(max_depth=2, max_bins=4), vectors(spark, x, x[:, 0])))) == [12.0, 37.0, 62.0, 87.0]


@pytest.mark.parametrize("learner, stores", [("levels", 60), ("auto", 45)])
def test_a_chain_of_splits_deeper_than_spark_allows(spark, learner, stores):
    """Each split takes one store off; without a limit every store is reproduced."""
    rows = spark.createDataFrame([(n, 4.0 ** n) for n in range(stores)], "store_nbr int, label double")
    rows = rows.selectExpr("*", "0 AS onpromotion", "1D AS dcoilwtico", "0 AS is_holiday", "'A' AS family")
    point = grid_points("decision", {"max_features": [None]})[0]
    model = fit_model(rows, "decision", point, learner=learner)
    assert model.stages[-1].depth > 30
    assert predict(model, rows).filter(F.abs(F.col("label") - F.col("prediction")) > 1e-9 * F.col("label")).count() == 0


def numpy_boosting(x, y, stages, depth, rate, loss):
    best = {"squared_error": np.mean, "quantile": lambda r: np.quantile(r, 0.9)}.get(loss, np.median)
    f = np.full(len(y), best(y))
    for _ in range(stages):
        r = y - f
        clip = np.quantile(np.abs(r), 0.9)
        target = {
            "squared_error": r, "absolute_error": np.where(r < 0, -1.0, 1.0), "quantile": np.where(r < 0, -0.1, 0.9), "huber": np.clip(r, -clip, clip),
        }[loss]
        leaf = predicted(numpy_tree(x, target, depth), x)
        for value in np.unique(leaf):
            own = leaf == value
            step = best(r[own])
            if loss == "huber":
                step += (np.sign(r[own] - step) * np.minimum(np.abs(r[own] - step), clip)).mean()
            f[own] += rate * step
    return f


@pytest.mark.parametrize("loss", ["squared_error", "absolute_error", "huber", "quantile"])
def test_boosting_is_that_of_numpy(spark, table, monkeypatch, loss):
    monkeypatch.setattr(level_learners, "STORE_EVERY", 2)
    x, y = table
    learner = Boosting(rules=rules_text(max_depth=2), stages=5, rate=0.4, loss=loss, alpha=0.9)
    assert fitted(learner, vectors(spark, x, y)) == pytest.approx(numpy_boosting(x, y, 5, 2, 0.4, loss))


def test_a_rate_of_zero_leaves_the_start(spark, table):
    x, y = table
    learner = Boosting(rules=rules_text(max_depth=1), stages=2, rate=0.0, loss="absolute_error", alpha=0.9)
    assert set(fitted(learner, vectors(spark, x, y))) == {np.median(y)}


def test_tables_that_cannot_be_divided(spark):
    same = vectors(spark, np.ones((5, 2)), np.array([1.0, 2.0, 3.0, 4.0, 10.0]))
    assert set(fitted(tree(), same)) == {4.0}
    assert set(fitted(tree(criterion="absolute_error"), same)) == {3.0}
    pure = vectors(spark, np.arange(6.0).reshape(3, 2), np.full(3, 7.0))
    assert set(fitted(tree(), pure)) == {7.0}
    with pytest.raises(ValueError, match="at least one row"):
        tree().fit(pure.limit(0))
    with pytest.raises(ValueError, match="poisson"):
        tree(criterion="poisson").fit(vectors(spark, np.ones((2, 1)), np.array([1.0, -1.0])))


def test_models_can_be_saved(spark, table, tmp_path):
    x, y = table
    df = vectors(spark, x, y)
    model = Pipeline(stages=[Boosting(rules=rules_text(max_depth=2), stages=3, rate=0.1, loss="squared_error", alpha=0.9)]).fit(df)
    model.write().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    one, two = ([row["prediction"] for row in m.transform(df).orderBy("id").collect()] for m in (model, again))
    assert one == two and len(set(one)) > 2


def test_quantiles_of_groups(spark):
    draws = np.random.default_rng(2)
    rows = [(int(g), float(v)) for g, v in zip(draws.integers(0, 4, 300), draws.integers(0, 40, 300))] + [(9, 1.0)]
    df = spark.createDataFrame(rows, "g int, v double").repartition(5)
    for share in (0.0, 0.25, 0.5, 0.9, 1.0):
        found = {row["g"]: row["quantile"] for row in group_quantiles(df, ["g"], "v", share)}
        assert found == {g: pytest.approx(np.quantile([v for own, v in rows if own == g], share)) for g in {g for g, _ in rows}}


def test_no_row_reaches_the_driver(spark, table, monkeypatch):
    """What a level collects is one row per open node and feature, at most."""
    monkeypatch.setattr(growing, "FEW_CELLS", 0)
    seen = []
    chosen = growing.Grower._chosen
    monkeypatch.setattr(growing.Grower, "_chosen", lambda self, found: seen.append(len(found)) or chosen(self, found))
    x, y = table
    tree(max_depth=3).fit(vectors(spark, x, y))
    assert [count <= 4 * 2**level for level, count in enumerate(seen)] == [True] * 3


@pytest.mark.parametrize("loss", ["squared_error", "huber"])
def test_boosting_goes_through_equal_rows_once(spark, table, monkeypatch, loss):
    x, y = table
    copies = np.arange(len(y)) % 3 + 1
    sizes = []

    class Counted(level_learners.Grower):
        def grow(self, rows, state=None):
            sizes.append(rows.count())
            return super().grow(rows, state)

    monkeypatch.setattr(level_learners, "Grower", Counted)
    x, y = np.repeat(x, copies, axis=0), np.repeat(y, copies)
    learner = Boosting(rules=rules_text(max_depth=2), stages=3, rate=0.4, loss=loss, alpha=0.9)
    assert fitted(learner, vectors(spark, x, y)) == pytest.approx(numpy_boosting(x, y, 3, 2, 0.4, loss))
    assert sizes == [len(np.unique(np.c_[x, y], axis=0))] * 3
