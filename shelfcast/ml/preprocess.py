"""Preprocessing stages: impute, scale to [0, 1], one-hot encode.

``preprocessor`` chains them as the forecasting models use them. The stages are ordinary Spark ML
estimators; each fit is one aggregate and each transform is a projection of built-in expressions.
"""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F, types as T

from shelfcast.operators.filters import CATEGORICAL, NUMERIC

# Strategies and fill values.
NUMERIC_STRATEGIES = ["mean", "most_frequent", "constant"]
CATEGORICAL_STRATEGIES = ["most_frequent", "constant"]
NUMERIC_CONSTANT = 0.0
TEXT_CONSTANT = "missing_value"


class _InOut(HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, **kwargs) -> None:
        super().__init__()
        self._set(**self._input_kwargs)


def _modes(df: DataFrame, columns: list[str], held_out: Sequence[int] = ()) -> list[dict[str, object]]:
    """Most frequent value per column, the smallest one on ties: over all rows, or, given fold
    numbers, once without each of these folds and last over all rows.

    Counts are built per (column, value) with partial aggregation, so no task holds a whole column.
    """
    groups = [*held_out, None]
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in columns]))
    counts = (
        df.select(*(["fold"] if held_out else []), pairs.alias("pair"))
        .select("*", "pair.*")
        .filter(F.col("value").isNotNull())
        .groupBy("name", "value")
        .agg(*[_rows_without(fold).alias(f"rows_{fold}") for fold in groups])
    )

    def most(fold: int | None):
        rows = F.col(f"rows_{fold}")
        return F.min_by("value", F.when(rows > 0, F.struct(-rows, F.col("value")))).alias(f"mode_{fold}")

    best = counts.groupBy("name").agg(*[most(fold) for fold in groups]).collect()
    return [{row["name"]: row[f"mode_{fold}"] for row in best} for fold in groups]


def _rows_without(fold: int | None):
    return F.count(F.lit(1)) if fold is None else F.count_if(F.col("fold") != fold)


class FillMissing(Estimator, _InOut):
    """Learns one fill value per column; missing is NULL or NaN.

    ``strategy``: ``mean`` (numbers only), ``most_frequent`` or ``constant`` (0, or the text
    ``missing_value``). Numbers come out as doubles, so the mean of an integer column is not cut
    off. A column without any value is filled with the constant.
    """

    strategy = Param(Params._dummy(), "strategy", "mean, most_frequent or constant", TypeConverters.toString)

    def _fit(self, dataset: DataFrame) -> "FillMissingModel":
        columns, strategy = self.getInputCols(), self.getOrDefault(self.strategy)
        text = [isinstance(dataset.schema[c].dataType, T.StringType) for c in columns]
        if strategy not in NUMERIC_STRATEGIES or (strategy == "mean" and any(text)):
            raise ValueError(f"strategy {strategy!r} does not fit the columns {columns}")
        if any(text) != all(text):
            raise ValueError("do not mix text and number columns in one stage")
        default = TEXT_CONSTANT if all(text) else NUMERIC_CONSTANT
        found: dict[str, object] = {}
        present = dataset.select(*[_present(dataset, c).alias(c) for c in columns])
        if strategy == "mean":
            found = present.agg(*[F.avg(c).alias(c) for c in columns]).first().asDict()
        elif strategy == "most_frequent":
            found = _modes(present, columns)[-1]
        fills = [default if found.get(c) is None else found[c] for c in columns]
        return self._copyValues(FillMissingModel(fills=fills))


class FillMissingModel(Model, _InOut):
    strategy = FillMissing.strategy
    fills = Param(Params._dummy(), "fills", "fill value per input column", TypeConverters.toList)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        triples = zip(self.getInputCols(), self.getOutputCols(), self.getOrDefault(self.fills))
        return dataset.withColumns(
            {out: F.coalesce(_present(dataset, name), F.lit(fill)) for name, out, fill in triples}
        )


def _present(dataset: DataFrame, column: str):
    """The column with numbers as doubles and NaN as NULL."""
    if isinstance(dataset.schema[column].dataType, T.StringType):
        return F.col(column)
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


class ScaleToUnit(Estimator, _InOut):
    """Scales each column by its fitted minimum and maximum; later values may fall outside [0, 1].

    A constant column is only shifted, so it becomes 0.
    """

    def _fit(self, dataset: DataFrame) -> "ScaleToUnitModel":
        columns = self.getInputCols()
        bounds = dataset.agg(*[F.struct(F.min(c), F.max(c)).alias(c) for c in columns]).first()
        lows, highs = zip(*[[float("nan") if v is None else float(v) for v in bounds[c]] for c in columns])
        return self._copyValues(ScaleToUnitModel(lows=list(lows), highs=list(highs)))


class ScaleToUnitModel(Model, _InOut):
    lows = Param(Params._dummy(), "lows", "fitted minimum per column", TypeConverters.toListFloat)
    highs = Param(Params._dummy(), "highs", "fitted maximum per column", TypeConverters.toListFloat)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fitted = zip(
            self.getInputCols(), self.getOutputCols(), self.getOrDefault(self.lows), self.getOrDefault(self.highs)
        )
        return dataset.withColumns(
            {out: (F.col(c).cast("double") - low) / ((high - low) or 1.0) for c, out, low, high in fitted}
        )


def numeric_imputer(strategy: str, columns: list[str] = NUMERIC, prefix: str = "filled_") -> FillMissing:
    if strategy not in NUMERIC_STRATEGIES:
        raise ValueError(f"numeric strategy {strategy!r}: choose one of {NUMERIC_STRATEGIES}")
    return FillMissing(inputCols=columns, outputCols=[prefix + c for c in columns], strategy=strategy)


def categorical_imputer(strategy: str, columns: list[str] = CATEGORICAL, prefix: str = "filled_") -> FillMissing:
    if strategy not in CATEGORICAL_STRATEGIES:
        raise ValueError(f"categorical strategy {strategy!r}: choose one of {CATEGORICAL_STRATEGIES}")
    return FillMissing(inputCols=columns, outputCols=[prefix + c for c in columns], strategy=strategy)


def min_max(columns: list[str], outputs: list[str] | None = None) -> ScaleToUnit:
    return ScaleToUnit(inputCols=columns, outputCols=outputs or [f"scaled_{c}" for c in columns])


def one_hot(columns: list[str] = CATEGORICAL) -> Pipeline:
    """All levels kept, in alphabetical order; a level not seen in the fit is an error."""
    codes, vectors = [f"code_{c}" for c in columns], [f"onehot_{c}" for c in columns]
    return Pipeline(stages=[
        StringIndexer(inputCols=columns, outputCols=codes, stringOrderType="alphabetAsc", handleInvalid="error"),
        OneHotEncoder(inputCols=codes, outputCols=vectors, dropLast=False),
    ])


def one_hot_levels(model) -> list[list[str]]:
    """Levels per column of a fitted ``one_hot`` stage, in vector order."""
    return [list(levels) for levels in model.stages[0].labelsArray]


FILLED_NUMERIC = [f"filled_{c}" for c in NUMERIC]
FILLED_CATEGORICAL = [f"filled_{c}" for c in CATEGORICAL]
SCALED = [f"scaled_{c}" for c in NUMERIC]


def _assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=[*SCALED, *[f"onehot_{c}" for c in FILLED_CATEGORICAL]], outputCol="features")


def preprocessor(num_strategy: str = "mean", cat_strategy: str = "most_frequent") -> Pipeline:
    """Column ``features``: the four scaled numerics, then one slot per family."""
    return Pipeline(stages=[
        numeric_imputer(num_strategy),
        min_max(FILLED_NUMERIC, SCALED),
        categorical_imputer(cat_strategy),
        one_hot(FILLED_CATEGORICAL),
        _assembler(),
    ])


def fit_per_fold(
    rows: DataFrame, folds: int, num_strategy: str = "mean", cat_strategy: str = "most_frequent"
) -> list[PipelineModel]:
    """``preprocessor`` fitted once without each fold, and last on all ``rows`` (which have ``fold``).

    What the stages learn can be put together from per-fold sums, extremes and counts, so all fits
    share one pass over the numbers (two with ``most_frequent``) and one over the families, instead
    of four passes each.
    """
    numeric_imputer(num_strategy), categorical_imputer(cat_strategy)  # checks the strategies
    numbers = rows.select("fold", *[_present(rows, c).alias(c) for c in NUMERIC])
    per_fold = numbers.groupBy("fold").agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            F.struct(F.count(c).alias("n"), F.sum(c).alias("sum"), F.min(c).alias("low"), F.max(c).alias("high")).alias(c)
            for c in NUMERIC
        ],
    ).collect()
    modes = _modes(numbers, NUMERIC, range(folds)) if num_strategy == "most_frequent" else None
    groups = [*range(folds), None]
    families = rows.groupBy(CATEGORICAL).agg(*[_rows_without(fold).alias(f"rows_{fold}") for fold in groups]).collect()

    learned = []
    for number, fold in enumerate(groups):
        kept = [row for row in per_fold if row["fold"] != fold]
        fills, lows, highs = [], [], []
        for c in NUMERIC:
            stats = [row[c] for row in kept if row[c]["n"]]
            present = sum(part["n"] for part in stats)
            fill = NUMERIC_CONSTANT
            if stats and num_strategy == "mean":
                fill = sum(part["sum"] for part in stats) / present
            elif stats and num_strategy == "most_frequent":
                fill = modes[number][c]
            filled = [fill] if present < sum(row["rows"] for row in kept) else []
            fills.append(fill)
            lows.append(min([*(part["low"] for part in stats), *filled]))
            highs.append(max([*(part["high"] for part in stats), *filled]))
        counted = {row[CATEGORICAL[0]]: row[f"rows_{fold}"] for row in families if row[f"rows_{fold}"]}
        missing = counted.pop(None, 0)
        family_fill = TEXT_CONSTANT
        if counted and cat_strategy == "most_frequent":
            family_fill = min(counted, key=lambda level: (-counted[level], level))
        levels = sorted({*counted, *([family_fill] if missing else [])})
        learned.append((rows, fills, lows, highs, family_fill, levels))
    with ThreadPool(len(learned)) as pool:
        return pool.starmap(_assemble_fitted, learned)


def _assemble_fitted(rows: DataFrame, fills, lows, highs, family_fill: str, levels: list[str]) -> PipelineModel:
    codes, vectors = [f"code_{c}" for c in FILLED_CATEGORICAL], [f"onehot_{c}" for c in FILLED_CATEGORICAL]
    text = FillMissingModel(inputCols=CATEGORICAL, outputCols=FILLED_CATEGORICAL, fills=[family_fill])
    indexer = StringIndexerModel.from_arrays_of_labels(
        [levels], inputCols=FILLED_CATEGORICAL, outputCols=codes, handleInvalid="error"
    )
    # The encoder reads the number of levels from column metadata; this runs no job.
    encoder = OneHotEncoder(inputCols=codes, outputCols=vectors, dropLast=False)
    encoder = encoder.fit(indexer.transform(text.transform(rows)))
    return PipelineModel(stages=[
        FillMissingModel(inputCols=NUMERIC, outputCols=FILLED_NUMERIC, fills=fills),
        ScaleToUnitModel(inputCols=FILLED_NUMERIC, outputCols=SCALED, lows=lows, highs=highs),
        text,
        PipelineModel(stages=[indexer, encoder]),
        _assembler(),
    ])
