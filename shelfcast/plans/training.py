"""Training rows and model selection."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfcast.ml.models import with_label
from shelfcast.ml.search import ROW_ORDER, SearchResult, grid_search
from shelfcast.operators.filters import filter_year
from shelfcast.operators.joins import enrich


def training_rows(
    train: DataFrame, oil: DataFrame, holidays: DataFrame, year: int, dedupe: bool = False
) -> DataFrame:
    """One year of sales with the feature columns, ``label``, and the columns that order rows."""
    rows = with_label(enrich(filter_year(train, year), oil, holidays, dedupe))
    return rows.select(*ROW_ORDER, "onpromotion", "dcoilwtico", "is_holiday", "label")


def select_model(
    train: DataFrame, oil: DataFrame, holidays: DataFrame, year: int, model: str, dedupe: bool = False, **search
) -> SearchResult:
    """Grid search over one year; ``search`` are arguments of ``grid_search``."""
    return grid_search(training_rows(train, oil, holidays, year, dedupe), model, **search)
