"""Predictions for the test table."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from shelfcast.ml.models import predict
from shelfcast.operators.filters import feature_frame, prediction_output
from shelfcast.operators.joins import enrich


def forecast(
    fitted: PipelineModel, test: DataFrame, oil: DataFrame, holidays: DataFrame, dedupe: bool = False
) -> DataFrame:
    """``id, sales`` for every test row, of any year.

    Like the training rows, an id on a date with several holidays is repeated unless ``dedupe``.
    """
    rows = feature_frame(enrich(test, oil, holidays, dedupe), "id")
    return prediction_output(predict(fitted, rows))
