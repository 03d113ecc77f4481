"""Saved forecast models, keyed by their training arguments."""

from __future__ import annotations

from pyspark.ml import PipelineModel

from docklens.config import as_date, as_datetime, check_city
from docklens.functions.timecols import step_text
from docklens.plans.timeseries import Time


def model_path(
    lake: str, city: str, start: Time, stop: Time, validation: Time, frequency: str
) -> str:
    check_city(city)
    first, last = as_date(as_datetime(start)), as_date(as_datetime(stop))
    cut = as_datetime(validation).strftime("%Y%m%dT%H%M%S")
    name = f"{first}_{last}_cut-{cut}_freq-{step_text(frequency)}"
    return f"{lake.rstrip('/')}/model/{city}/{name}"


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
