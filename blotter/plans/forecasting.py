"""Forecast of the violent incidents of each unit's next week."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from blotter.functions.cleaning import violent_flag
from blotter.operators.forecast import (
    fit_forecast,
    metrics_text,
    predict,
    regression_metrics,
)
from blotter.operators.panel import (
    add_calendar,
    densify,
    densify_by_calendar,
    features_full,
    split_by_date,
    split_by_index,
    test_part,
    train_part,
    week_calendar,
    weekly_panel,
)
from blotter.roles import ROLES, VIOLENT_14, Roles
from blotter.runtime import materialise
from blotter.sources.sinks import write_text

SPLITS = {"index": split_by_index, "date": split_by_date}


def forecast_next_week(
    incidents: DataFrame,
    out: str | None = None,
    violent: Iterable[str] = VIOLENT_14,
    week_mode: str = "iso",
    dense: bool = False,
    split: str = "index",
    fraction: float = 0.8,
    roles: Roles = ROLES,
    **fit_options,
) -> dict[str, DataFrame]:
    """Named results: ``predictions`` on the test rows and their ``metrics``.

    The panel with its features is stored once; the fit and the prediction
    read it many times and never go back to the incidents. Calendar weeks are
    densified and cut at a date by a calendar of their Mondays.
    """
    flagged = incidents.withColumn(roles.violent, violent_flag(roles.category, violent))
    panel = weekly_panel(flagged, [roles.unit], week_mode, roles)
    if week_mode == "calendar" and (dense or split == "date"):
        calendar = week_calendar(flagged, week_mode, roles)
        if dense:
            panel = densify_by_calendar(panel, calendar, [roles.unit])
        else:
            panel = add_calendar(panel, calendar)
    elif dense:
        panel = densify(panel, [roles.unit])
    features = materialise(features_full(panel, [roles.unit]))
    marked = SPLITS[split](features, fraction)
    categories = (roles.unit, "year", "week")
    model = fit_forecast(train_part(marked), categories=categories, **fit_options)
    scored = predict(model, test_part(marked))
    predictions = materialise(scored.select(*categories, "label", "prediction"))
    results = {"predictions": predictions, "metrics": regression_metrics(predictions)}
    if out:
        write_text(metrics_text(results["metrics"]), f"{out}/forecast_metrics")
    return results
