"""Rates by district and the differences of a forecast between district bands."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from blotter.functions.cleaning import violent_flag
from blotter.operators.fairness import (
    actual_vs_predicted,
    add_band,
    add_weights,
    calibrate_by_group,
    disparity,
    error_quartiles,
    fairness_by_group,
    group_weights,
    rate_by_group,
)
from blotter.operators.forecast import (
    FEATURES_BASE,
    fit_forecast,
    predict,
    regression_metrics,
)
from blotter.operators.panel import (
    features_base,
    split_by_index,
    test_part,
    train_part,
    weekly_panel,
)
from blotter.operators.ranking import top_k
from blotter.roles import ROLES, VIOLENT_14, Roles
from blotter.runtime import materialise
from blotter.sources.sinks import write_csv


def fairness_audit(
    incidents: DataFrame,
    out: str | None = None,
    violent: Iterable[str] = VIOLENT_14,
    week_mode: str = "iso",
    fraction: float = 0.8,
    reweight: bool = False,
    calibrate: bool = False,
    roles: Roles = ROLES,
    **fit_options,
) -> dict[str, DataFrame]:
    """Named results: ``arrest_rates`` and ``violent_rates`` (five highest),
    ``predictions``, ``metrics``, ``by_band``, ``disparity``, ``errors`` and
    ``cloud``.

    ``reweight`` gives every band the same weight in training; ``calibrate``
    adds the audit of predictions less their band's mean training error.
    """
    flagged = incidents.withColumn(roles.violent, violent_flag(roles.category, violent))
    flags = (roles.arrest, roles.violent)
    rates = materialise(rate_by_group(flagged, roles.district, flags))
    results = {
        f"{name}_rates": top_k(
            rates.select(roles.district, "n", f"{flag}_n", f"{flag}_pct"),
            f"{flag}_pct",
            5,
            ties=[roles.district],
        )
        for name, flag in zip(("arrest", "violent"), flags)
    }

    keys = (roles.unit, roles.district)
    panel = weekly_panel(flagged, keys, week_mode, roles)
    features = materialise(add_band(features_base(panel, keys), roles.district))
    marked = split_by_index(features, fraction)
    train, test = train_part(marked), test_part(marked)
    options = {"features": FEATURES_BASE, **fit_options}
    options["categories"] = (roles.unit, "year", "week")
    if reweight:
        train = materialise(add_weights(train, group_weights(train, "band"), "band"))
        options["weight_col"] = "weight"
    model = fit_forecast(train, **options)

    shown = (*keys, "year", "week", "band", "label", "prediction")
    predictions = materialise(predict(model, test).select(*shown))
    by_band = fairness_by_group(predictions, "band")
    results |= {
        "predictions": predictions,
        "metrics": regression_metrics(predictions),
        "by_band": by_band,
        "disparity": disparity(by_band),
        "errors": error_quartiles(predictions, "band"),
        "cloud": actual_vs_predicted(predictions, "band"),
    }
    if calibrate:
        fitted = predict(model, train).select("band", "label", "prediction")
        adjusted = calibrate_by_group(fitted, predictions, "band")
        results["calibrated_by_band"] = fairness_by_group(
            adjusted, "band", prediction="calibrated"
        )
    if out:
        write_csv(by_band, f"{out}/fairness_by_band")
    return results
