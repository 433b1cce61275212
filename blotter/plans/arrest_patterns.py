"""Arrests by month, hour and weekday."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.functions.cleaning import is_set
from blotter.operators.profiles import calendar_tally, profile_of_tally
from blotter.roles import ROLES, Roles
from blotter.runtime import materialise
from blotter.sources.sinks import write_tsv

PERIODS = ("month", "hour", "dow")


def arrest_patterns(
    incidents: DataFrame, out: str | None = None, roles: Roles = ROLES
) -> dict[str, DataFrame]:
    """``arrests_by_<period>`` with the bucket and ``n``; undated arrests in a null bucket.

    The incidents are read once, into a tally that all three profiles sum up.
    """
    arrests = incidents.filter(is_set(roles.arrest))
    tally = materialise(calendar_tally(arrests, roles.arrest, roles=roles))
    results = {
        f"arrests_by_{p}": profile_of_tally(
            tally, p, roles.arrest, drop_null_bucket=False
        ).select(F.col(p), "n")
        for p in PERIODS
    }
    if out:
        for name, result in results.items():
            write_tsv(result, f"{out}/{name}")
    return results
