"""Distribution by district and category, calendar profiles and the summary."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from blotter.functions.cleaning import violent_flag
from blotter.operators.profiles import (
    add_share_pct,
    calendar_tally,
    counts_of_tally,
    profile_of_tally,
)
from blotter.operators.summary import summary_of_tally, summary_text
from blotter.roles import ROLES, VIOLENT_10, Roles
from blotter.runtime import materialise
from blotter.sources.sinks import write_csv, write_text


def temporal_report(
    incidents: DataFrame,
    out: str | None = None,
    violent: Iterable[str] = VIOLENT_10,
    since: int = 2001,
    top: int = 15,
    roles: Roles = ROLES,
) -> dict[str, DataFrame]:
    """Named results: ``districts``, ``categories``, ``by_month``, ``by_hour``
    (with the violent percentage), ``by_dow``, ``by_year`` and ``summary``.

    One pass over the incidents gives the tally behind all of them.
    """
    flag = roles.violent
    flagged = incidents.withColumn(flag, violent_flag(roles.category, violent, null_as=0))
    keys = [roles.category, roles.district]
    tally = materialise(calendar_tally(flagged, flag, keys, roles))
    results = {
        "districts": counts_of_tally(tally, roles.district),
        "categories": counts_of_tally(tally, roles.category, top=top),
        "by_month": profile_of_tally(tally, "month", flag, complement=True),
        "by_hour": add_share_pct(profile_of_tally(tally, "hour", flag), flag),
        "by_dow": profile_of_tally(tally, "dow", flag),
        "by_year": profile_of_tally(tally, "year", flag, since=since),
        "summary": summary_of_tally(tally, flag, since, roles),
    }
    if out:
        write_csv(results["districts"], f"{out}/district_distribution")
        write_csv(results["categories"], f"{out}/category_distribution")
        write_text(summary_text(results["summary"], flag), f"{out}/summary")
    return results
