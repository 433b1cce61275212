"""Hotspots, correlated units and the comparison of two eras."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.operators.eras import era_means, paired_t
from blotter.operators.places import hotspots, pairwise_corr, strongest_first
from blotter.roles import MAYOR_ERAS, ROLES, Era, Roles
from blotter.runtime import materialise
from blotter.sources.sinks import write_text, write_tsv


def geography(
    incidents: DataFrame,
    out: str | None = None,
    hotspots_since: int = 2019,
    years: Sequence[int] = tuple(range(2017, 2023)),
    eras: Sequence[Era] = MAYOR_ERAS,
    roles: Roles = ROLES,
) -> dict[str, DataFrame]:
    """Named results: ``hotspots``, ``correlations``, ``era_means``, ``paired_t``.

    ``eras`` are two; the statistic is that of the first minus the second. The
    results are stored, so that writing and then showing them does not compute
    them twice.
    """
    first, second = eras
    means = materialise(era_means(incidents, roles.district, eras, roles))
    results = {
        "hotspots": materialise(
            hotspots(incidents, roles.block, hotspots_since, roles=roles)
        ),
        "correlations": strongest_first(
            materialise(pairwise_corr(incidents, roles.unit, years, digits=4, ordered=False, roles=roles))
        ),
        "era_means": means,
        "paired_t": paired_t(means, first.label, second.label),
    }
    if out:
        write_tsv(results["hotspots"], f"{out}/top_blocks")
        write_tsv(results["correlations"], f"{out}/correlations")
        shown = F.when(F.col("t").isNull(), "undefined").otherwise(F.format_string("%.4f", "t"))
        line = F.concat(F.lit("T-statistic: "), shown).alias("value")
        write_text(results["paired_t"].select(line), f"{out}/t_statistic")
    return results
