"""Registered queries, each over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.functions.cleaning import band, clean_district, violent_flag
from blotter.operators import (
    encoding,
    eras,
    fairness,
    forecast,
    panel,
    places,
    profiles,
    summary,
)
from blotter.operators.ranking import top_k
from blotter.roles import Era
from blotter.runtime import materialise, scratch_path
from blotter.sources.incidents import (
    normalise,
    read_incidents_csv,
    read_mixed_csv,
    read_with_rejects,
)
from blotter.sources.sinks import write_csv, write_parquet, write_text, write_tsv
from catalogue.fixtures import (
    ORDER_VIOLENT,
    cut_lines,
    dated_orders,
    dirty_text,
    event_incidents,
    order_incidents,
    raw_text,
    write_lines,
)

Query = Callable[[SparkSession, str], DataFrame]

YEARS = tuple(range(1995, 2001))
STRONG = 0.99
ERAS = (Era("early", 1995, 1998), Era("late", 1999, 2001))
UNIT_DISTRICT = ("unit", "district")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double, so that two engines can be compared."""
    return df.select(
        *[
            F.round(c, digits).alias(c) if kind == "double" else F.col(c)
            for c, kind in df.dtypes
        ]
    )


# --- profiles ---------------------------------------------------------------


def arrests_by_month(spark, sf):
    inc = dated_orders(spark, sf)
    return profiles.count_by_period(inc, "month", where="arrest", drop_null_bucket=False)


def arrests_by_hour(spark, sf):
    inc = event_incidents(spark, sf)
    return profiles.count_by_period(inc, "hour", where="arrest", drop_null_bucket=False)


def arrests_by_dow(spark, sf):
    inc = dated_orders(spark, sf)
    return profiles.count_by_period(inc, "dow", where="arrest", drop_null_bucket=False)


def arrests_by_year_month(spark, sf):
    inc = dated_orders(spark, sf)
    return profiles.count_by_period(inc, ["year", "month"], where="arrest")


def arrest_rate_by_month(spark, sf):
    return rounded(profiles.share_by_period(dated_orders(spark, sf), "month", "arrest"))


def counts_by_district(spark, sf):
    text = raw_text(order_incidents(spark, sf))
    return profiles.category_counts(text, clean_district("District"), name="district")


def top_categories(spark, sf):
    return profiles.category_counts(dated_orders(spark, sf), "category", top=15)


def monthly_violent(spark, sf):
    inc = dated_orders(spark, sf)
    return profiles.count_by_period(
        inc, "month", flags=["violent"], complement=True, fill_buckets=True
    )


def hourly_violent(spark, sf):
    inc = event_incidents(spark, sf)
    return profiles.count_by_period(inc, "hour", flags=["violent"], fill_buckets=True)


def dow_violent(spark, sf):
    return profiles.count_by_period(dated_orders(spark, sf), "dow", flags=["violent"])


def yearly_violent(spark, sf):
    inc = dated_orders(spark, sf)
    return profiles.count_by_period(inc, "year", flags=["violent"], since=1995)


def hourly_violent_pct(spark, sf):
    return rounded(profiles.share_by_period(event_incidents(spark, sf), "hour", "violent"))


def hourly_violent_pct_mean(spark, sf):
    inc = event_incidents(spark, sf)
    shares = profiles.share_by_period(inc, "hour", "violent", ordered=False)
    return rounded(profiles.mean_share(shares, "violent"))


# --- summary ----------------------------------------------------------------


def overall_summary(spark, sf):
    return rounded(summary.overall_summary(dated_orders(spark, sf)))


def peak_buckets(spark, sf):
    return summary.peak_buckets(event_incidents(spark, sf))


def violent_pct_extremes(spark, sf):
    return rounded(summary.share_extremes(event_incidents(spark, sf), "hour", "violent"))


def top_category_share(spark, sf):
    return rounded(summary.top_share(dated_orders(spark, sf)))


def yearly_change(spark, sf):
    return rounded(summary.yearly_change(dated_orders(spark, sf), since=1995))


def summary_report(spark, sf):
    return rounded(summary.summary_report(dated_orders(spark, sf), since=1995))


def summary_report_events(spark, sf):
    return rounded(summary.summary_report(event_incidents(spark, sf)))


# --- places and eras --------------------------------------------------------


def hotspots_top10(spark, sf):
    return places.hotspots(dated_orders(spark, sf), since=1999)


def unit_year_counts(spark, sf):
    return places.yearly_counts(order_incidents(spark, sf), since=1995)


def unit_year_matrix(spark, sf):
    return places.yearly_matrix(order_incidents(spark, sf), years=YEARS)


def pair_correlation(spark, sf):
    return places.pairwise_corr(order_incidents(spark, sf), years=YEARS, digits=9)


def pair_correlation_full(spark, sf):
    return places.corr_matrix(order_incidents(spark, sf), years=YEARS, digits=9)


def strong_pairs(spark, sf):
    """Customers whose yearly counts move alike, or against each other."""
    return places.strong_pairs(
        order_incidents(spark, sf), STRONG, unit="block", years=YEARS, digits=6
    )


def hierarchy_counts(spark, sf):
    return places.hierarchy_counts(order_incidents(spark, sf))


def era_counts(spark, sf):
    return eras.era_counts(order_incidents(spark, sf), "district", ERAS)


def era_means(spark, sf):
    return rounded(eras.era_means(order_incidents(spark, sf), "district", ERAS))


def era_counts_many(spark, sf):
    """One era per nation: overlapping spans, some open, some without incidents."""
    nation = spark.read.parquet(f"{sf}/nation.parquet")
    key = F.col("n_nationkey").cast("int")
    many = nation.select(
        F.col("n_name").alias("label"),
        F.when(key % 7 != 0, 1992 + key % 8).alias("first"),
        F.when(key % 5 != 0, 1992 + key % 8 + key % 4).alias("last"),
    )
    return eras.era_counts_by_table(order_incidents(spark, sf), "district", many)


def paired_t(spark, sf):
    means = eras.era_means(order_incidents(spark, sf), "district", ERAS)
    return rounded(eras.paired_t(means, "early", "late"), 4)


def paired_t_by_category(spark, sf):
    """Two like eras, compared over the districts for each category."""
    counts = order_incidents(spark, sf).groupBy("category", "district").agg(
        F.count_if(F.year("ts").between(1995, 1996)).alias("a"),
        F.count_if(F.year("ts").between(1997, 1998)).alias("b"),
    )
    return rounded(eras.paired_t(counts, "a", "b", by=["category"]), 9)


# --- sources and sinks ------------------------------------------------------


def tsv_roundtrip(spark, sf):
    path = scratch_path(spark, "tsv")
    write_tsv(places.yearly_counts(order_incidents(spark, sf), since=1995), path)
    return spark.read.schema("unit string, year int, n bigint").option("sep", "\t").csv(path)


def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    write_csv(raw_text(order_incidents(spark, sf)), path)
    return normalise(read_incidents_csv(spark, path), ORDER_VIOLENT)


def csv_mixed_headers(spark, sf):
    """The raw rows in files of three headers: as they are, turned round, and one column other."""
    path = scratch_path(spark, "mixed")
    text = raw_text(order_incidents(spark, sf))
    part = F.col("ID").cast("bigint") % 3
    for k, columns in enumerate((text.columns, text.columns[::-1], [c for c in text.columns if c != "Domestic"] + ["Ward"])):
        rows = text.withColumn("Ward", F.lit("7")).filter(part == k)
        write_csv(rows.select(*[f"`{c}`" for c in columns]), path, mode="append")
    return normalise(read_mixed_csv(spark, path), ORDER_VIOLENT)


def malformed_rows(spark, sf):
    """Every row of a file with cut lines: typed, or rejected with its reason."""
    path = scratch_path(spark, "cut-lines")
    write_lines(cut_lines(order_incidents(spark, sf)), path)
    good, rejects = read_with_rejects(spark, path)
    kept = normalise(good, ORDER_VIOLENT).select(
        "id", "unit", "district", F.lit("").alias("reason"), F.lit(len(good.columns)).alias("fields")
    )
    record_id = F.split("record", ",")[0].try_cast("bigint").alias("id")
    return kept.unionByName(rejects.select(record_id, "reason", "fields"), allowMissingColumns=True)


def parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "parquet")
    write_parquet(order_incidents(spark, sf), path)
    return spark.read.parquet(path)


def text_roundtrip(spark, sf):
    path = scratch_path(spark, "text")
    write_text(summary.summary_text(summary.summary_report(event_incidents(spark, sf))), path)
    return spark.read.text(path)


def clean_text_fields(spark, sf):
    return normalise(raw_text(order_incidents(spark, sf)), ORDER_VIOLENT)


def violent_flags(spark, sf):
    inc = dated_orders(spark, sf)
    category = F.nullif("category", F.lit("5-LOW"))
    return inc.select(
        "id",
        violent_flag(category, ORDER_VIOLENT).alias("flag_or_null"),
        violent_flag(category, ORDER_VIOLENT, null_as=0).alias("flag_or_zero"),
    )


# --- dirty input ---


def _dirty(spark, sf) -> DataFrame:
    return normalise(dirty_text(order_incidents(spark, sf)), ORDER_VIOLENT)


def clean_dirty_fields(spark, sf):
    return _dirty(spark, sf)


def arrests_by_month_undated(spark, sf):
    """Undated arrests have a bucket of their own."""
    return profiles.count_by_period(_dirty(spark, sf), "month", where="arrest", drop_null_bucket=False)


def monthly_violent_dirty(spark, sf):
    inc = _dirty(spark, sf).withColumn("violent", violent_flag("category", ORDER_VIOLENT, null_as=0))
    return profiles.count_by_period(inc, "month", flags=["violent"], complement=True)


def counts_by_district_dirty(spark, sf):
    text = dirty_text(order_incidents(spark, sf))
    return profiles.category_counts(text, clean_district("District"), name="district")


def hotspots_dirty(spark, sf):
    return places.hotspots(_dirty(spark, sf), since=1999)


def panel_dirty(spark, sf):
    """Undated incidents drop, unknown flags and categories count as null."""
    return rounded(panel.weekly_panel(_dirty(spark, sf), UNIT_DISTRICT))


def fairness_unknown_band(spark, sf):
    p = panel.weekly_panel(_dirty(spark, sf), UNIT_DISTRICT)
    scored = forecast.persistence(fairness.add_band(panel.features_base(p)))
    return rounded(fairness.fairness_by_group(scored, "band"))


# --- panel ------------------------------------------------------------------


def weekly_panel(spark, sf):
    return rounded(panel.weekly_panel(order_incidents(spark, sf)))


def weekly_panel_calendar(spark, sf):
    return rounded(panel.weekly_panel(order_incidents(spark, sf), week_mode="calendar"))


def weekly_panel_district(spark, sf):
    return rounded(panel.weekly_panel(order_incidents(spark, sf), UNIT_DISTRICT))


def panel_lags(spark, sf):
    p = panel.weekly_panel(order_incidents(spark, sf))
    lagged = panel.add_lags(panel.add_lags(p, "total", [1, 2, 3]), "violent", [1, 2])
    return lagged.select(
        "unit", "year", "week", *[c for c in lagged.columns if "_lag_" in c]
    )


def panel_rolling(spark, sf):
    p = panel.weekly_panel(order_incidents(spark, sf))
    for col, size in (("total", 3), ("violent", 3), ("total", 4)):
        p = panel.add_rolling(p, col, size)
    return rounded(p.select("unit", "year", "week", *[c for c in p.columns if "_mean_" in c]))


def panel_label(spark, sf):
    p = panel.add_label(panel.weekly_panel(order_incidents(spark, sf)))
    return p.filter(F.col("label").isNotNull()).select("unit", "year", "week", "label")


def panel_flags_trend(spark, sf):
    p = panel.add_lags(panel.weekly_panel(order_incidents(spark, sf)), "total", [1])
    p = panel.add_trend(panel.add_season_flags(p))
    return rounded(
        p.select("unit", "year", "week", "is_summer", "is_winter", "is_holiday_season", "trend")
    )


def panel_shares(spark, sf):
    p = panel.add_share(panel.weekly_panel(order_incidents(spark, sf)))
    return rounded(p.select("unit", "year", "week", "violent_share", "total_per_violent"))


def panel_dense(spark, sf):
    return rounded(panel.densify(panel.weekly_panel(order_incidents(spark, sf))))


def panel_dense_calendar(spark, sf):
    inc = order_incidents(spark, sf)
    calendar = panel.week_calendar(inc, "calendar")
    p = panel.weekly_panel(inc, week_mode="calendar")
    return rounded(panel.densify_by_calendar(p, calendar).drop("position"))


def panel_split_calendar(spark, sf):
    inc = order_incidents(spark, sf)
    dated = panel.add_calendar(
        panel.weekly_panel(inc, week_mode="calendar"), panel.week_calendar(inc, "calendar")
    )
    return _split_columns(panel.split_by_date(materialise(panel.features_full(dated))))


def _split_columns(split: DataFrame) -> DataFrame:
    return split.select("unit", "year", "week", "label", "time_index", "split")


def panel_split(spark, sf):
    features = materialise(panel.features_full(panel.weekly_panel(order_incidents(spark, sf))))
    return _split_columns(panel.split_by_index(features))


def panel_split_by_date(spark, sf):
    features = materialise(panel.features_full(panel.weekly_panel(order_incidents(spark, sf))))
    return _split_columns(panel.split_by_date(features))


def features_full(spark, sf):
    return rounded(panel.features_full(panel.weekly_panel(order_incidents(spark, sf))))


def features_full_calendar(spark, sf):
    p = panel.weekly_panel(order_incidents(spark, sf), week_mode="calendar")
    return rounded(panel.features_full(p))


def features_full_dense(spark, sf):
    return rounded(panel.features_full(panel.densify(panel.weekly_panel(order_incidents(spark, sf)))))


def _base_features(spark, sf) -> DataFrame:
    p = panel.weekly_panel(order_incidents(spark, sf), UNIT_DISTRICT)
    return fairness.add_band(panel.features_base(p))


def features_base(spark, sf):
    return rounded(_base_features(spark, sf))


# --- forecast ---------------------------------------------------------------


def category_index(spark, sf):
    p = materialise(panel.weekly_panel(order_incidents(spark, sf)).select("unit", "year", "week"))
    return encoding.category_index(p, forecast.CATEGORIES)


def _by_district(inc: DataFrame) -> DataFrame:
    """The districts as units: dense series that a forecast can learn from."""
    return inc.withColumn("unit", F.lpad(F.col("district").cast("string"), 2, "0"))


def gbt_forecast(spark, sf):
    p = panel.weekly_panel(_by_district(order_incidents(spark, sf)))
    split = panel.split_by_index(materialise(panel.features_full(p)))
    model = forecast.fit_forecast(panel.train_part(split))
    scored = forecast.predict(model, panel.test_part(split))
    return scored.select("unit", "year", "week", "label", "prediction")


def feature_slots(spark, sf):
    """Vectors of the whole panel, by the dictionary of its training part."""
    features = panel.features_full(panel.weekly_panel(order_incidents(spark, sf)))
    split = panel.split_by_index(materialise(rounded(features)))
    known = materialise(encoding.category_index(panel.train_part(split), forecast.CATEGORIES))
    return encoding.feature_slots(
        split, known, forecast.CATEGORIES, forecast.CATEGORIES, forecast.FEATURES_FULL
    )


def gbt_table_parity(spark, sf):
    """By unit, the rows whose forecast from the table of nodes is not that of the model."""
    p = panel.weekly_panel(_by_district(order_incidents(spark, sf)))
    split = panel.split_by_index(materialise(panel.features_full(p)))
    train, test = panel.train_part(split), panel.test_part(split)
    model = forecast.fit_forecast(train)
    known = materialise(encoding.category_index(train, forecast.CATEGORIES))
    nodes = materialise(forecast.model_table(model))
    rows = encoding.encoded(
        forecast.predict(model, test), known, forecast.CATEGORIES, forecast.FEATURES_FULL
    )
    scored = forecast.predict_by_table(rows, nodes, prediction="by_table")
    missed = F.abs(F.col("by_table") - F.col("prediction")) > 1e-9
    return scored.groupBy("unit").agg(
        F.count("*").alias("n"),
        F.sum("label").alias("label_sum"),
        F.count_if(F.col("by_table").isNull()).alias("nulls"),
        F.count_if(missed).alias("mismatches"),
    )


def gbt_fairness(spark, sf):
    p = panel.weekly_panel(_by_district(order_incidents(spark, sf)), UNIT_DISTRICT)
    split = panel.split_by_index(materialise(fairness.add_band(panel.features_base(p))))
    model = forecast.fit_forecast(panel.train_part(split), features=forecast.FEATURES_BASE)
    return fairness.fairness_by_group(forecast.predict(model, panel.test_part(split)), "band")


def oof_calibration(spark, sf):
    """By band: errors out of fold, less the band's mean error out of fold."""
    p = panel.weekly_panel(_by_district(order_incidents(spark, sf)), UNIT_DISTRICT)
    rows = materialise(fairness.add_band(panel.features_base(p)))
    scored = forecast.out_of_fold(
        rows, "band", folds=3, features=forecast.FEATURES_BASE, max_iter=20
    )
    adjusted = fairness.calibrate_by_group(scored, scored, "band")
    by_band = fairness.fairness_by_group(adjusted, "band", prediction="calibrated")
    # Adding zero turns a negative zero into zero.
    return by_band.select(
        "band",
        "n",
        F.round("actual_avg", 6).alias("actual_avg"),
        F.round("predicted_avg", 6).alias("calibrated_avg"),
        (F.round("mean_error", 6) + F.lit(0.0)).alias("mean_error"),
    )


def _persistence(spark, sf) -> DataFrame:
    return forecast.persistence(_base_features(spark, sf))


def persistence_metrics(spark, sf):
    return rounded(forecast.regression_metrics(_persistence(spark, sf)))


def metrics_report(spark, sf):
    return forecast.metrics_text(forecast.regression_metrics(_persistence(spark, sf)))


# --- fairness ---------------------------------------------------------------


def arrest_rate_by_district(spark, sf):
    return rounded(fairness.rate_by_group(order_incidents(spark, sf), "district", "arrest"))


def violent_rate_by_district(spark, sf):
    return rounded(fairness.rate_by_group(order_incidents(spark, sf), "district", "violent"))


def arrest_rate_top5(spark, sf):
    rates = fairness.rate_by_group(order_incidents(spark, sf), "district", "arrest")
    return rounded(top_k(rates, "arrest_pct", 5, ties=["district"]))


def violent_rate_top5(spark, sf):
    rates = fairness.rate_by_group(order_incidents(spark, sf), "district", "violent")
    return rounded(top_k(rates, "violent_pct", 5, ties=["district"]))


def fairness_by_band(spark, sf):
    return rounded(fairness.fairness_by_group(_persistence(spark, sf), "band"))


def fairness_by_year(spark, sf):
    return rounded(fairness.fairness_by_group(_persistence(spark, sf), ["band", "year"]))


def fairness_by_domestic(spark, sf):
    cuts = ((0.0, "none"), (0.5, "some"))
    scored = _persistence(spark, sf).withColumn(
        "domestic_band", band("domestic_rate", cuts, "most")
    )
    return rounded(fairness.fairness_by_group(scored, "domestic_band"))


def disparity(spark, sf):
    by_band = fairness.fairness_by_group(_persistence(spark, sf), "band")
    return rounded(fairness.disparity(by_band))


def error_quartiles(spark, sf):
    return rounded(fairness.error_quartiles(_persistence(spark, sf), "band"))


def actual_vs_predicted(spark, sf):
    return fairness.actual_vs_predicted(_persistence(spark, sf), "band")


def group_weights(spark, sf):
    return rounded(fairness.group_weights(_base_features(spark, sf), "band"))


def calibrated_errors(spark, sf):
    split = panel.split_by_date(materialise(_persistence(spark, sf)))
    scored = fairness.calibrate_by_group(
        panel.train_part(split), panel.test_part(split), "band"
    )
    return rounded(fairness.fairness_by_group(scored, "band", prediction="calibrated"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        arrests_by_month,
        arrests_by_hour,
        arrests_by_dow,
        arrests_by_year_month,
        arrest_rate_by_month,
        counts_by_district,
        top_categories,
        monthly_violent,
        hourly_violent,
        dow_violent,
        yearly_violent,
        hourly_violent_pct,
        hourly_violent_pct_mean,
        overall_summary,
        peak_buckets,
        violent_pct_extremes,
        top_category_share,
        yearly_change,
        summary_report,
        summary_report_events,
        hotspots_top10,
        unit_year_counts,
        unit_year_matrix,
        pair_correlation,
        pair_correlation_full,
        strong_pairs,
        hierarchy_counts,
        era_counts,
        era_means,
        era_counts_many,
        paired_t,
        paired_t_by_category,
        tsv_roundtrip,
        csv_roundtrip,
        csv_mixed_headers,
        malformed_rows,
        parquet_roundtrip,
        text_roundtrip,
        clean_text_fields,
        violent_flags,
        clean_dirty_fields,
        arrests_by_month_undated,
        monthly_violent_dirty,
        counts_by_district_dirty,
        hotspots_dirty,
        panel_dirty,
        fairness_unknown_band,
        weekly_panel,
        weekly_panel_calendar,
        weekly_panel_district,
        panel_lags,
        panel_rolling,
        panel_label,
        panel_flags_trend,
        panel_shares,
        panel_dense,
        panel_dense_calendar,
        panel_split_calendar,
        panel_split,
        panel_split_by_date,
        features_full,
        features_full_calendar,
        features_full_dense,
        features_base,
        category_index,
        feature_slots,
        gbt_forecast,
        gbt_table_parity,
        gbt_fairness,
        oof_calibration,
        persistence_metrics,
        metrics_report,
        arrest_rate_by_district,
        violent_rate_by_district,
        arrest_rate_top5,
        violent_rate_top5,
        fairness_by_band,
        fairness_by_year,
        fairness_by_domestic,
        disparity,
        error_quartiles,
        actual_vs_predicted,
        group_weights,
        calibrated_errors,
    )
}
