"""Repair of stored predictions: fill missing forecasts and missing actuals."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from barline.functions.calendar import business_day_sequence, next_trading_day
from barline.operators.forecast import linear_prediction
from barline.operators.merge import fill_from
from barline.operators.sequences import SEQUENCE_ROWS
from barline.operators.series import BLOCK_DAYS, own_rows, segment

# Fixed value: rows that count as the recent window.
RECENT_ROWS = 14


def prediction_gaps(
    features: DataFrame,
    stored: DataFrame,
    prices: DataFrame,
    recent_rows: int = RECENT_ROWS,
    *,
    series: DataFrame | None = None,
    block_days: int = BLOCK_DAYS,
) -> DataFrame:
    """Windows whose prediction or actual is missing.

    A window ends at each feature row from the 30th on and predicts the next
    weekday. ``action`` is ``recent`` or ``gap`` for a missing prediction (the
    ticker's last rows, or older), ``actual`` for a stored prediction without
    an actual, whether or not the actual is known by now. Of windows that predict
    the same date (Friday's, Saturday's and Sunday's) the latest counts. Joins are
    on (ticker, date) pairs, so no single key is large.

    ``features`` may be the last rows of each ticker only, where ``series`` (ticker,
    ``feature_rows``) says how many there are in all.
    """
    cut = segment(features.select("ticker", "date", "close"), 1, block_days=block_days)
    windows = own_rows(cut.df.withColumns({"_position": cut.position(), "_length": cut.length()}))
    if series is not None:
        ahead = F.col("feature_rows") - F.col("_length")
        windows = windows.join(series.select("ticker", "feature_rows"), "ticker")
        windows = windows.withColumns({"_position": F.col("_position") + ahead, "_length": F.col("feature_rows")})
    windows = windows.filter(F.col("_position") >= SEQUENCE_ROWS)
    windows = windows.select(
        "ticker",
        F.col("date").alias("based_on_date"),
        "close",
        next_trading_day(F.col("date")).alias("predicted_date"),
        (F.col("_position") > F.col("_length") - recent_rows).alias("_recent"),
    )
    windows = latest_windows(windows)
    known = stored.select(
        "ticker", "predicted_date",
        F.col("predicted_close").alias("stored_prediction"),
        F.col("actual_close").alias("stored_actual"),
        F.lit(True).alias("_stored"),
    )
    actuals = prices.select(
        "ticker", F.to_date("date").alias("predicted_date"), F.col("close").alias("actual_close")
    )
    joined = windows.join(known, ["ticker", "predicted_date"], "left")
    no_prediction = F.col("stored_prediction").isNull()
    no_actual = F.col("_stored").isNotNull() & F.col("stored_actual").isNull()
    open_ = joined.filter(no_prediction | no_actual)
    action = F.when(no_prediction, F.when(F.col("_recent"), "recent").otherwise("gap")).otherwise("actual")
    return open_.join(actuals, ["ticker", "predicted_date"], "left").select(
        "ticker", "predicted_date", "based_on_date", "close", "stored_prediction", "actual_close",
        action.alias("action"),
    )


def latest_windows(windows: DataFrame) -> DataFrame:
    """One window per ticker and predicted date: that of the latest ``based_on_date`` (K10)."""
    keys = ["ticker", "predicted_date"]
    others = [c for c in windows.columns if c not in [*keys, "based_on_date"]]
    latest = [F.max_by(c, "based_on_date").alias(c) for c in others]
    settled = windows.groupBy(*keys).agg(F.max("based_on_date").alias("based_on_date"), *latest)
    return settled.select(*windows.columns)


def missing_predictions(windows: DataFrame, stored: DataFrame) -> DataFrame:
    """Windows without a usable stored prediction, the latest of each predicted date."""
    windows = latest_windows(windows)
    usable = stored.filter("predicted_close IS NOT NULL").select("ticker", "predicted_date")
    return windows.join(usable, ["ticker", "predicted_date"], "left_anti")


def prediction_records(gaps: DataFrame, scaler: DataFrame, model: DataFrame) -> DataFrame:
    """Rows to merge: only missing predictions are computed, stored ones are kept.

    Tickers without a model drop out.
    """
    bounds = scaler.select("ticker", "lo_close", "hi_close")
    joined = gaps.join(model, "ticker").join(bounds, "ticker")
    predicted = F.when(F.col("action") == "actual", F.col("stored_prediction")).otherwise(
        linear_prediction(F.col("close"))
    )
    return joined.select(
        "ticker", "predicted_date", predicted.alias("predicted_close"), "actual_close",
        "model_version", "action",
    )


def maintenance_metrics(records: DataFrame) -> DataFrame:
    """Counts and errors of the touched rows; errors are NULL without an actual.

    Errors are told to nine digits: what is beyond depends on the order in which rows are added up.
    """
    error = F.col("predicted_close") - F.col("actual_close")
    return records.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("action") == "recent").alias("recent_rows"),
        F.count_if(F.col("action") == "gap").alias("gap_rows"),
        F.count_if(F.col("action") == "actual").alias("actual_updates"),
        F.count("actual_close").alias("comparable"),
        F.round(F.avg(F.abs(error)), 9).alias("mae_price"),
        F.round(F.sqrt(F.avg(error * error)), 9).alias("rmse_price"),
    )


def maintenance_report(features: DataFrame, model: DataFrame, records: DataFrame) -> DataFrame:
    """A row for every ticker with features: its metrics, and why it was skipped if it was.

    ``status`` is ``too_few_rows`` for less than one window of rows, ``no_model``, or
    ``done``; counts are 0 where nothing was due.
    """
    counted = features.groupBy("ticker").agg(F.count(F.lit(1)).alias("feature_rows"))
    return report_from(counted, model, records)


def report_from(series: DataFrame, model: DataFrame, records: DataFrame) -> DataFrame:
    """The same from ``series``: ticker and ``feature_rows``."""
    metrics = maintenance_metrics(records)
    counts = [c for c, kind in metrics.dtypes if kind == "bigint"]
    trained = model.select("ticker", "model_version")
    status = (
        F.when(F.col("feature_rows") < SEQUENCE_ROWS, "too_few_rows")
        .when(F.col("model_version").isNull(), "no_model")
        .otherwise("done")
    )
    return (
        series.join(trained, "ticker", "left")
        .join(metrics, "ticker", "left")
        .na.fill(0, counts)
        .withColumn("status", status)
    )


def open_days(series: DataFrame) -> DataFrame:
    """``ticker``, ``date``: a day of every month in which a ticker may have open windows or their predicted days."""
    begin = F.coalesce("settled_until", F.col("state.first_date"))
    end = F.date_add("feature_last", 3)
    days = F.concat(F.sequence(F.least(begin, end), end, F.expr("interval 1 month")), F.array(end))
    return series.filter("feature_last IS NOT NULL").select("ticker", F.explode(days).alias("date"))


def settled(series: DataFrame, gaps: DataFrame, model: DataFrame) -> DataFrame:
    """``series`` with ``settled_until`` moved up to the day before each ticker's first window that stays open.

    A window stays open where its actual is not known yet, or there is no model to predict by.
    """
    trained = model.select("ticker", F.lit(True).alias("_trained"))
    still = gaps.join(trained, "ticker", "left").filter("_trained IS NULL OR actual_close IS NULL")
    first = still.groupBy("ticker").agg(F.min("based_on_date").alias("_first"))
    until = F.coalesce(F.date_sub("_first", 1), "feature_last")
    return series.join(first, "ticker", "left").withColumn("settled_until", until).drop("_first")


def fill_latest_actuals(stored: DataFrame, features: DataFrame, prices: DataFrame) -> DataFrame:
    """Fill ``actual_close`` where NULL, on each ticker's latest feature date only."""
    latest = features.groupBy("ticker").agg(F.max("date").alias("predicted_date"))
    keys = ["ticker", "predicted_date"]
    actual = prices.select("ticker", F.to_date("date").alias("predicted_date"), "close")
    return fill_from(stored, actual.join(latest, keys, "left_semi"), keys, "actual_close", "close")


def missing_business_days(marks: DataFrame, rows: DataFrame, date: str = "trade_date") -> DataFrame:
    """Weekdays after each ticker's ``last_date``, up to ``latest``, with no row.

    The expected days are exploded from one row per ticker and range, so they
    are spread by (ticker, day) before the anti join.
    """
    expected = marks.select(
        "ticker",
        F.explode(business_day_sequence(F.date_add("last_date", 1), F.col("latest"))).alias("missing_date"),
    )
    have = rows.select("ticker", F.col(date).alias("missing_date"))
    return expected.join(have, ["ticker", "missing_date"], "left_anti")
