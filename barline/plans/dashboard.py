"""Dashboard queries over predictions, prices and the run log.

Results that a dashboard shows in order are sorted by day and ticker: the
second key lets the range partitioning split a day that many tickers share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from barline.functions.rounding import round_half_away, round_half_up
from barline.operators.series import BLOCK_DAYS, own_rows, segment

# Jobs the reliability chart lists, chart limits.
DASHBOARD_JOBS = [
    "market_momentum_extraction", "lstm_daily_prediction", "lstm_weekly_training",
    "backfill_historical_data", "backfill_predictions", "missed_predictions",
]
HISTOGRAM_BINS = 25
TABLE_ROWS = 100

_ERROR = "predicted_close - actual_close"


def predicted_vs_actual(predictions: DataFrame) -> DataFrame:
    error = F.expr(_ERROR)
    return predictions.select(
        F.col("predicted_date").alias("ds"), "ticker", "predicted_close", "actual_close",
        error.alias("error"), F.abs(error).alias("abs_error"),
    ).orderBy("ds", "ticker")


def directional_accuracy(
    predictions: DataFrame,
    rows: int = 7,
    *,
    block_days: int = BLOCK_DAYS,
) -> DataFrame:
    """Share of right directions over the last ``rows`` predictions.

    A hit needs prediction and actual on the same side of the previous actual
    (equal counts as up); unknown ones are left out of the mean, and frames at
    the start of a series are partial.
    """
    cut = segment(
        predictions.select("ticker", F.col("predicted_date").alias("ds"), "predicted_close", "actual_close"),
        rows + 1, order="ds", block_days=block_days,
    )
    df = cut.df.withColumn("_previous", F.lag("actual_close").over(cut.ordered))
    previous, actual = F.col("_previous"), F.col("actual_close")
    same_side = (F.col("predicted_close") >= previous) == (actual >= previous)
    hit = F.when(
        actual.isNotNull() & previous.isNotNull(), F.coalesce(same_side, F.lit(False)).cast("double")
    )
    df = df.withColumn("_hit", hit)
    df = df.withColumn("rolling_7d_directional_accuracy", F.avg("_hit").over(cut.last_rows(rows)))
    return own_rows(df).select("ds", "ticker", "rolling_7d_directional_accuracy").orderBy("ds", "ticker")


def run_state_counts(run_log: DataFrame, jobs: list[str] = DASHBOARD_JOBS) -> DataFrame:
    return (
        run_log.filter(F.col("dag_id").isin(jobs))
        .groupBy("dag_id", "state")
        .agg(F.count(F.lit(1)).alias("run_count"))
        .orderBy("dag_id", "state")
    )


def latest_price_date(prices: DataFrame) -> DataFrame:
    return (
        prices.groupBy("ticker")
        .agg(F.max("date").alias("last_updated"))
        .select("ticker", F.col("ticker").alias("stock_ticker"), "last_updated")
        .orderBy("ticker")
    )


def prediction_residuals(predictions: DataFrame) -> DataFrame:
    return (
        predictions.filter("actual_close IS NOT NULL")
        .select(
            F.col("predicted_date").alias("ds"), "ticker", "model_version",
            F.expr(_ERROR).alias("residual_error"),
        )
        .orderBy("ds", "ticker")
    )


def error_distribution(predictions: DataFrame) -> DataFrame:
    """Prediction errors rounded to whole units."""
    return predictions.filter("actual_close IS NOT NULL").select(
        "ticker", round_half_away(F.expr(_ERROR), 0).alias("prediction_error")
    )


def latest_close(prices: DataFrame) -> DataFrame:
    """Close on each ticker's last date: one pass instead of a self-join."""
    return prices.groupBy("ticker").agg(
        F.max("date").alias("ds"), F.max_by("close", "date").alias("close")
    )


def latest_prediction(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("ticker").agg(
        F.max("predicted_date").alias("ds"),
        F.max_by("predicted_close", "predicted_date").alias("predicted_close"),
    )


def card(df: DataFrame, column: str, label: str) -> DataFrame:
    """Single-value card: the maximum of a column."""
    return df.agg(F.max(column).alias(label))


def leaderboard(predictions: DataFrame) -> DataFrame:
    """MAE and RMSE (4 digits) by ticker and model version."""
    error = F.expr(_ERROR)
    return (
        predictions.filter("actual_close IS NOT NULL")
        .groupBy("ticker", "model_version")
        .agg(
            round_half_up(F.avg(F.abs(error)), 4).alias("mae"),
            round_half_up(F.sqrt(F.avg(error * error)), 4).alias("rmse"),
            F.min("predicted_date").alias("creation_date"),
        )
        .orderBy(F.col("creation_date").desc(), "ticker", "model_version")
    )


def leaderboard_top(predictions: DataFrame, rows: int = TABLE_ROWS) -> DataFrame:
    """The leaderboard table's first rows, on a total order."""
    return leaderboard(predictions).limit(rows)


def daily_max(predictions: DataFrame) -> DataFrame:
    """Line chart: largest prediction and actual per day."""
    return predictions.groupBy(F.to_date("predicted_date").alias("ds")).agg(
        F.max("predicted_close").alias("predicted"), F.max("actual_close").alias("actual")
    )


def daily_hit_rate(accuracy: DataFrame) -> DataFrame:
    """Area chart: largest rolling accuracy per day."""
    return accuracy.groupBy("ds").agg(F.max("rolling_7d_directional_accuracy").alias("hit_rate"))


def daily_residual(predictions: DataFrame) -> DataFrame:
    """Bar chart: mean residual per day."""
    return (
        predictions.filter("actual_close IS NOT NULL")
        .groupBy(F.to_date("predicted_date").alias("ds"))
        .agg(F.avg(F.expr(_ERROR)).alias("residual_error"))
    )


def state_pivot(run_log: DataFrame, states: list[str], jobs: list[str] = DASHBOARD_JOBS) -> DataFrame:
    """Stacked bars: runs per job, one column per state.

    The states are given, so no extra job looks for them.
    """
    counts = run_log.filter(F.col("dag_id").isin(jobs)).groupBy("dag_id", "state").count()
    return counts.groupBy("dag_id").pivot("state", states).agg(F.sum("count"))


def error_histogram(predictions: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width histogram of the rounded errors; the maximum falls in the last bin.

    The bounds are a scalar subquery, so rows meet two numbers and no join.
    """
    errors = error_distribution(predictions).select("prediction_error")
    bounds = errors.agg(
        F.struct(F.min("prediction_error").alias("lo"), F.max("prediction_error").alias("hi"))
    ).scalar()
    lo, hi = bounds["lo"], bounds["hi"]
    width = (hi - lo) / F.lit(float(bins))
    position = F.floor(F.try_divide(F.col("prediction_error") - lo, width))
    bin_no = F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1)).cast("int")
    return (
        errors.select(bin_no.alias("bin"), lo.alias("lo"), width.alias("width"))
        .groupBy("bin", "lo", "width")
        .agg(F.count(F.lit(1)).alias("frequency"))
        .select(
            "bin", (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_start"), "frequency"
        )
    )
