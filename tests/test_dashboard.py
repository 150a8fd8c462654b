"""What the dashboard shows comes in its order, over several files and tasks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barline.plans import dashboard


@pytest.fixture(scope="module")
def predictions(spark):
    """Rows of forty tickers in no order, in sixteen parts."""
    rows = []
    for n in range(1200):
        close = 50.0 + n * 7 % 31
        actual = None if n % 11 == 0 else close + n % 5 - 2
        day = dt.date(2024, 1, 1) + dt.timedelta(days=n * 13 % 30)
        rows.append((f"T{n % 40:02}", day, close, actual, f"v{n % 3}"))
    schema = "ticker string, predicted_date date, predicted_close double, actual_close double, model_version string"
    return spark.createDataFrame(rows, schema).repartition(16)


def falling(day):
    return -day.toordinal()


@pytest.mark.parametrize(
    ("view", "order"),
    [
        (dashboard.predicted_vs_actual, lambda r: (r.ds, r.ticker)),
        (dashboard.directional_accuracy, lambda r: (r.ds, r.ticker)),
        (dashboard.prediction_residuals, lambda r: (r.ds, r.ticker)),
        (dashboard.leaderboard, lambda r: (falling(r.creation_date), r.ticker, r.model_version)),
        (dashboard.leaderboard_top, lambda r: (falling(r.creation_date), r.ticker, r.model_version)),
    ],
)
def test_rows_are_in_order(predictions, view, order):
    one_a_day = predictions.dropDuplicates(["ticker", "predicted_date"])
    keys = [order(r) for r in view(one_a_day).collect()]
    assert len(keys) > 30 and keys == sorted(keys)


def test_counts_and_dates_are_in_order(spark, predictions):
    jobs = dashboard.DASHBOARD_JOBS
    runs = spark.range(4000).select(
        F.element_at(F.array(*[F.lit(j) for j in jobs]), (F.col("id") * 7 % len(jobs) + 1).cast("int")).alias("dag_id"),
        F.when(F.col("id") % 7 < 3, "failed").otherwise("success").alias("state"),
    )
    keys = [(r.dag_id, r.state) for r in dashboard.run_state_counts(runs).collect()]
    assert len(keys) == 2 * len(jobs) and keys == sorted(keys)
    prices = predictions.select("ticker", F.col("predicted_date").alias("date"))
    tickers = [r.ticker for r in dashboard.latest_price_date(prices).collect()]
    assert len(tickers) == 40 and tickers == sorted(tickers)
