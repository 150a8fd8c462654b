"""Scaling, sequences, splits, forecasters, maintenance."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from barline.operators import forecast, sequences
from barline.operators.indicators import stock_features
from barline.operators.series import segment
from barline.plans import dashboard, maintenance
from barline.schemas import FEATURE_COLUMNS
from tests.test_indicators import frame, series, walk


@pytest.fixture(scope="module")
def features(spark):
    df = frame(spark, series("A", walk(400, 1)), series("B", walk(140, 2)), series("C", walk(85, 3)))
    return stock_features(df).persist()


def matrix(features, ticker):
    pdf = features.filter(F.col("ticker") == ticker).toPandas().sort_values("date")
    x = pdf[FEATURE_COLUMNS].to_numpy(float)
    lo, hi = x.min(0), x.max(0)
    span = np.where(hi - lo == 0, 1, hi - lo)
    return pdf, (x - lo) / span, lo, span


def test_scale_and_back(spark, features):
    scaler = sequences.fit_scaler(features)
    scaled = sequences.minmax_scale(features, scaler)
    _, want, _, _ = matrix(features, "B")
    got = scaled.filter("ticker = 'B'").toPandas().sort_values("date")[FEATURE_COLUMNS].to_numpy(float)
    np.testing.assert_allclose(got, want, atol=1e-12)
    back = scaled.join(scaler, "ticker").select(
        "ticker", "date", sequences.unscaled(F.col("close"), F.col("lo_close"), F.col("hi_close")).alias("p")
    ).join(features, ["ticker", "date"])
    assert back.filter("abs(p - close) > 1e-9").count() == 0
    assert sequences.scaler_table(scaler).count() == 3 * 17


def test_scaled_by_bounds_of_the_blocks(spark, features):
    """Without a scaler nothing joins the features but their own blocks: no row of a scaler, no second shuffle of features."""
    rows = frame(spark, series("A", walk(60, 4), step=20)).withColumn("low", F.when(F.col("volume") % 2 == 0, F.col("close")))
    undated = rows.filter("date < '1990-02-01'").withColumn("date", F.lit(None).cast("date"))
    rows = rows.unionByName(rows.filter("date < '1990-03-01'")).unionByName(undated)
    columns = ["close", "low"]
    by_join = sequences.minmax_scale(rows, sequences.fit_scaler(rows, columns), columns)
    in_blocks = sequences.minmax_scale(rows, columns=columns)
    assert in_blocks.columns == by_join.columns and in_blocks.count() == by_join.count() == rows.count()
    assert in_blocks.exceptAll(by_join).isEmpty()
    plan = sequences.minmax_scale(features)._jdf.queryExecution().optimizedPlan().toString()
    assert "lo_close" not in plan


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([("A", 1, 5.0), ("A", 2, 5.0)], "ticker string, date int, close double")
    assert {r["close"] for r in sequences.minmax_scale(df, columns=["close"]).collect()} == {0.0}


@pytest.mark.parametrize("block_days", [2048, 60])
def test_windows(spark, features, block_days):
    scaled = sequences.minmax_scale(features)
    _, want, _, _ = matrix(features, "A")
    train = sequences.training_sequences(scaled, block_days=block_days).filter("ticker = 'A'").toPandas().sort_values("date")
    assert len(train) == len(want) - 30
    x = np.array([np.stack(w) for w in train["x"]])
    np.testing.assert_allclose(x, np.stack([want[i - 30 : i] for i in range(30, len(want))]), atol=1e-12)
    np.testing.assert_allclose(train["y"], want[30:, 0], atol=1e-12)
    last = sequences.prediction_windows(scaled, block_days=block_days).filter("ticker = 'A'").toPandas().sort_values("date")
    x = np.array([np.stack(w) for w in last["x"]])
    np.testing.assert_allclose(x, np.stack([want[i - 29 : i + 1] for i in range(29, len(want))]), atol=1e-12)


@pytest.mark.parametrize("block_days", [2048, 60])
def test_scaled_on_the_way(spark, features, block_days):
    """Windows of unscaled features are those of the scaled ones, and no join or shuffle is added for it."""
    scaled = sequences.minmax_scale(features)
    for windows in (sequences.training_sequences, sequences.prediction_windows):
        want = windows(scaled, block_days=block_days)
        made = windows(features, scale=True, block_days=block_days)
        assert made.count() == want.count() > 0
        assert made.exceptAll(want).isEmpty()
    joins = [df._jdf.queryExecution().analyzed().toString().count("Join Inner") for df in (segment(features, 5).df, made, want)]
    assert joins[0] == joins[1] < joins[2]


@pytest.mark.parametrize("block_days", [2048, 60])
def test_window_sums(spark, features, block_days):
    """What the whole windows give, each value weighted by step times column."""
    for windows, sums in (
        (sequences.training_sequences, sequences.training_window_sums),
        (sequences.prediction_windows, sequences.prediction_window_sums),
    ):
        whole = windows(features, scale=True, block_days=block_days).toPandas().sort_values(["ticker", "date"])
        x = np.array([np.stack(w) for w in whole["x"]])
        got = sums(features, scale=True, block_days=block_days).toPandas().sort_values(["ticker", "date"])
        assert list(got["date"]) == list(whole["date"]) and set(got["steps"]) == {30}
        np.testing.assert_allclose(got["total"], np.einsum("nkc,k,c->n", x, np.arange(1, 31), np.arange(1, 18)), atol=1e-8)


def test_window_sum_of_an_unknown_value(spark):
    rows = [("A", dt.date(2000, 1, i), None if i == 2 else 1.0) for i in range(1, 6)]
    df = spark.createDataFrame(rows, "ticker string, date date, close double")
    got = {r["date"].day: r["total"] for r in sequences.prediction_window_sums(df, 2, ["close"]).collect()}
    assert got == {2: None, 3: None, 4: 3.0, 5: 3.0}


@pytest.mark.parametrize("block_days", [2048, 60])
def test_chronological_split(features, block_days):
    split = sequences.chronological_split(features.select("ticker", "date"), block_days=block_days)
    rows = {r["ticker"]: r for r in split.groupBy("ticker").agg(
        F.count("*").alias("n"), F.count_if("is_train").alias("train"), F.max("sequence_no").alias("last"),
        F.max(F.when(F.col("is_train"), F.col("date"))).alias("train_end"),
        F.min(F.when(~F.col("is_train"), F.col("date"))).alias("test_start"),
    ).collect()}
    for ticker, n in (("A", 351 - 30), ("B", 91 - 30), ("C", 36 - 30)):
        assert rows[ticker]["n"] == rows[ticker]["last"] == n
        assert rows[ticker]["train"] == int(n * (1 - 0.15))
        assert rows[ticker]["train_end"] < rows[ticker]["test_start"]


def test_linear_and_metrics(features):
    scaler = sequences.fit_scaler(features, ["close"])
    pairs = forecast.training_pairs(features.select("ticker", "date", "close"), scaler)
    model = {r["ticker"]: r for r in forecast.fit_linear(pairs).collect()}
    assert set(model) == {"A", "B"}  # C has 36 rows, 40 are needed
    pdf, scaled, lo, span = matrix(features, "B")
    x, y = scaled[29:-1, 0], scaled[30:, 0]
    n = int(len(x) * 0.85)
    slope, intercept = np.polyfit(x[:n], y[:n], 1)
    assert model["B"]["slope"] == pytest.approx(slope) and model["B"]["intercept"] == pytest.approx(intercept)
    metrics = {r["ticker"]: r for r in forecast.holdout_metrics(pairs, forecast.fit_linear(pairs)).collect()}
    error = (slope * x[n:] + intercept - y[n:]) * span[0]
    assert metrics["B"]["mae"] == pytest.approx(np.abs(error).mean())
    assert metrics["B"]["rmse"] == pytest.approx(np.sqrt((error**2).mean()))
    assert metrics["B"]["holdout_rows"] == len(x) - n
    predicted = {r["ticker"]: r for r in forecast.predict_next_day(features, scaler, forecast.fit_linear(pairs)).collect()}
    assert set(predicted) == {"A", "B"}
    want = (slope * scaled[-1, 0] + intercept) * span[0] + lo[0]
    assert predicted["B"]["predicted_close"] == pytest.approx(want)
    assert predicted["B"]["predicted_date"].weekday() < 5


def test_ridge_equals_the_normal_equations(features):
    model = {r["ticker"]: r for r in forecast.fit_ridge(features, penalty=0.01).collect()}
    _, scaled, _, _ = matrix(features, "A")
    n = int((len(scaled) - 30) * 0.85)
    x = np.c_[scaled[29:-1][:n], np.ones(n)]
    y = scaled[30:, 0][:n]
    penalty = 0.01 * np.eye(18)
    penalty[-1, -1] = 0
    want = np.linalg.solve(x.T @ x + penalty, x.T @ y)
    np.testing.assert_allclose(model["A"]["weights"], want, rtol=1e-6, atol=1e-8)
    assert model["A"]["train_rows"] == n


@pytest.mark.parametrize("block_days", [8192, 60, 7])
def test_window_ridge_takes_all_rows_of_the_window(features, block_days):
    """The normal equations of the flattened windows, also where windows and the split lie across blocks."""
    model = {r["ticker"]: r for r in forecast.fit_window_ridge(features, penalty=0.01, block_days=block_days).collect()}
    assert set(model) == {"A", "B"}  # C has 36 rows, 40 are needed
    for ticker in model:
        _, scaled, _, _ = matrix(features, ticker)
        n = int((len(scaled) - 30) * 0.85)
        x = np.array([np.append(scaled[j : j + 30].ravel(), 1.0) for j in range(n)])
        y = scaled[30:, 0][:n]
        penalty = 0.01 * np.eye(511)
        penalty[-1, -1] = 0
        np.testing.assert_allclose(model[ticker]["weights"], np.linalg.solve(x.T @ x + penalty, x.T @ y), rtol=1e-6, atol=1e-6)
        assert model[ticker]["train_rows"] == n


def test_ridge_query_tells_every_weight_of_the_window(spark, sf):
    from barline.catalog import forecasts

    assert forecasts.fit_ridge_forecaster(spark, sf).columns == ["ticker", "train_rows", *(f"w{i}" for i in range(30 * 17 + 1))]


def test_ridge_of_an_older_shorter_feature_list_predicts(features):
    columns = FEATURE_COLUMNS[:5]
    model = forecast.fit_ridge(features, columns=columns)
    scaler = sequences.fit_scaler(features)
    got = {r["ticker"]: r for r in forecast.predict_ridge(features, scaler, model, 5).collect()}
    pdf, scaled, lo, span = matrix(features, "B")
    weights = model.filter("ticker = 'B'").first()["weights"]
    want = (scaled[-1, :5] @ weights[:5] + weights[5]) * span[0] + lo[0]
    assert got["B"]["predicted_close"] == pytest.approx(want)
    assert got["B"]["based_on_date"] == pdf["date"].iloc[-1]


def test_latest_rows_limit_before_the_shuffle(features):
    latest = sequences.latest_rows(features.select("ticker", "date"), 30)
    assert {r["count"] for r in latest.groupBy("ticker").count().collect()} == {30}
    assert "WindowGroupLimit" in latest._jdf.queryExecution().executedPlan().toString()
    assert {r["ticker"] for r in sequences.short_keys(features, 40).collect()} == {"C"}


@pytest.mark.parametrize("block_days", [2048, 60])
def test_maintenance(spark, features, block_days):
    weekday = features.filter("weekday(date) < 5 AND ticker <> 'C'")
    all_days = sorted(r[0] for r in weekday.filter("ticker = 'B'").select("date").collect())

    def following(d):
        step = 1 if d.weekday() < 4 else 7 - d.weekday()
        return d + dt.timedelta(days=step)

    ends = all_days[29:]
    done, no_actual, no_prediction = following(ends[0]), following(ends[1]), following(ends[2])
    stored = spark.createDataFrame(
        [("B", done, 1.0, 2.0, "v"), ("B", no_actual, 1.0, None, "v"), ("B", no_prediction, None, None, "v")],
        "ticker string, predicted_date date, predicted_close double, actual_close double, model_version string",
    )
    gaps = maintenance.prediction_gaps(weekday, stored, weekday, block_days=block_days).filter("ticker = 'B'")
    by = {r["predicted_date"]: r for r in gaps.collect()}
    assert len(by) == len(ends) - 1 and done not in by
    assert by[no_actual]["action"] == "actual" and by[no_prediction]["action"] == "gap"
    recent = [d for d, r in by.items() if r["action"] == "recent"]
    assert sorted(recent) == sorted(following(d) for d in all_days[-14:])
    assert by[following(all_days[-1])]["actual_close"] is None
    scaler = sequences.fit_scaler(weekday, ["close"])
    model = spark.createDataFrame([("B", 0.0, 0.5, "m")], "ticker string, slope double, intercept double, model_version string")
    records = maintenance.prediction_records(gaps, scaler, model)
    assert records.filter(F.col("predicted_date") == F.lit(no_actual)).first()["predicted_close"] == 1.0
    m = maintenance.maintenance_metrics(records).first()
    assert (m["records"], m["recent_rows"], m["actual_updates"]) == (len(ends) - 1, 14, 1)
    assert m["comparable"] == len(ends) - 2
    none = maintenance.maintenance_metrics(records.filter("actual_close IS NULL")).first()
    assert none["mae_price"] is None and none["rmse_price"] is None


@pytest.mark.parametrize("block_days", [2048, 5])
def test_directional_accuracy(spark, block_days):
    rows = [
        ("A", dt.date(2024, 1, 1) + dt.timedelta(days=20 * i), p, a)
        for i, (p, a) in enumerate([(1, 10), (11, 12), (13, 11), (9, None), (1, 10), (None, 11), (12, 12), (5, 6), (7, 7)])
    ]
    df = spark.createDataFrame(
        [(t, d, None if p is None else float(p), None if a is None else float(a)) for t, d, p, a in rows],
        "ticker string, predicted_date date, predicted_close double, actual_close double",
    )
    got = [r[2] for r in dashboard.directional_accuracy(df, block_days=block_days).collect()]
    hits = [None, 1, 0, None, None, 0, 1, 1, 1]
    want = []
    for i in range(len(hits)):
        known = [h for h in hits[max(0, i - 6) : i + 1] if h is not None]
        want.append(sum(known) / len(known) if known else None)
    assert got == [None if w is None else pytest.approx(w) for w in want]


def test_histogram_counts_every_error(spark):
    df = spark.createDataFrame(
        [("A", float(x), 0.0) for x in (-10, -10, 0, 3, 15)] + [("A", 1.0, None)],
        "ticker string, predicted_close double, actual_close double",
    )
    rows = {r["bin"]: (r["bin_start"], r["frequency"]) for r in dashboard.error_histogram(df).collect()}
    assert rows == {0: (-10.0, 2), 10: (0.0, 1), 13: (3.0, 1), 24: (14.0, 1)}
    same = df.filter("predicted_close = -10")
    assert [(r["bin"], r["frequency"]) for r in dashboard.error_histogram(same).collect()] == [(0, 2)]


def test_windows_that_share_a_predicted_date_are_settled_by_the_latest(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(42)]  # ends on a Sunday
    features = spark.createDataFrame([("A", d, float(i)) for i, d in enumerate(days)], "ticker string, date date, close double")
    stored = spark.createDataFrame([], "ticker string, predicted_date date, predicted_close double, actual_close double")
    gaps = {r.predicted_date: r for r in maintenance.prediction_gaps(features, stored, features).collect()}
    assert maintenance.prediction_gaps(features, stored, features).count() == len(gaps) == 9
    monday = gaps[dt.date(2024, 2, 12)]
    assert (monday.based_on_date, monday.close, monday.action) == (days[-1], 41.0, "recent")
    windows = spark.createDataFrame([("A", d, dt.date(2024, 2, 12)) for d in days[-3:]], "ticker string, based_on_date date, predicted_date date")
    assert [r.based_on_date for r in maintenance.missing_predictions(windows, stored).collect()] == [days[-1]]


def test_line_queries_store_only_what_they_read(spark, sf, monkeypatch):
    from barline.catalog import features as catalog_features, forecasts

    kept, staged = [], catalog_features.stage
    monkeypatch.setattr(catalog_features, "stage", lambda df, name: kept.append(df.columns) or staged(df, name))
    forecasts.prediction_records(spark, sf), forecasts.maintenance_report(spark, sf), forecasts.holdout_metrics(spark, sf)
    assert kept == [["ticker", "date", "close"]] * 3
