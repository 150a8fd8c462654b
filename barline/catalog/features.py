"""Feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from barline.catalog.registry import query, rounded
from barline.catalog.views import rnd, sql
from barline.operators import quality
from barline.operators.indicators import indicators, min_history, stock_features
from barline.plans import features as upkeep
from barline.schemas import FEATURE_COLUMNS
from barline.sources import fixtures
from barline.sources.tables import stage

# Digits at which both engines agree: prices have two decimals, so means over
# 20 and 50 rows are exact at four; EMA noise stays below three.
DIGITS = {
    "close": 2, "daily_return": 6, "sma_20": 4, "sma_50": 4, "ema_12": 3, "ema_26": 3, "macd": 3,
    "macd_signal": 3, "rsi_14": 6, "bb_upper": 4, "bb_lower": 4, "volatility_14": 6,
    "volume_sma_20": 4, "bb_width": 6, "volume_ratio_20": 6, "return_3d": 6, "return_5d": 6,
}


def digits(columns: list[str]) -> dict[str, int]:
    return {c: DIGITS[c] for c in columns}


def rounded_columns(columns: list[str]) -> str:
    return ", ".join(f"{rnd(c, DIGITS[c])} AS {c}" for c in columns)


def all_features(spark, folder):
    """The feature table of all bars."""
    return stock_features(fixtures.bars(spark, folder))


def stored_features(spark, folder, *columns):
    """The feature table as a job finds it: written once, read by every consumer; only ``columns`` where given."""
    features = all_features(spark, folder)
    return stage(features.select(*columns) if columns else features, "features")


def _feature_query(name: str, columns: list[str]) -> None:
    @query(name, sql(f"SELECT ticker, date, {rounded_columns(columns)} FROM indicators", "indicators"))
    def run(spark, folder):
        bars = fixtures.bars(spark, folder)
        result = indicators(bars)
        return rounded(result.select("ticker", "date", *columns), digits(columns))


for _name, _columns in {
    "feat_daily_return": ["daily_return"],
    "feat_sma": ["sma_20", "sma_50"],
    "feat_ema": ["ema_12", "ema_26"],
    "feat_macd": ["macd", "macd_signal"],
    "feat_volatility": ["volatility_14"],
    "feat_volume": ["volume_sma_20", "volume_ratio_20"],
    "feat_bollinger": ["bb_upper", "bb_lower", "bb_width"],
    "feat_multi_return": ["return_3d", "return_5d"],
    "feat_rsi": ["rsi_14"],
}.items():
    _feature_query(_name, _columns)


@query(
    "stock_features",
    sql(f"SELECT ticker, date, {rounded_columns(FEATURE_COLUMNS)} FROM features", "features"),
)
def stock_feature_table(spark, folder):
    return rounded(all_features(spark, folder), DIGITS)


@query(
    "feat_long_series",
    sql(f"SELECT ticker, date, {rounded_columns(FEATURE_COLUMNS)} FROM features", "features"),
)
def feat_long_series(spark, folder):
    """The feature table with blocks of 64 days: dozens a ticker, each going on from the states of those before."""
    return rounded(stock_features(fixtures.bars(spark, folder), block_days=64), DIGITS)


@query(
    "series_marks",
    sql(
        """SELECT b.ticker, b.rows, b.null_rows, b.first_date, b.last_date, f.feature_rows, f.feature_last, f.feature_close
        FROM (SELECT ticker, count(*) AS rows, count(*) FILTER (close IS NULL OR volume IS NULL) AS null_rows,
                min(date) AS first_date, max(date) AS last_date FROM bars GROUP BY ticker) b
        LEFT JOIN (SELECT ticker, count(*) AS feature_rows, max(date) AS feature_last, arg_max(close, date) AS feature_close
                FROM features GROUP BY ticker) f USING (ticker)""",
        "features",
    ),
)
def series_marks(spark, folder):
    """What loads, gates and forecasts ask of the table that holds a row per ticker, kept up over two loads."""
    bars = fixtures.bars(spark, folder)
    cut = F.lit(fixtures.STORED_BEFORE).cast("date")
    first = upkeep.rebuilt(bars.filter(F.col("date") < cut))
    series = stage(first.series(first.features), "series")
    new = bars.filter(F.col("date") >= cut)
    update = upkeep.follow_on(new, series, upkeep.starts(series, upkeep.changed_since(new)))
    after = update.series(update.features)
    whole = after.unionByName(series.join(after, "ticker", "left_anti"))
    marks = [F.col(f"state.{c}").alias(n) for c, n in (("rows", "rows"), ("nulls", "null_rows"), ("first_date", "first_date"), ("last_date", "last_date"))]
    return whole.select("ticker", *marks, "feature_rows", "feature_last", "feature_close")


@query(
    "min_history_filter",
    sql(
        "SELECT ticker, date, close, volume FROM bars WHERE ticker IN"
        " (SELECT ticker FROM bars GROUP BY ticker HAVING count(*) >= 530)",
        "bars",
    ),
)
def min_history_filter(spark, folder):
    # Every test ticker has more than 26 bars; a higher limit shows the filter.
    bars = fixtures.bars(spark, folder).select("ticker", "date", "close", "volume")
    return min_history(bars, 530)


@query(
    "feature_null_cells",
    sql(
        "SELECT ticker, CAST(sum("
        + " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in FEATURE_COLUMNS)
        + ") AS BIGINT) AS null_cells FROM indicators GROUP BY ticker",
        "indicators",
    ),
)
def feature_null_cells(spark, folder):
    bars = fixtures.bars(spark, folder)
    table = indicators(bars)
    return quality.feature_summary(table).select("ticker", "null_cells")


def _checks(spark, folder, *names):
    """The named feature checks, on bars with volume gaps."""
    bars = gappy_bars(spark, folder)
    table = stock_features(bars)
    found = quality.feature_checks(bars, table)
    return found.filter(F.col("check_name").isin(*names))


def gappy_bars(spark, folder):
    """Bars with a volume missing now and then in every fifth ticker."""
    gap = (F.col("key") % 5 == 0) & (F.unix_date("date") % 97 == 0)
    worse = (F.col("key") % 20 == 0) & (F.unix_date("date") % 11 == 0)
    bars = fixtures.bars(spark, folder)
    return bars.withColumn("volume", F.when(~(gap | worse), F.col("volume")))


_GAPPY = {
    "gappy": """SELECT ticker, date, close, CASE WHEN (key % 5 = 0 AND date_diff('day', DATE '1970-01-01', date) % 97 = 0)
        OR (key % 20 = 0 AND date_diff('day', DATE '1970-01-01', date) % 11 = 0) THEN NULL ELSE volume END AS volume
        FROM bars""",
    "nulls": """SELECT ticker, count(*) AS rows, count(*) FILTER (close IS NULL OR volume IS NULL) AS null_rows
        FROM gappy GROUP BY ticker HAVING count(*) >= 26""",
}
# Volume gaps only empty the volume features: a row survives when its 20 last
# volumes are known and the other features are.
_GAPPY_FEATURES = {
    **_GAPPY,
    "known": """SELECT ticker, date, count(volume) OVER (PARTITION BY ticker ORDER BY date
        ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) = 20 AS full20 FROM gappy""",
    "kept": """SELECT i.* FROM indicators i JOIN known USING (ticker, date) JOIN nulls USING (ticker)
        WHERE null_rows / rows <= 0.01 AND full20 AND sma_50 IS NOT NULL AND rsi_14 IS NOT NULL
          AND volatility_14 IS NOT NULL""",
    "per_ticker": """SELECT n.ticker, count(k.date) AS feature_rows,
        count(*) FILTER (k.rsi_14 < 0 OR k.rsi_14 > 100) AS bad_rsi,
        count(*) FILTER (k.volatility_14 < 0) AS bad_vol
        FROM nulls n LEFT JOIN kept k USING (ticker) WHERE null_rows / rows <= 0.01 GROUP BY n.ticker""",
}


def _check_row(name, passed, observed, threshold, failed, details="'{}'") -> str:
    return (
        f"'{name}' AS check_name, CASE WHEN {passed} THEN 'pass' ELSE 'fail' END AS status,"
        f" CAST({observed} AS DOUBLE) AS observed_value, CAST({threshold} AS DOUBLE) AS threshold,"
        f" CAST({failed} AS INTEGER) AS failed_count, {details} AS details"
    )


def _told(**fields: str) -> str:
    """A JSON text of SQL expressions."""
    return f"CAST(json_object({', '.join(f"'{k}', {v}" for k, v in fields.items())}) AS VARCHAR)"


@query(
    "source_null_ratio",
    sql(
        "SELECT ticker, check_name, status, " + rnd("observed_value", 6) + " AS observed_value,"
        " threshold, failed_count, details FROM (SELECT ticker, "
        + _check_row(
            "source_base_null_ratio", "null_rows / rows <= 0.01", "null_rows / rows", "0.01", "null_rows",
            _told(rows="rows", null_rows="null_rows"),
        )
        + " FROM nulls)",
        "bars",
        extra=_GAPPY,
    ),
)
def source_null_ratio(spark, folder):
    found = quality.source_null_check(gappy_bars(spark, folder))
    return rounded(found, {"observed_value": 6})


@query(
    "dq_feature_rows",
    sql(
        "SELECT ticker, "
        + _check_row(
            "feature_rows_after_dropna", "feature_rows > 0", "feature_rows", "NULL",
            "CASE WHEN feature_rows > 0 THEN 0 ELSE 1 END",
            _told(
                message=f"CASE WHEN feature_rows > 0 THEN '{quality.MESSAGES['feature_rows']}'"
                f" ELSE '{quality.MESSAGES['no_feature_rows']}' END"
            ),
        )
        + " FROM per_ticker",
        "indicators",
        extra=_GAPPY_FEATURES,
    ),
)
def dq_feature_rows(spark, folder):
    return _checks(spark, folder, "feature_rows_after_dropna")


@query(
    "dq_feature_null_cells",
    sql(
        "SELECT ticker, "
        + _check_row(
            "feature_null_cells", "null_cells = 0", "null_cells", "0", "null_cells",
            _told(feature_columns=f"{FEATURE_COLUMNS}"),
        )
        + " FROM (SELECT i.ticker, "
        + "sum(" + " + ".join(f"CAST(i.{c} IS NULL AS INTEGER)" for c in FEATURE_COLUMNS) + ") AS null_cells"
        + " FROM kept i GROUP BY i.ticker)",
        "indicators",
        extra=_GAPPY_FEATURES,
    ),
)
def dq_feature_null_cells(spark, folder):
    return _checks(spark, folder, "feature_null_cells")


@query(
    "dq_rsi_range",
    sql(
        "SELECT ticker, " + _check_row(
            "rsi_range_check", "bad_rsi = 0", "bad_rsi", "0", "bad_rsi", _told(expected_range="'[0, 100]'")
        )
        + " FROM per_ticker WHERE feature_rows > 0",
        "indicators",
        extra=_GAPPY_FEATURES,
    ),
)
def dq_rsi_range(spark, folder):
    return _checks(spark, folder, "rsi_range_check")


@query(
    "dq_volatility",
    sql(
        "SELECT ticker, "
        + _check_row(
            "volatility_non_negative", "bad_vol = 0", "bad_vol", "0", "bad_vol", _told(column="'volatility_14'")
        )
        + " FROM per_ticker WHERE feature_rows > 0 AND bad_rsi = 0",
        "indicators",
        extra=_GAPPY_FEATURES,
    ),
)
def dq_volatility(spark, folder):
    return _checks(spark, folder, "volatility_non_negative")


@query(
    "dq_feature_upserts",
    sql(
        "SELECT ticker, " + _check_row(
            "feature_rows_upserted", "true", "feature_rows", "NULL", "0",
            _told(message=f"'{quality.MESSAGES['feature_rows_upserted']}'"),
        )
        + " FROM per_ticker WHERE feature_rows > 0 AND bad_rsi = 0 AND bad_vol = 0",
        "indicators",
        extra=_GAPPY_FEATURES,
    ),
)
def dq_feature_upserts(spark, folder):
    return _checks(spark, folder, "feature_rows_upserted")


@query(
    "dq_feature_exceptions",
    sql(
        "SELECT ticker, "
        + _check_row(
            "feature_engineering_exception", "false", "NULL", "NULL", "1", _told(error="'source null ratio too high'")
        )
        + " FROM nulls WHERE null_rows / rows > 0.01 UNION ALL SELECT ticker, "
        + _check_row(
            "feature_engineering_exception", "false", "NULL", "NULL", "1",
            _told(
                error="CASE WHEN feature_rows = 0 THEN 'no feature rows after dropping incomplete ones'"
                " WHEN bad_rsi > 0 THEN 'rsi out of range' ELSE 'negative volatility' END"
            ),
        )
        + " FROM per_ticker WHERE feature_rows = 0 OR bad_rsi > 0 OR bad_vol > 0",
        "indicators",
        extra=_GAPPY_FEATURES,
    ),
)
def dq_feature_exceptions(spark, folder):
    return _checks(spark, folder, "feature_engineering_exception")
