"""Table schemas and additive schema evolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Feature order is part of the stored-table contract. `close`
# stays first (targets and inverse scaling read it by position) and new
# features are only ever appended.
FEATURE_COLUMNS = [
    "close", "daily_return", "sma_20", "sma_50", "ema_12", "ema_26", "macd",
    "macd_signal", "rsi_14", "bb_upper", "bb_lower", "volatility_14",
    "volume_sma_20", "bb_width", "volume_ratio_20", "return_3d", "return_5d",
]

_TYPES = {
    "string": T.StringType(), "double": T.DoubleType(), "bigint": T.LongType(),
    "int": T.IntegerType(), "boolean": T.BooleanType(), "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _struct(columns: str) -> T.StructType:
    """``"name type, ..."`` to a StructType, without needing a session."""
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


PRICES = _struct(
    "ticker string, date timestamp, open double, high double, low double, close double,"
    " volume bigint, created_at timestamp, updated_at timestamp"
)
RAW_PRICES = _struct(
    "ticker string, source_date_key string, trade_date date, open double, high double,"
    " low double, close double, volume bigint, raw_payload string, is_valid boolean,"
    " reject_reason string, source string, dag_id string, task_id string, run_id string,"
    " ingested_at timestamp"
)
FEATURES = _struct(
    "ticker string, date date, " + ", ".join(f"{c} double" for c in FEATURE_COLUMNS)
)
PREDICTIONS = _struct(
    "ticker string, predicted_date date, predicted_close double, actual_close double,"
    " model_version string, created_at timestamp"
)
MODEL_METADATA = _struct(
    "ticker string, model_version string, trained_at timestamp, training_start date,"
    " training_end date, mae double, rmse double, notes string, created_at timestamp"
)
QUALITY_RESULTS = _struct(
    "dag_id string, task_id string, run_id string, ticker string, check_name string,"
    " status string, observed_value double, threshold double, failed_count int,"
    " details string, created_at timestamp"
)

_BAR = _struct("date date, close double, volume bigint")
# What a ticker's bars so far leave for the next ones: counts, days, its last bars, the last
# known close before those, rows since the last known close, and the averages.
SERIES_STATE = T.StructType(
    [
        *_struct("rows bigint, nulls bigint, first_date date, last_date date").fields,
        T.StructField("halo", T.ArrayType(_BAR)),
        *_struct("older double, gap bigint, ema_12 double, ema_26 double, signal double").fields,
    ]
)
# One row per ticker, kept up to date by every load: the state, what the gates and the
# forecasts ask of its features, and the day up to which all predictions have their actuals.
SERIES = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("state", SERIES_STATE),
        *_struct(
            "feature_rows bigint, null_cells bigint, rsi_out_of_range bigint, negative_volatility bigint,"
            " feature_last date, feature_close double, settled_until date"
        ).fields,
    ]
)

QUARANTINE = _struct("ticker string, doc string, payload_status string, dag_id string, task_id string, run_id string")
FITTED_MODELS = _struct(
    "ticker string, model_version string, trained_at timestamp, slope double, intercept double,"
    " train_rows bigint, lo_close double, hi_close double"
)

KEYS = {
    "fitted_models": ["ticker", "model_version"],
    "series": ["ticker"],
    "prices": ["ticker", "date"],
    "raw_prices": ["ticker", "source_date_key", "run_id"],
    "features": ["ticker", "date"],
    "predictions": ["ticker", "predicted_date"],
    "model_metadata": ["model_version"],
}


def conform(df: DataFrame, schema: T.StructType, defaults: dict[str, Column] | None = None) -> DataFrame:
    """Cast to ``schema``, in its order; columns the frame lacks are added."""
    defaults = defaults or {}
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else defaults.get(f.name, F.lit(None)))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


def feature_prefix(n: int) -> list[str]:
    """The first ``n`` feature columns, for models trained on an older list."""
    if not 0 < n <= len(FEATURE_COLUMNS):
        raise ValueError(f"model expects {n} features, only {len(FEATURE_COLUMNS)} exist")
    return FEATURE_COLUMNS[:n]
