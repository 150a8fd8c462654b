"""Scaling, training sequences and chronological splits, per ticker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from barline.operators.series import BLOCK_DAYS, Segmented, haloed, own_rows, segment
from barline.schemas import FEATURE_COLUMNS

# Window length, rows a model needs, held-out share.
SEQUENCE_ROWS = 30
MIN_TRAINING_ROWS = SEQUENCE_ROWS + 10
HOLDOUT = 0.15


def fit_scaler(features: DataFrame, columns: list[str] = FEATURE_COLUMNS) -> DataFrame:
    """Minimum and maximum per ticker and column (``lo_<c>``, ``hi_<c>``).

    A partial aggregate: a ticker's rows never meet in one task.
    """
    bounds = [f(c).alias(f"{p}_{c}") for c in columns for p, f in (("lo", F.min), ("hi", F.max))]
    return features.groupBy("ticker").agg(*bounds)


def scaler_table(scaler: DataFrame, columns: list[str] = FEATURE_COLUMNS) -> DataFrame:
    """The scaler in long form: ticker, feature, lo, hi."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.col(f"lo_{c}").alias("lo"), F.col(f"hi_{c}").alias("hi"))
            for c in columns
        ]
    )
    return scaler.select("ticker", F.explode(cells).alias("s")).select("ticker", "s.*")


def scaled(value: Column, lo: Column, hi: Column) -> Column:
    """To [0, 1]; a constant column becomes 0."""
    return (value - lo) / F.coalesce(F.nullif(hi - lo, F.lit(0.0)), F.lit(1.0))


def unscaled(value: Column, lo: Column, hi: Column) -> Column:
    return value * F.coalesce(F.nullif(hi - lo, F.lit(0.0)), F.lit(1.0)) + lo


def minmax_scale(
    features: DataFrame, scaler: DataFrame | None = None, columns: list[str] = FEATURE_COLUMNS
) -> DataFrame:
    """Features scaled per ticker; by default fitted on all of them.

    Then the bounds are found over blocks of the ticker's days, which hold the rows to scale:
    features are shuffled once, and no scaler joins them. A given scaler (or a table without
    days) is a join with one row per ticker, which AQE broadcasts if small.
    """
    if scaler is None and isinstance(features.schema["date"].dataType, (T.DateType, T.TimestampType)):
        needed = features.select("ticker", "date", *columns)
        rows = haloed(needed, 0, bounds=columns).select("ticker", "_lo", "_hi", F.inline("list"))
        return rows.select(
            "ticker", "date", *[scaled(F.col(c), F.col("_lo")[i], F.col("_hi")[i]).alias(c) for i, c in enumerate(columns)]
        )
    scaler = fit_scaler(features, columns) if scaler is None else scaler
    joined = features.join(scaler, "ticker")
    return joined.select(
        "ticker",
        "date",
        *[scaled(F.col(c), F.col(f"lo_{c}"), F.col(f"hi_{c}")).alias(c) for c in columns],
    )


def training_sequences(
    features: DataFrame,
    rows: int = SEQUENCE_ROWS,
    columns: list[str] = FEATURE_COLUMNS,
    *,
    scale: bool = False,
    block_days: int = BLOCK_DAYS,
) -> DataFrame:
    """``x`` = the ``rows`` rows before each row, ``y`` = the row's first column.

    ``features`` are scaled already, or with ``scale`` on the way, as ``minmax_scale`` does.
    """
    cut = _cut(features, rows, columns, scale, block_days)
    return _windows(cut, rows, columns, -rows, -1, F.col(columns[0]).alias("y"))


def prediction_windows(
    features: DataFrame,
    rows: int = SEQUENCE_ROWS,
    columns: list[str] = FEATURE_COLUMNS,
    *,
    scale: bool = False,
    block_days: int = BLOCK_DAYS,
) -> DataFrame:
    """``x`` = the last ``rows`` rows up to and including each row."""
    return _windows(_cut(features, rows, columns, scale, block_days), rows, columns, 1 - rows, 0)


def training_window_sums(
    features: DataFrame, rows: int = SEQUENCE_ROWS, columns: list[str] = FEATURE_COLUMNS,
    *, scale: bool = False, block_days: int = BLOCK_DAYS,
) -> DataFrame:
    """``total``: all values of each training sequence's ``x``, every one weighted by step times column (from 1).

    A row's values are weighted and added up once, not in each of the windows that hold it.
    """
    return _window_sums(_cut(features, rows, columns, scale, block_days), rows, columns, -rows, -1)


def prediction_window_sums(
    features: DataFrame, rows: int = SEQUENCE_ROWS, columns: list[str] = FEATURE_COLUMNS,
    *, scale: bool = False, block_days: int = BLOCK_DAYS,
) -> DataFrame:
    """The same of each prediction window."""
    return _window_sums(_cut(features, rows, columns, scale, block_days), rows, columns, 1 - rows, 0)


def _cut(features: DataFrame, back: int, columns: list[str], scale: bool, block_days: int) -> Segmented:
    """``features`` in blocks; with ``scale``, ``columns`` scaled by the bounds of all rows of the ticker."""
    bounds, within = (columns, scaled) if scale else ((), None)
    return segment(features, back, block_days=block_days, bounds=bounds, within=within)


def _windows(cut: Segmented, rows, columns, first, last, *more: Column) -> DataFrame:
    frame = cut.ordered.rowsBetween(first, last)
    step = F.array(*[F.col(c) for c in columns])
    with_x = cut.df.withColumn("x", F.collect_list(step).over(frame))
    full = own_rows(with_x.filter(F.size("x") == rows))
    return full.select("ticker", "date", "x", *more)


def _window_sums(cut: Segmented, rows, columns, first, last) -> DataFrame:
    frame = cut.ordered.rowsBetween(first, last)
    of_row = sum(((i + 1) * F.col(c) for i, c in enumerate(columns)), F.lit(0.0))
    narrow = cut.df.select(cut.key, "_seg", "_own", "_before", "_rows", cut.order, of_row.alias("_sum"))
    met = narrow.withColumns({"steps": F.count(F.lit(1)).over(frame).cast("int"), "_sums": F.collect_list("_sum").over(frame)})
    full = own_rows(met.filter(F.col("steps") == rows))
    weighted = F.transform("_sums", lambda v, k: (k + 1) * v)
    total = F.aggregate(weighted, F.lit(0.0), lambda acc, v: acc + v)
    # A sum that is NULL is not in the list.
    return full.select("ticker", "date", "steps", F.when(F.size("_sums") == rows, total).alias("total"))


def split_position(sequences: Column, holdout: float = HOLDOUT) -> Column:
    """How many of a ticker's sequences train (the first ones; no shuffling)."""
    return F.floor(sequences.cast("double") * F.lit(1 - holdout))


def chronological_split(
    features: DataFrame,
    rows: int = SEQUENCE_ROWS,
    holdout: float = HOLDOUT,
    *,
    lags: dict[str, tuple[str, int]] | None = None,
    scale: list[str] | None = None,
    block_days: int = BLOCK_DAYS,
) -> DataFrame:
    """Rows that end a training sequence, with ``sequence_no`` and ``is_train``.

    Row ``i`` of a ticker (from 0) is sequence ``i - rows``; ``lags`` adds columns
    taken some rows earlier, on the same sort. The columns in ``scale`` are scaled
    as ``minmax_scale`` does.
    """
    lags = lags or {}
    back = max([rows] + [n for _, n in lags.values()])
    cut = _cut(features, back, scale or [], bool(scale), block_days)
    df = cut.df.withColumns(
        {
            "sequence_no": cut.position() - rows,
            "sequences": cut.length() - rows,
            **{name: F.lag(c, n).over(cut.ordered) for name, (c, n) in lags.items()},
        }
    ).filter("sequence_no > 0")
    df = df.withColumn("is_train", F.col("sequence_no") <= split_position(F.col("sequences"), holdout))
    return own_rows(df)


def latest_rows(df: DataFrame, n: int, *, key: str = "ticker", order: str = "date") -> DataFrame:
    """The last ``n`` rows per key, numbered from the newest.

    Spark limits each group to ``n`` rows before the shuffle as well.
    """
    newest = Window.partitionBy(key).orderBy(F.col(order).desc())
    return df.withColumn("rank_from_latest", F.row_number().over(newest)).filter(
        F.col("rank_from_latest") <= n
    )


def short_keys(df: DataFrame, n: int, key: str = "ticker") -> DataFrame:
    """Keys with fewer than ``n`` rows (to be skipped)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") < n)
