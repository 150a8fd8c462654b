"""Ticker lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# The default list and the dashboard's default selection.
DEFAULT_TICKERS = ["AAPL", "NVDA", "MSFT"]
DEFAULT_SELECTION = "AAPL"


def parse_tickers(text: str | None, default: list[str] = DEFAULT_TICKERS) -> list[str]:
    """``" a, b,,"`` -> ``["A", "B"]``; the default when nothing is left."""
    names = [part.strip().upper() for part in (text or "").split(",")]
    return [n for n in names if n] or list(default)


def ticker_list(df: DataFrame, column: str, default: list[str] = DEFAULT_TICKERS) -> DataFrame:
    """The same rule on a text column: the distinct tickers of all lists."""
    names = F.filter(
        F.transform(F.split(column, ","), lambda x: F.upper(F.trim(x))), lambda x: x != ""
    )
    fallback = F.array(*[F.lit(t) for t in default])
    chosen = F.when(F.coalesce(F.size(names), F.lit(0)) > 0, names).otherwise(fallback)
    return df.select(F.explode(chosen).alias("ticker")).distinct()


def inline_tickers(spark: SparkSession, tickers: list[str]) -> DataFrame:
    """A one-column table from an array literal."""
    return spark.range(1).select(F.explode(F.array(*[F.lit(t) for t in tickers])).alias("ticker"))


def only_tickers(df: DataFrame, tickers: DataFrame) -> DataFrame:
    """Rows of the listed tickers. The optimizer broadcasts a list that is small."""
    return df.join(tickers, "ticker", "left_semi")


def one_ticker(df: DataFrame, ticker: str = DEFAULT_SELECTION) -> DataFrame:
    """Dashboard filter: an equality predicate, pushed down to the scan."""
    return df.filter(F.col("ticker") == ticker)
