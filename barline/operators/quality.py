"""Data-quality checks as long-form rows, one per (ticker, check).

A per-ticker summary is one aggregate over all tickers at once; the checks are
expressions over it. A failed gate drops the ticker from later stages and the
checks after that gate are not reported for it; other tickers go on.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barline.operators.validate import RunContext
from barline.schemas import FEATURE_COLUMNS, QUALITY_RESULTS, conform

log = logging.getLogger(__name__)

# Messages in the details of checks that carry no numbers.
MESSAGES = {
    "api_payload_valid": "Time Series payload retrieved successfully",
    "api_date_key_format": "Invalid date keys detected in API payload",
    "raw_rows_written": "Raw rows persisted before curated upsert",
    "rows_upserted": "No new rows to upsert",
    "reconciliation": "No new rows to reconcile",
    "feature_rows": "Feature rows available for upsert",
    "no_feature_rows": "No feature rows remain after dropna",
    "feature_rows_upserted": "Feature rows upserted successfully",
}

RESULT_COLUMNS = ["ticker", "check_name", "status", "observed_value", "threshold", "failed_count", "details"]


def check(
    name: str,
    *,
    applies: Column | None = None,
    passed: Column | bool = True,
    observed: Column | float | None = None,
    threshold: Column | float | None = None,
    failed: Column | int = 0,
    details: Column | None = None,
) -> Column:
    """One check as a struct, NULL where it does not apply."""
    as_col = lambda x: x if isinstance(x, Column) else F.lit(x)
    result = F.struct(
        F.lit(name).alias("check_name"),
        F.when(as_col(passed), "pass").otherwise("fail").alias("status"),
        as_col(observed).cast("double").alias("observed_value"),
        as_col(threshold).cast("double").alias("threshold"),
        as_col(failed).cast("int").alias("failed_count"),
        (F.lit("{}") if details is None else F.to_json(details)).alias("details"),
    )
    return result if applies is None else F.when(applies, result)


def long_form(summary: DataFrame, checks: list[Column]) -> DataFrame:
    """Per-ticker summary -> one row per applying check."""
    applying = F.filter(F.array(*checks), lambda c: c.isNotNull())
    return summary.select("ticker", F.explode(applying).alias("c")).select("ticker", "c.*")


def with_context(results: DataFrame, context: RunContext, at: Column | None = None) -> DataFrame:
    """Results in the stored table's shape."""
    stamped = results.withColumns(
        {
            "dag_id": F.lit(context.dag_id),
            "task_id": F.lit(context.task_id),
            "run_id": F.lit(context.run_id),
            "created_at": F.current_timestamp() if at is None else at,
        }
    )
    return conform(stamped, QUALITY_RESULTS)


def store_results(results: DataFrame, path: str, part: str) -> bool:
    """Write to the quality log, in place of what the same part of the same run wrote before.

    A load that is run again, or a batch of a stream that is replayed, leaves the
    log as it was. A failed write warns and does not stop the job.
    """
    parts = {"log_run": F.coalesce("run_id", F.lit("none")), "log_part": F.lit(part)}
    try:
        rows = results.withColumns(parts).write.mode("overwrite").partitionBy(*parts)
        rows.option("partitionOverwriteMode", "dynamic").parquet(path)
        return True
    except Exception as exc:  # the log must never fail the load it describes
        log.warning("could not write data-quality results: %s", exc)
        return False


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """The quality log in the stored table's shape."""
    return conform(spark.read.parquet(path), QUALITY_RESULTS)


def exception_row(spark, name: str, ticker: str | None, error: BaseException | str) -> DataFrame:
    """The result row a job appends when it ends in an error."""
    base = spark.range(1).select(F.lit(ticker).cast("string").alias("ticker"))
    error_text = F.struct(F.lit(str(error)).alias("error"))
    return long_form(base, [check(name, passed=False, failed=1, details=error_text)])


def source_nulls(bars: DataFrame) -> DataFrame:
    """Rows, and rows lacking close or volume, by ticker."""
    lacking = F.col("close").isNull() | F.col("volume").isNull()
    return bars.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(lacking).alias("null_rows")
    )


def feature_summary(features: DataFrame) -> DataFrame:
    """What the feature gates look at, by ticker."""
    null_cells = sum((F.col(c).isNull().cast("int") for c in FEATURE_COLUMNS), F.lit(0))
    rsi = F.col("rsi_14")
    return features.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("feature_rows"),
        F.sum(null_cells).alias("null_cells"),
        F.count_if((rsi < 0) | (rsi > 100)).alias("rsi_out_of_range"),
        F.count_if(F.col("volatility_14") < 0).alias("negative_volatility"),
    )


def source_null_check(
    bars: DataFrame, *, min_rows: int = 26, max_null_ratio: float = 0.01
) -> DataFrame:
    """The gate ahead of the feature step alone; needs no features."""
    summary = source_nulls(bars).filter(F.col("rows") >= min_rows)
    return long_form(summary, [_source_null_ratio(max_null_ratio)])


def _source_null_ratio(max_null_ratio: float) -> Column:
    ratio = F.col("null_rows") / F.col("rows")
    return check(
        "source_base_null_ratio", passed=ratio <= max_null_ratio, observed=ratio,
        threshold=max_null_ratio, failed=F.col("null_rows"), details=F.struct("rows", "null_rows"),
    )


def feature_checks(
    bars: DataFrame, features: DataFrame, *, min_rows: int = 26, max_null_ratio: float = 0.01
) -> DataFrame:
    """Checks around the feature step; tickers short of history report nothing."""
    summary = (
        source_nulls(bars)
        .join(feature_summary(features), "ticker", "left")
        .na.fill(0, ["feature_rows", "null_cells", "rsi_out_of_range", "negative_volatility"])
    )
    return summary_checks(summary, min_rows=min_rows, max_null_ratio=max_null_ratio)


def series_checks(series: DataFrame) -> DataFrame:
    """The same checks from the table that holds a row per ticker; no history is read."""
    counts = [F.col("state.rows").alias("rows"), F.col("state.nulls").alias("null_rows")]
    return summary_checks(series.select("*", *counts))


def summary_checks(summary: DataFrame, *, min_rows: int = 26, max_null_ratio: float = 0.01) -> DataFrame:
    summary = summary.filter(F.col("rows") >= min_rows)
    ratio = F.col("null_rows") / F.col("rows")
    rows, cells = F.col("feature_rows"), F.col("null_cells")
    rsi, vol = F.col("rsi_out_of_range"), F.col("negative_volatility")
    source_ok = ratio <= max_null_ratio
    some = source_ok & (rows > 0)
    complete = some & (cells == 0)
    in_range = complete & (rsi == 0)
    stored = in_range & (vol == 0)
    text = lambda **kw: F.struct(*[F.lit(v).alias(k) for k, v in kw.items()])
    return long_form(
        summary,
        [
            _source_null_ratio(max_null_ratio),
            check(
                "feature_rows_after_dropna", applies=source_ok, passed=rows > 0, observed=rows,
                failed=F.when(rows > 0, 0).otherwise(1),
                details=F.struct(
                    F.when(rows > 0, MESSAGES["feature_rows"]).otherwise(MESSAGES["no_feature_rows"]).alias("message")
                ),
            ),
            check(
                "feature_null_cells", applies=some, passed=cells == 0, observed=cells, threshold=0.0, failed=cells,
                details=F.struct(F.array(*[F.lit(c) for c in FEATURE_COLUMNS]).alias("feature_columns")),
            ),
            check(
                "rsi_range_check", applies=complete, passed=rsi == 0, observed=rsi, threshold=0.0,
                failed=rsi, details=text(expected_range="[0, 100]"),
            ),
            check(
                "volatility_non_negative", applies=in_range, passed=vol == 0, observed=vol,
                threshold=0.0, failed=vol, details=text(column="volatility_14"),
            ),
            check(
                "feature_rows_upserted", applies=stored, observed=rows,
                details=text(message=MESSAGES["feature_rows_upserted"]),
            ),
            check(
                "feature_engineering_exception", applies=~stored, passed=False, failed=1,
                details=F.struct(
                    F.when(~source_ok, "source null ratio too high")
                    .when(rows == 0, "no feature rows after dropping incomplete ones")
                    .when(cells > 0, "null cells in features")
                    .when(rsi > 0, "rsi out of range")
                    .otherwise("negative volatility")
                    .alias("error")
                ),
            ),
        ],
    )
