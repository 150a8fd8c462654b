"""Payload documents to raw and curated price rows, with gates per ticker.

Each mode returns an :class:`Ingest` of lazy frames over the same plan. The
documents hold all rows of a ticker, so counting per ticker after the explode
is reduced to one row per document before its shuffle. Several frames read the
validated rows; a job that writes more than one of them passes ``stage`` (write
to the shared scratch folder, read back) so the documents are parsed once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from barline.functions.calendar import business_days
from barline.operators.quality import MESSAGES, check, long_form
from barline.operators.validate import RunContext, price_records, raw_observations, validate_rows, with_dates
from barline.sources.payload import explode_series, parse, refused

# Gates, and the look-back of a first run.
MAX_REJECT_RATIO = 0.20
MAX_STALENESS_DAYS = 5
MIN_COMPLETENESS = 0.90
FIRST_RUN_DAYS = 99

Stage = Callable[[DataFrame], DataFrame]


def _as_is(df: DataFrame) -> DataFrame:
    return df


REASONS = [
    "invalid_date", "invalid_row_type", "missing_fields", "type_conversion_error",
    "non_positive_price", "negative_volume", "high_below_low", "open_outside_high_low",
    "close_outside_high_low",
]


@dataclass(frozen=True)
class Ingest:
    summary: DataFrame  # one row per ticker with a usable document
    quality: DataFrame  # long-form checks
    raw: DataFrame      # rows for the raw table
    prices: DataFrame   # accepted rows for the curated table
    refused: DataFrame  # whole documents that have no series, with their status


def key_checks(
    docs: DataFrame, as_of: Column, *, max_staleness_days: int = MAX_STALENESS_DAYS
) -> DataFrame:
    """The checks of a daily load that ask for documents and their date keys alone.

    The same rows as in the load's ``quality``: no row is validated for them and nothing stored is read.
    """
    dated = with_dates(explode_series(parse(docs.select("ticker", "doc"))))
    summary = dated.groupBy("ticker").agg(*_key_counts()).withColumn("staleness", F.datediff(as_of, "latest"))
    return long_form(summary, _key_checks(max_staleness_days))


def high_water_mark(
    tickers: DataFrame, stored: DataFrame, as_of: Column, first_run_days: int = FIRST_RUN_DAYS
) -> DataFrame:
    """Last stored date per ticker; ``as_of - first_run_days`` where nothing is stored."""
    last = stored.groupBy("ticker").agg(F.max(F.to_date("date")).alias("stored_until"))
    return tickers.join(last, "ticker", "left").withColumn(
        "last_date", F.coalesce("stored_until", F.date_sub(as_of, first_run_days))
    )


def incremental_rows(rows: DataFrame, date: str = "date") -> DataFrame:
    """Rows newer than their ticker's mark (``last_date``)."""
    return rows.filter(F.col(date) > F.col("last_date"))


def daily(
    docs: DataFrame,
    stored: DataFrame,
    as_of: Column,
    context: RunContext = RunContext(),
    *,
    max_reject_ratio: float = MAX_REJECT_RATIO,
    max_staleness_days: int = MAX_STALENESS_DAYS,
    min_completeness: float = MIN_COMPLETENESS,
    stage: Stage = _as_is,
) -> Ingest:
    """Incremental load: only dates after the ticker's high-water mark.

    An unreadable date key counts as a reject but gives no raw row. Raw rows
    are written once the freshness and completeness gates pass, curated rows
    only after the reject gates.
    """
    # Marks join the documents (one row per ticker) before the explode.
    marked = high_water_mark(docs.select("ticker", "doc"), stored, as_of)
    parsed = parse(marked)
    rows = stage(validate_rows(explode_series(parsed)))
    new = F.col("trade_date") > F.col("last_date")
    rejected = F.col("trade_date").isNull() | (new & ~F.col("is_valid"))
    summary = rows.groupBy("ticker", "last_date").agg(
        *_key_counts(),
        F.count_distinct(F.when(new, F.col("trade_date"))).alias("available"),
        F.count_if(new).alias("raw_rows"),
        F.count_if(new & F.col("is_valid")).alias("valid_rows"),
        F.count_if(rejected).alias("rejected_rows"),
        *_reason_counts(rejected),
    )
    summary = summary.withColumns(
        {
            "staleness": F.datediff(as_of, "latest"),
            "candidates": F.col("valid_rows") + F.col("rejected_rows"),
            "expected": F.when(
                F.col("latest") > F.col("last_date"),
                business_days(F.date_add("last_date", 1), F.col("latest")),
            ),
            "reasons": _reason_map(),
        }
    )
    summary = summary.withColumn(
        "completeness",
        F.when(F.col("expected") > 0, F.col("available") / F.col("expected")).when(
            F.col("expected") == 0, F.lit(1.0)
        ),
    )
    valid, bad, raw = F.col("valid_rows"), F.col("rejected_rows"), F.col("raw_rows")
    fresh = _fresh(max_staleness_days)
    complete = fresh & F.coalesce(F.col("completeness") >= min_completeness, F.lit(True))
    summary = _with_gates(summary, complete, max_reject_ratio)
    some, kept, accepted = F.col("candidates") > 0, F.col("not_all_rejected"), F.col("accepted")
    short = F.col("expected") - F.col("available")
    quality = long_form(
        summary,
        [
            *_key_checks(max_staleness_days),
            check(
                "incremental_completeness", applies=fresh & F.col("completeness").isNotNull(),
                passed=F.col("completeness") >= min_completeness, observed=F.col("completeness"),
                threshold=min_completeness, failed=F.greatest(short, F.lit(0)),
                details=F.struct(
                    F.col("expected").alias("expected_market_days"), F.col("available").alias("available_market_days"),
                    F.date_add("last_date", 1).alias("window_start"), F.col("latest").alias("window_end"),
                ),
            ),
            check("raw_rows_written", applies=complete & (raw > 0), observed=raw, details=_message("raw_rows_written")),
            _row_validation(complete & some, max_reject_ratio),
            _all_rejected(complete & ~kept),
            _reject_ratio(kept & ~accepted, max_reject_ratio),
            check(
                "rows_upserted", applies=accepted, observed=valid,
                details=F.struct(
                    F.when(valid > 0, bad).alias("rejected_rows"), F.when(valid == 0, MESSAGES["rows_upserted"]).alias("message")
                ),
            ),
            _reconciliation("daily_reconciliation", accepted, "daily"),
        ],
    )
    gates = summary.select("ticker", F.col("complete").alias("_raw_ok"), F.col("accepted").alias("_ok"))
    gated = rows.filter(new).join(gates.filter("_raw_ok"), "ticker")
    return Ingest(
        summary,
        quality,
        raw_observations(gated, context),
        price_records(gated.filter("_ok")),
        refused(parsed),
    )


def backfill(
    docs: DataFrame,
    context: RunContext = RunContext(),
    *,
    max_reject_ratio: float = MAX_REJECT_RATIO,
    stage: Stage = _as_is,
) -> Ingest:
    """Full load: every row of the document, raw rows also for unreadable dates."""
    parsed = parse(docs.select("ticker", "doc"))
    rows = stage(validate_rows(explode_series(parsed)))
    bad_row = ~F.col("is_valid")
    summary = rows.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if("is_valid").alias("valid_rows"),
        F.count_if(bad_row).alias("rejected_rows"),
        *_reason_counts(bad_row),
    )
    summary = summary.withColumns(
        {"candidates": F.col("valid_rows") + F.col("rejected_rows"), "reasons": _reason_map()}
    )
    summary = _with_gates(summary, F.lit(True), max_reject_ratio)
    kept, accepted = F.col("not_all_rejected"), F.col("accepted")
    quality = long_form(
        summary,
        [
            check("api_payload_valid", observed=F.col("raw_rows"), details=_message("api_payload_valid")),
            check("raw_rows_written", observed=F.col("raw_rows"), details=_message("raw_rows_written")),
            _all_rejected(~kept),
            _row_validation(kept, max_reject_ratio),
            _reject_ratio(kept & ~accepted, max_reject_ratio),
            check(
                "rows_upserted", applies=accepted, observed=F.col("valid_rows"), details=F.struct("rejected_rows")
            ),
            _reconciliation("backfill_reconciliation", accepted, "backfill"),
            check(
                "backfill_ingestion_exception", applies=~accepted, passed=False, failed=1,
                details=F.struct(
                    F.when(kept, "reject ratio above threshold")
                    .otherwise("all candidate rows rejected")
                    .alias("error")
                ),
            ),
        ],
    )
    unusable = long_form(
        parsed.filter("payload_status <> 'ok'"),
        [
            check(
                "backfill_ingestion_exception", passed=False, failed=1,
                details=F.struct(F.col("payload_status").alias("error")),
            )
        ],
    )
    ok = summary.filter("accepted").select("ticker")
    return Ingest(
        summary,
        quality.unionByName(unusable),
        raw_observations(rows, context),
        price_records(rows.join(ok, "ticker", "left_semi")),
        refused(parsed),
    )


def single_day(
    docs: DataFrame, as_of: Column, context: RunContext = RunContext()
) -> Ingest:
    """Only the row keyed by the day before ``as_of``."""
    parsed = parse(docs.select("ticker", "doc"))
    wanted = F.date_format(F.date_sub(as_of, 1), "yyyy-MM-dd")
    all_rows = explode_series(parsed)
    per_doc = all_rows.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("series_rows"),
        F.max_by("row_json", F.col("source_date_key") == wanted).alias("row_json"),
        F.max(F.col("source_date_key") == wanted).alias("present"),
    )
    summary = validate_rows(per_doc.withColumn("source_date_key", wanted))
    present, valid = F.col("present"), F.col("is_valid")
    quality = long_form(
        summary,
        [
            check("api_payload_valid", observed=F.col("series_rows"), details=_message("api_payload_valid")),
            check("daily_row_present", applies=~present, observed=0.0),
            check(
                "daily_row_validation", applies=present, passed=valid, observed=1.0,
                failed=F.when(valid, 0).otherwise(1), details=F.struct("reject_reason"),
            ),
            check("rows_upserted", applies=present & valid, observed=1.0),
            check(
                "daily_ingestion_exception", applies=present & ~valid, passed=False, failed=1,
                details=F.struct(F.col("reject_reason").alias("error")),
            ),
        ],
    )
    unusable = long_form(
        parsed.filter("payload_status <> 'ok'"),
        [
            check(
                "daily_ingestion_exception", passed=False, failed=1,
                details=F.struct(F.col("payload_status").alias("error")),
            )
        ],
    )
    found = summary.filter("present")
    return Ingest(
        summary, quality.unionByName(unusable), raw_observations(found, context), price_records(found), refused(parsed)
    )


def _key_counts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("series_rows"),
        F.count_if(F.col("trade_date").isNull()).alias("bad_keys"),
        F.max("trade_date").alias("latest"),
    ]


def _fresh(max_staleness_days: int) -> Column:
    return F.coalesce(F.col("staleness") <= max_staleness_days, F.lit(True))


def _key_checks(max_staleness_days: int) -> list[Column]:
    fresh = _fresh(max_staleness_days)
    return [
        check("api_payload_valid", observed=F.col("series_rows"), details=_message("api_payload_valid")),
        check(
            "api_date_key_format", applies=F.col("bad_keys") > 0, passed=False, observed=F.col("bad_keys"),
            threshold=0.0, failed=F.col("bad_keys"), details=_message("api_date_key_format"),
        ),
        check(
            "api_freshness", applies=F.col("latest").isNotNull(), passed=fresh,
            observed=F.col("staleness"), threshold=float(max_staleness_days),
            failed=F.when(fresh, 0).otherwise(1), details=F.struct(F.col("latest").alias("latest_api_date")),
        ),
    ]


def _reason_counts(rejected: Column) -> list[Column]:
    reason = F.coalesce("reject_reason", F.lit(""))
    return [F.count_if(rejected & (reason == r)).alias(f"n_{r}") for r in REASONS]


def _reason_map() -> Column:
    pairs = reduce(list.__add__, [[F.lit(r), F.col(f"n_{r}")] for r in REASONS])
    return F.map_filter(F.create_map(*pairs), lambda _, n: n > 0)


def _with_gates(summary: DataFrame, complete: Column, max_reject_ratio: float) -> DataFrame:
    """Cumulative gates: ``complete`` -> ``not_all_rejected`` -> ``accepted``."""
    valid, bad, candidates = F.col("valid_rows"), F.col("rejected_rows"), F.col("candidates")
    all_rejected = (bad > 0) & (valid == 0)
    ratio = F.when(candidates > 0, bad / candidates)
    return summary.withColumns(
        {
            "reject_ratio": ratio,
            "complete": complete,
            "not_all_rejected": complete & ~all_rejected,
            "accepted": complete
            & ~all_rejected
            & F.coalesce(ratio <= max_reject_ratio, F.lit(True)),
        }
    )


def _row_validation(applies: Column, max_reject_ratio: float) -> Column:
    bad = F.col("rejected_rows")
    return check(
        "row_validation", applies=applies, passed=bad == 0, observed=F.col("candidates"),
        threshold=max_reject_ratio, failed=bad,
        details=F.struct(
            F.col("valid_rows").alias("accepted_rows"), F.col("rejected_rows"), F.col("reasons")
        ),
    )


def _all_rejected(applies: Column) -> Column:
    return check(
        "all_candidate_rows_rejected", applies=applies, passed=False,
        observed=F.col("candidates"), failed=F.col("rejected_rows"), details=F.struct("reasons"),
    )


def _reject_ratio(applies: Column, max_reject_ratio: float) -> Column:
    return check(
        "reject_ratio_threshold", applies=applies, passed=False, observed=F.col("reject_ratio"),
        threshold=max_reject_ratio, failed=F.col("rejected_rows"), details=F.struct("reasons"),
    )


def _reconciliation(name: str, applies: Column, mode: str) -> Column:
    """Raw against curated counts: observed raw, threshold valid, passes without rejects.

    A daily load without a new row has nothing to reconcile: all its counts are 0.
    """
    valid, bad, raw = F.col("valid_rows"), F.col("rejected_rows"), F.col("raw_rows")
    nothing = (valid == 0) if mode == "daily" else F.lit(False)
    raw, bad = (F.when(nothing, 0).otherwise(c) for c in (raw, bad))
    return check(
        name, applies=applies, passed=bad == 0, observed=raw, threshold=valid, failed=bad,
        details=F.struct(
            raw.alias("raw_count"), valid.alias("valid_count"), bad.alias("rejected_count"), valid.alias("upserted_count"),
            F.lit(mode).alias("mode"), F.when(nothing, MESSAGES["reconciliation"]).alias("message"),
        ),
    )


def _message(name: str) -> Column:
    return F.struct(F.lit(MESSAGES[name]).alias("message"))
