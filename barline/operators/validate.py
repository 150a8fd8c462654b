"""Row validation: the first failing rule names the reject reason."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from barline.functions.casts import strict_date, strict_double
from barline.functions.once import with_computed

# Field names of the payload contract.
FIELDS = {
    "open": "1. open", "high": "2. high", "low": "3. low", "close": "4. close",
    "volume": "5. volume",
}


@dataclass(frozen=True)
class RunContext:
    """Lineage written with every raw row and quality result."""

    run_id: str | None = None
    dag_id: str | None = None
    task_id: str | None = None
    source: str = "alphavantage"  # fixed value: the stored label of the price API


def validate_rows(rows: DataFrame) -> DataFrame:
    """(…, source_date_key, row_json) plus typed values, ``reject_reason``, ``is_valid``.

    A value that cannot be cast is NULL. NaN is kept through the rules (it
    passes a comparison only where IEEE comparison would) and never leaves a
    valid row, since a valid row cannot hold one.
    """
    # The five casts share one lambda: written out, the generated method grows
    # past what the JVM compiles.
    names = F.array(*[F.lit(f) for f in FIELDS.values()])
    df = rows.withColumn("_f", F.from_json("row_json", "map<string,string>"))
    df = with_computed(
        df,
        {
            "trade_date": strict_date(F.col("source_date_key")),
            "_is_object": F.col("_f").isNotNull(),
            "_has_all": F.forall(names, lambda n: F.map_contains_key("_f", n)),
            "_v": F.transform(names, lambda n: strict_double(F.try_element_at("_f", n))),
        },
    )
    values = {c: F.col("_v")[i] for i, c in enumerate(FIELDS)}
    # Volume is truncated; NaN, infinite and too large ones have no bigint.
    values["volume"] = values["volume"].try_cast("bigint")
    df = df.withColumns(values)
    o, h, lo, c, v = (F.col(x) for x in ("open", "high", "low", "close", "volume"))
    nan = F.isnan
    # The smallest price is taken left to right: a NaN open hides the others,
    # a NaN elsewhere is skipped.
    infinity = F.lit(float("inf"))
    smallest = F.least(o, F.nanvl(h, infinity), F.nanvl(lo, infinity), F.nanvl(c, infinity))
    inside = lambda x: ~nan(x) & ~nan(h) & ~nan(lo) & (lo <= x) & (x <= h)
    reason = F.coalesce(
        F.when(F.col("trade_date").isNull(), "invalid_date"),
        F.when(~F.col("_is_object"), "invalid_row_type"),
        F.when(~F.col("_has_all"), "missing_fields"),
        F.when(o.isNull() | h.isNull() | lo.isNull() | c.isNull() | v.isNull(), "type_conversion_error"),
        F.when(~nan(o) & (smallest <= 0), "non_positive_price"),
        F.when(v < 0, "negative_volume"),
        F.when(~nan(h) & ~nan(lo) & (h < lo), "high_below_low"),
        F.when(~inside(o), "open_outside_high_low"),
        F.when(~inside(c), "close_outside_high_low"),
    )
    df = df.withColumn("reject_reason", reason)
    return df.withColumn("is_valid", F.col("reject_reason").isNull()).drop(
        "_f", "_v", "_is_object", "_has_all"
    )


def with_dates(rows: DataFrame) -> DataFrame:
    """Rows with their typed date alone, for what asks of no other value."""
    return with_computed(rows.drop("row_json"), {"trade_date": strict_date(F.col("source_date_key"))})


def price_records(validated: DataFrame) -> DataFrame:
    """The accepted rows in the shape of the curated table."""
    return validated.filter("is_valid").select(
        "ticker", F.col("trade_date").cast("timestamp").alias("date"),
        "open", "high", "low", "close", "volume",
    )


def raw_observations(validated: DataFrame, context: RunContext = RunContext()) -> DataFrame:
    """Every row, valid or not, with its payload and lineage.

    A payload that is not an object is stored as ``{"value": ...}``. The
    explode gives a string row as bare text, so it is quoted again here.
    """
    row = F.col("row_json")
    is_object = F.from_json(row, "map<string,string>").isNotNull()
    is_json = F.size(F.from_json(F.concat(F.lit("["), row, F.lit("]")), "array<string>")) == 1
    quoted = F.regexp_extract(F.to_json(F.struct(row.alias("v"))), r'(?s)\A\{"v":(.*)\}\z', 1)
    value = F.when(row.isNull(), "null").when(F.coalesce(is_json, F.lit(False)), row).otherwise(quoted)
    payload = F.when(is_object, row).otherwise(F.concat(F.lit('{"value":'), value, F.lit("}")))
    clean = lambda c: F.when(~F.isnan(c), F.col(c)).alias(c)
    return validated.select(
        "ticker", "source_date_key", "trade_date",
        clean("open"), clean("high"), clean("low"), clean("close"), "volume",
        payload.alias("raw_payload"), "is_valid", "reject_reason",
        F.lit(context.source).alias("source"),
        F.lit(context.dag_id).cast("string").alias("dag_id"),
        F.lit(context.task_id).cast("string").alias("task_id"),
        F.lit(context.run_id).cast("string").alias("run_id"),
    )


def reject_counts(validated: DataFrame) -> DataFrame:
    """Rejected rows by ticker and reason."""
    return (
        validated.filter("NOT is_valid")
        .groupBy("ticker", "reject_reason")
        .agg(F.count(F.lit(1)).alias("rejected"))
    )
