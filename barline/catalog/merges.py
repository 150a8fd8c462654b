"""Keyed merges between stored and new rows.

Stored and new rows overlap, differ and miss each other by construction:
targets leave out some days, sources change values on others.
"""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from barline import schemas
from barline.catalog.features import all_features, digits, rounded_columns, stored_features
from barline.catalog.registry import query, rounded
from barline.catalog.views import sql
from barline.operators.merge import coalesce_merge, dedup_source, duplicate_keys, replace_by_key, upsert
from barline.plans.maintenance import fill_latest_actuals
from barline.sources import fixtures

T0, T1 = "2001-01-01 00:00:00", "2001-11-05 06:00:00"


def _at(text):
    return F.lit(text).cast("timestamp")


def _day():
    return F.unix_date("date")


_DAY = "date_diff('day', DATE '1970-01-01', date)"


@query(
    "upsert_prices",
    sql(
        f"""SELECT ticker, CAST(date AS TIMESTAMP) AS date,
            CASE WHEN {_DAY} % 2 = 0 THEN open + 1 ELSE open END AS open,
            CASE WHEN {_DAY} % 2 = 0 THEN high + 1 ELSE high END AS high,
            low, close, volume,
            CASE WHEN {_DAY} % 3 <> 0 THEN TIMESTAMP '{T0}' ELSE TIMESTAMP '{T1}' END AS created_at,
            CASE WHEN {_DAY} % 2 = 0 THEN TIMESTAMP '{T1}' ELSE TIMESTAMP '{T0}' END AS updated_at
        FROM bars WHERE {_DAY} % 3 <> 0 OR {_DAY} % 2 = 0""",
        "bars",
    ),
)
def upsert_prices(spark, folder):
    bars = fixtures.bars(spark, folder)
    columns = ["ticker", F.col("date").cast("timestamp").alias("date"), "open", "high", "low", "close", "volume"]
    target = bars.filter(_day() % 3 != 0).select(
        *columns, _at(T0).alias("created_at"), _at(T0).alias("updated_at")
    )
    source = bars.filter(_day() % 2 == 0).select(*columns)
    source = source.withColumns({"open": F.col("open") + 1, "high": F.col("high") + 1})
    now = _at(T1)
    return upsert(
        target, source, schemas.KEYS["prices"],
        touch={"updated_at": now}, on_insert={"created_at": now, "updated_at": now},
    )


@query(
    "upsert_raw",
    sql(
        f"""SELECT ticker, source_date_key, run_id, is_valid, reject_reason, ingested_at FROM (
            SELECT ticker, source_date_key, CASE WHEN key % 4 <> 0 THEN 'run-1' END AS run_id,
                is_valid, reject_reason, TIMESTAMP '{T1}' AS ingested_at
            FROM validated_entries WHERE length(source_date_key) <> 10
            UNION ALL
            SELECT ticker, source_date_key, CASE WHEN key % 4 <> 0 THEN 'run-1' END,
                CASE WHEN key % 4 <> 0 AND length(source_date_key) <> 10 THEN NULL ELSE false END,
                CASE WHEN key % 4 <> 0 AND length(source_date_key) <> 10 THEN NULL ELSE 'old' END,
                TIMESTAMP '{T0}'
            FROM validated_entries WHERE key % 4 = 0 OR length(source_date_key) = 10)""",
        "validated_entries",
    ),
)
def upsert_raw(spark, folder):
    """Rows with a run id are replaced, rows without one never match and are added."""
    from barline.operators.validate import validate_rows
    from barline.sources.payload import explode_series, parse

    rows = validate_rows(explode_series(parse(fixtures.payload_docs(spark, folder))))
    run = F.when(F.col("key") % 4 != 0, "run-1")
    keyed = rows.select(
        "ticker", "source_date_key", run.alias("run_id"), "is_valid", "reject_reason"
    )
    target = keyed.withColumns(
        {"is_valid": F.lit(False), "reject_reason": F.lit("old"), "ingested_at": _at(T0)}
    )
    source = keyed.filter(F.length("source_date_key") != 10)
    now = _at(T1)
    return upsert(
        target, source, schemas.KEYS["raw_prices"],
        touch={"ingested_at": now}, on_insert={"ingested_at": now},
    )


_FEATURES = list(schemas.FEATURE_COLUMNS)


@query(
    "upsert_features",
    sql(
        "SELECT ticker, date, "
        + ", ".join(
            f"CASE WHEN {_DAY} % 2 = 0 THEN {c} ELSE -1e0 END AS {c}" for c in _FEATURES
        )
        + f" FROM (SELECT ticker, date, {rounded_columns(_FEATURES)} FROM features)"
        + f" WHERE {_DAY} % 2 = 0 OR {_DAY} % 3 = 0",
        "features",
    ),
)
def upsert_features(spark, folder):
    features = stored_features(spark, folder)
    stale = {c: F.lit(-1.0) for c in _FEATURES}
    target = features.filter(_day() % 3 == 0).withColumns(stale)
    source = rounded(features.filter(_day() % 2 == 0), digits(_FEATURES))
    return upsert(target, source, schemas.KEYS["features"])


_PREDICTED = "date_diff('day', DATE '1970-01-01', predicted_date)"


def _predicted_day():
    return F.unix_date("predicted_date")


@query(
    "coalesce_merge_predictions",
    sql(
        f"""SELECT ticker, predicted_date,
            CASE WHEN {_PREDICTED} % 5 = 0 OR {_PREDICTED} % 4 = 0 THEN predicted_close + 5 ELSE predicted_close END
                AS predicted_close,
            coalesce(CASE WHEN {_PREDICTED} % 5 <> 0 THEN actual_close END, 7e0) AS actual_close,
            CASE WHEN {_PREDICTED} % 5 = 0 THEN 'new' ELSE model_version END AS model_version
        FROM predictions
        WHERE {_PREDICTED} % 2 = 0
        UNION ALL
        SELECT ticker, predicted_date,
            CASE WHEN {_PREDICTED} % 4 <> 0 THEN predicted_close END, actual_close, model_version
        FROM predictions WHERE {_PREDICTED} % 2 <> 0 AND {_PREDICTED} % 5 <> 0""",
        "predictions",
    ),
)
def coalesce_merge_predictions(spark, folder):
    """Stored values stay; only their NULLs are filled and new keys added."""
    stored = fixtures.predictions(spark, folder).drop("based_on_date")
    target = stored.filter(_predicted_day() % 5 != 0).withColumn(
        "predicted_close", F.when(_predicted_day() % 4 != 0, F.col("predicted_close"))
    )
    source = stored.filter(_predicted_day() % 2 == 0).select(
        "ticker", "predicted_date", (F.col("predicted_close") + 5).alias("predicted_close"),
        F.lit(7.0).alias("actual_close"), F.lit("new").alias("model_version"),
    )
    return coalesce_merge(target, source, schemas.KEYS["predictions"])


@query(
    "replace_predictions",
    sql(
        f"""SELECT ticker, predicted_date, predicted_close,
            CASE WHEN {_PREDICTED} % 6 <> 0 THEN actual_close END AS actual_close,
            CASE WHEN {_PREDICTED} % 6 = 0 THEN 'rerun' ELSE model_version END AS model_version
        FROM predictions""",
        "predictions",
    ),
)
def replace_predictions(spark, folder):
    """A rerun replaces its rows whole, so a known actual is lost with them."""
    stored = fixtures.predictions(spark, folder).drop("based_on_date")
    source = stored.filter(_predicted_day() % 6 == 0).select(
        "ticker", "predicted_date", "predicted_close", F.lit("rerun").alias("model_version")
    )
    return replace_by_key(stored, source, schemas.KEYS["predictions"])


@query(
    "backfill_actuals",
    sql(
        """SELECT p.ticker, p.predicted_date, p.predicted_close,
            CASE WHEN p.actual_close IS NULL AND p.predicted_date = l.latest THEN b.close
                 ELSE p.actual_close END AS actual_close, p.model_version
        FROM predictions p
        LEFT JOIN (SELECT ticker, max(date) AS latest FROM features GROUP BY ticker) l USING (ticker)
        LEFT JOIN bars b ON b.ticker = p.ticker AND b.date = p.predicted_date""",
        "predictions", "features",
    ),
)
def backfill_actuals(spark, folder):
    return fill_latest_actuals(
        fixtures.predictions(spark, folder).drop("based_on_date"),
        all_features(spark, folder),
        fixtures.bars(spark, folder),
    )


@query(
    "upsert_model_metadata",
    sql(
        f"""SELECT ticker, model_version, TIMESTAMP '{T1}' AS trained_at, min(predicted_date) AS training_start,
            max(predicted_date) AS training_end, count(*) AS runs, 'again' AS notes, TIMESTAMP '{T0}' AS created_at
        FROM predictions WHERE right(model_version, 4) = '2001' GROUP BY ticker, model_version
        UNION ALL
        SELECT ticker, model_version, TIMESTAMP '{T0}', min(predicted_date), max(predicted_date), count(*),
            'first', TIMESTAMP '{T0}'
        FROM predictions WHERE right(model_version, 4) <> '2001' GROUP BY ticker, model_version""",
        "predictions",
    ),
)
def upsert_model_metadata(spark, folder):
    """Models of the last year are registered again; their creation time stays."""
    models = fixtures.predictions(spark, folder).groupBy("ticker", "model_version").agg(
        F.min("predicted_date").alias("training_start"), F.max("predicted_date").alias("training_end"),
        F.count(F.lit(1)).alias("runs"),
    )
    target = models.withColumns(
        {"trained_at": _at(T0), "notes": F.lit("first"), "created_at": _at(T0)}
    )
    source = models.filter(F.endswith("model_version", F.lit("2001"))).withColumns(
        {"trained_at": _at(T1), "notes": F.lit("again")}
    )
    return upsert(
        target, source, schemas.KEYS["model_metadata"], on_insert={"created_at": _at(T1)}
    )


@query(
    "conform_schema",
    sql(
        """SELECT ticker, date, close, NULL::DOUBLE AS open, CAST(volume AS DOUBLE) AS volume_sma_20,
            NULL::DOUBLE AS bb_width FROM bars""",
        "bars",
    ),
)
def conform_schema(spark, folder):
    """An older, differently typed table read with today's feature schema."""
    old = fixtures.bars(spark, folder).select(
        "volume", F.col("date").cast("string").alias("date"), F.col("close").cast("string").alias("close"), "ticker"
    ).withColumnRenamed("volume", "volume_sma_20")
    # `open` is a column that the schema has and the old table lacks.
    today = T.StructType([*schemas.FEATURES.fields, schemas.PRICES["open"]])
    return schemas.conform(old, today).select("ticker", "date", "close", "open", "volume_sma_20", "bb_width")


@query(
    "dedup_source_key",
    sql(
        """SELECT ticker, date, l_orderkey, l_linenumber, l_extendedprice FROM (
            SELECT 'S' || l_suppkey AS ticker, CAST(l_shipdate AS DATE) AS date, l_orderkey, l_linenumber,
                l_extendedprice, row_number() OVER (PARTITION BY l_suppkey, CAST(l_shipdate AS DATE)
                ORDER BY l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC) AS n FROM lineitem) WHERE n = 1"""
    ),
)
def dedup_source_key(spark, folder):
    """Order lines as competing rows of one key; the last line stays."""
    return dedup_source(_lines(spark, folder), ["ticker", "date"], [F.col("l_orderkey"), F.col("l_linenumber")])


@query(
    "dq_source_key_unique",
    sql(
        """SELECT 'S' || l_suppkey AS ticker, CAST(l_shipdate AS DATE) AS date, count(*) AS copies
        FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE) HAVING count(*) > 1"""
    ),
)
def dq_source_key_unique(spark, folder):
    return duplicate_keys(_lines(spark, folder), ["ticker", "date"])


def _lines(spark, folder):
    return fixtures.table(spark, folder, "lineitem").select(
        F.concat(F.lit("S"), F.col("l_suppkey")).alias("ticker"), F.to_date("l_shipdate").alias("date"),
        "l_orderkey", "l_linenumber", "l_extendedprice",
    )
