"""Price-series views derived from the TPC-H-like test tables.

Each view has the shape of one table the engine works on (see FIXTURES.md).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

AS_OF = "2001-11-05"
STORED_BEFORE = "2000-01-01"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bars(spark: SparkSession, folder: str) -> DataFrame:
    """One OHLCV bar per (supplier, ship date).

    First and last price follow the line order (order, line, price). The order
    is packed into one decimal because a struct-valued `min_by` would sort
    before aggregating; with the decimal it is a hash aggregate, combined
    before the shuffle.
    """
    line = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("decimal(15,0)")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("decimal(10,0)")
    return (
        table(spark, folder, "lineitem")
        .select(
            F.col("l_suppkey").alias("key"),
            F.to_date("l_shipdate").alias("date"),
            F.col("l_extendedprice").alias("px"),
            "l_quantity",
            (line * F.lit(10**10).cast("decimal(11,0)") + cents).alias("k"),
        )
        .groupBy("key", "date")
        .agg(
            F.min_by("px", "k").alias("open"),
            F.max("px").alias("high"),
            F.min("px").alias("low"),
            F.max_by("px", "k").alias("close"),
            F.sum("l_quantity").cast("bigint").alias("volume"),
        )
        .select(F.concat(F.lit("S"), F.col("key")).alias("ticker"), "*")
    )


def payload(spark: SparkSession, folder: str) -> DataFrame:
    """One API row per bar, with a fixed share of every kind of defect."""
    day = F.unix_date("date")
    share = F.when(F.col("key") % 10 == 9, 29).otherwise(101)
    df = bars(spark, folder).withColumn("m", (day * 31 + F.col("key")) % share)
    m = F.col("m")
    num = lambda c: F.format_string("%.4f", c)
    open_ = F.when(m == 3, "-1").when(m == 4, num(F.col("high") + 1)).otherwise(num(F.col("open")))
    high = F.when(m == 5, num(F.col("low") / 2)).otherwise(num(F.col("high")))
    close = F.when(m == 6, "abc").when(m == 7, num(F.col("high") + 1)).otherwise(num(F.col("close")))
    volume = F.when(m == 9, "-5").otherwise(F.col("volume").cast("string"))
    field = lambda name, v: F.concat(F.lit(f'"{name}":"'), v, F.lit('"'))
    head = F.concat_ws(
        ",", field("1. open", open_), field("2. high", high),
        field("3. low", num(F.col("low"))), field("4. close", close),
    )
    tail = F.when(m == 8, F.lit("")).otherwise(F.concat(F.lit(","), field("5. volume", volume)))
    row = F.when(m == 2, F.lit('"n/a"')).otherwise(F.concat(F.lit("{"), head, tail, F.lit("}")))
    iso = F.date_format("date", "yyyy-MM-dd")
    key = (
        F.when(m == 0, F.concat(iso, F.lit("x")))
        .when(m == 1, F.date_format("date", "yyyy-M-d"))
        .otherwise(iso)
    )
    return df.select("ticker", "key", "date", "m", key.alias("source_date_key"), row.alias("row_json"))


def payload_docs(spark: SparkSession, folder: str) -> DataFrame:
    """One JSON document per ticker, as the price API returns it.

    A document holds one entry per day of the table's calendar at most.
    """
    item = F.concat(F.lit('"'), F.col("source_date_key"), F.lit('":'), F.col("row_json"))
    series = F.array_join(F.sort_array(F.collect_list(item)), ",")
    docs = payload(spark, folder).groupBy("ticker", "key").agg(series.alias("s"))
    kind = F.col("key") % 25
    good = F.concat(F.lit('{"Time Series (Daily)":{'), F.col("s"), F.lit("}}"))
    empty_error = F.concat(
        F.lit('{"Error Message":"", "Time Series (Daily)":{'), F.col("s"), F.lit("}}")
    )
    doc = (
        F.when(kind == 7, '{"Error Message":"bad symbol"}')
        .when(kind == 8, '{"Note":"limit"}')
        .when(kind == 9, "not json")
        .when(kind == 10, "[1]")
        .when(kind == 11, '{"Time Series (Daily)":{}}')
        .when(kind == 12, empty_error)
        .otherwise(good)
    )
    return docs.select("ticker", "key", doc.alias("doc"))


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Naive forecasts (the previous close) with some actuals still unknown.

    The plain window is safe here: bars hold one row per ticker and day, however
    many order lines a supplier has.
    """
    w = Window.partitionBy("ticker").orderBy("date")
    day = F.unix_date("date")
    unknown = F.lead("date").over(w).isNull() | ((day * 31 + F.col("key")) % 13 == 0)
    return (
        bars(spark, folder)
        .select(
            "ticker",
            F.lag("date").over(w).alias("based_on_date"),
            F.col("date").alias("predicted_date"),
            F.lag("close").over(w).alias("predicted_close"),
            F.when(~unknown, F.col("close")).alias("actual_close"),
            F.concat("ticker", F.lit("_v"), F.year("date")).alias("model_version"),
        )
        .filter("based_on_date IS NOT NULL")
    )


def stored_prices(spark: SparkSession, folder: str) -> DataFrame:
    """What an earlier run stored; every tenth ticker has no history."""
    return bars(spark, folder).filter(
        (F.col("date") < F.lit(STORED_BEFORE).cast("date")) & (F.col("key") % 10 != 3)
    )


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    state = F.when(F.col("user_id") % 10 == 0, "failed").when(F.col("user_id") % 10 == 1, "running")
    return table(spark, folder, "events").select(
        F.col("event_type").alias("dag_id"), state.otherwise("success").alias("state")
    )
