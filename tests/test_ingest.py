"""Payload parsing, row rules, ingest gates."""

import json

import pytest
from pyspark.sql import functions as F

from barline.functions.calendar import business_day_sequence, business_days, next_trading_day, version_string
from barline.functions.casts import strict_date, strict_double
from barline.operators.validate import RunContext, price_records, raw_observations, validate_rows
from barline.plans import ingest
from barline.sources.payload import explode_series, gate, parse
from barline.sources.tickers import parse_tickers, ticker_list


def row(o="2", h="3", lo="1", c="2.5", v="10", **extra):
    fields = {"1. open": o, "2. high": h, "3. low": lo, "4. close": c, "5. volume": v}
    fields.update(extra)
    return json.dumps(fields)


def reasons(spark, rows):
    df = spark.createDataFrame(
        [("T", str(i), k, r) for i, (k, r) in enumerate(rows)],
        "ticker string, id string, source_date_key string, row_json string",
    )
    out = validate_rows(df).collect()
    return {int(r["id"]): r["reject_reason"] for r in out}


D = "2024-01-05"


def test_first_failing_rule_wins(spark):
    cases = [
        ((D, row()), None),
        (("2024-01-05x", '"n/a"'), "invalid_date"),
        ((D, '"n/a"'), "invalid_row_type"),
        ((D, "[1]"), "invalid_row_type"),
        ((D, None), "invalid_row_type"),
        ((D, json.dumps({"1. open": "abc"})), "missing_fields"),
        ((D, row(c="abc", o="-1")), "type_conversion_error"),
        ((D, row(o=None)), "type_conversion_error"),
        ((D, row(o="-1", v="-5")), "non_positive_price"),
        ((D, row(v="-5", h="0.5")), "negative_volume"),
        ((D, row(h="0.5", o="9")), "high_below_low"),
        ((D, row(o="9", c="9")), "open_outside_high_low"),
        ((D, row(c="9")), "close_outside_high_low"),
        ((D, row(extra="ignored")), None),
        ((D, json.dumps({"1. open": 2, "2. high": 3, "3. low": 1, "4. close": 2.5, "5. volume": 10})), None),
    ]
    found = reasons(spark, [c for c, _ in cases])
    assert found == {i: want for i, (_, want) in enumerate(cases)}


def test_not_a_number_prices(spark):
    cases = [
        (row(o="nan"), "open_outside_high_low"),
        (row(o="nan", lo="-1"), "open_outside_high_low"),
        (row(o="nan", h="1", lo="2"), "high_below_low"),
        (row(h="nan"), "open_outside_high_low"),
        (row(h="nan", lo="-1"), "non_positive_price"),
        (row(lo="nan"), "open_outside_high_low"),
        (row(c="nan"), "close_outside_high_low"),
        (row(h="inf"), None),
        (row(v="nan"), "type_conversion_error"),
        (row(v="inf"), "type_conversion_error"),
    ]
    found = reasons(spark, [(D, r) for r, _ in cases])
    assert found == {i: want for i, (_, want) in enumerate(cases)}


@pytest.mark.parametrize(
    "text, want",
    [
        (" 5 ", 5.0), ("1e3", 1000.0), ("1_000", 1000.0), ("12.9", 12.9), (".5", 0.5), ("5.", 5.0),
        ("+7", 7.0), ("\t8\n", 8.0), ("-INF", float("-inf")), ("Infinity", float("inf")),
        ("1d", None), ("1f", None), ("0x1p3", None), ("", None), ("1__0", None), ("_1", None),
        ("1 0", None), ("abc", None),
    ],
)
def test_number_texts(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(strict_double(F.col("t"))).first()[0] == want


def test_date_texts(spark):
    texts = {
        "2024-01-05": True, "2024-1-5": True, "2024-01- 5": True, "2024-02-30": False,
        "2024-01-05 ": False, "24-01-05": False, "0000-01-01": False, "2024-13-01": False,
        "2024- 1-05": False, "2024/01/05": False, "2024-01-05\n": False,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = df.select("t", strict_date(F.col("t")).isNotNull()).collect()
    assert {r[0]: r[1] for r in out} == texts


SERIES = '"Time Series (Daily)"'
DOCS = {
    "OK": '{%s:{"2024-01-05":%s,"2024-01-04":"n/a","2024-01-03":null}}' % (SERIES, row()),
    "BAD": "not json", "TAIL": '{%s:{"a":{}}} x' % SERIES, "TWO": "{} {}", "EMPTY": "",
    "QUOTE": "{'a':1}", "CUT": '{"a":1', "ARRAY": "[1]", "TEXT": '"x"', "NULL": "null",
    "ERR": '{"Error Message":"bad"}', "BOTH": '{"Note":"n","Error Message":"bad"}',
    "NOTE": '{"Note":"limit",%s:{"2024-01-05":{}}}' % SERIES,
    "NONE": "{}", "LIST": "{%s:[1]}" % SERIES, "VOID": "{%s:{}}" % SERIES, "STR": '{%s:"x"}' % SERIES,
    "FALSY": '{"Error Message":"","Note":null,%s:{"2024-01-05":{"a":"1"}}}' % SERIES,
    "TWICE": '{%s:{"k":{"a":"1"},"j":{"a":"9"},"k":{"a":"2"}}}' % SERIES,
}


@pytest.fixture(scope="module")
def parsed(spark):
    return parse(spark.createDataFrame(list(DOCS.items()), "ticker string, doc string"))


def test_payload_status(parsed):
    found = {r["ticker"]: (r["payload_status"], r["series_rows"]) for r in gate(parsed).collect()}
    assert found == {
        "OK": ("ok", 3), "BAD": ("non_json", 0), "TAIL": ("non_json", 0), "TWO": ("non_json", 0),
        "EMPTY": ("non_json", 0), "QUOTE": ("non_json", 0), "CUT": ("non_json", 0),
        "ARRAY": ("not_object", 0), "TEXT": ("not_object", 0), "NULL": ("not_object", 0),
        "ERR": ("api_error", 0), "BOTH": ("api_error", 0), "NOTE": ("rate_limit", 0),
        "NONE": ("missing_series", 0), "LIST": ("missing_series", 0), "VOID": ("missing_series", 0),
        "STR": ("missing_series", 0), "FALSY": ("ok", 1), "TWICE": ("ok", 2),
    }


def test_explode_keeps_the_last_of_repeated_keys(parsed):
    rows = explode_series(parsed).filter("ticker = 'TWICE'").collect()
    assert {r["source_date_key"]: r["row_json"] for r in rows} == {"j": '{"a":"9"}', "k": '{"a":"2"}'}


def test_raw_rows_keep_everything(spark, parsed):
    rows = validate_rows(explode_series(parsed))
    raw = raw_observations(rows, RunContext("r1", "d", "t")).collect()
    assert len(raw) == rows.count() == 6
    by = {(r["ticker"], r["source_date_key"]): r for r in raw}
    assert by["OK", "2024-01-04"]["raw_payload"] == '{"value":"n/a"}'
    assert by["OK", "2024-01-03"]["raw_payload"] == '{"value":null}'
    assert by["TWICE", "k"]["trade_date"] is None and by["TWICE", "k"]["run_id"] == "r1"
    assert json.loads(by["OK", "2024-01-05"]["raw_payload"])["5. volume"] == "10"
    assert rows.filter("is_valid").count() + rows.filter("NOT is_valid").count() == 6
    assert price_records(rows).count() == 1


def doc(days):
    return "{%s:{%s}}" % (SERIES, ",".join(f'"{k}":{r}' for k, r in days.items()))


def statuses(result):
    return {(r["ticker"], r["check_name"]): (r["status"], r["observed_value"]) for r in result.quality.collect()}


@pytest.fixture(scope="module")
def daily(spark):
    good, bad = row(), row(v="-1")
    week = [f"2024-01-{d:02d}" for d in (8, 9, 10, 11, 12)]
    docs = {
        "FULL": doc({k: good for k in week}),
        "STALE": doc({"2023-12-01": good}),
        "SPARSE": doc({week[0]: good, week[4]: good}),
        "REJECTED": doc({k: bad for k in week}),
        "MANY": doc({**{k: good for k in week[:3]}, **{k: bad for k in week[3:]}}),
        "OLD": doc({"2024-01-05": good}),
        "KEYS": doc({**{k: good for k in week}, "x": good}),
        "ERROR": '{"Note":"limit"}',
    }
    stored = spark.createDataFrame(
        [(t, "2024-01-05") for t in docs], "ticker string, date string"
    ).withColumn("date", F.col("date").cast("timestamp"))
    frame = spark.createDataFrame(list(docs.items()), "ticker string, doc string")
    return ingest.daily(frame, stored, F.lit("2024-01-15").cast("date"), max_staleness_days=10)


def test_daily_gates_in_order(daily):
    s = statuses(daily)
    assert s["FULL", "incremental_completeness"] == ("pass", 1.0)
    assert s["FULL", "rows_upserted"] == ("pass", 5.0)
    assert s["FULL", "daily_reconciliation"] == ("pass", 5.0)
    assert s["STALE", "api_freshness"] == ("fail", 45.0)
    assert ("STALE", "rows_upserted") not in s and ("STALE", "raw_rows_written") not in s
    assert s["SPARSE", "incremental_completeness"] == ("fail", 0.4)
    assert ("SPARSE", "raw_rows_written") not in s
    assert s["REJECTED", "row_validation"] == ("fail", 5.0)
    assert s["REJECTED", "all_candidate_rows_rejected"] == ("fail", 5.0)
    assert ("REJECTED", "reject_ratio_threshold") not in s
    assert s["MANY", "reject_ratio_threshold"] == ("fail", 0.4)
    assert ("OLD", "incremental_completeness") not in s
    assert s["OLD", "rows_upserted"] == ("pass", 0.0)
    assert s["OLD", "daily_reconciliation"] == ("pass", 0.0)
    assert s["KEYS", "api_date_key_format"] == ("fail", 1.0)
    assert s["KEYS", "daily_reconciliation"] == ("fail", 5.0)
    assert not [k for k in s if k[0] == "ERROR"]


def test_key_checks_validate_no_row(spark, daily):
    """The checks of the date keys are those of the whole load, from a plan that looks into no row."""
    good, week = row(), [f"2024-01-{d:02d}" for d in (8, 9, 10, 11, 12)]
    docs = {
        "FULL": doc({k: good for k in week}), "STALE": doc({"2023-12-01": good}), "NONE": doc({"x": good}),
        "KEYS": doc({**{k: row(v="-1") for k in week}, "x": good}), "ERROR": '{"Note":"limit"}',
    }
    frame = spark.createDataFrame([*docs.items(), ("FULL", docs["KEYS"]), (None, docs["FULL"])], "ticker string, doc string")
    stored = spark.createDataFrame([("FULL", None)], "ticker string, date timestamp")
    as_of = F.lit("2024-01-20").cast("date")
    found = ingest.key_checks(frame, as_of)
    names = [r[0] for r in found.select("check_name").distinct().collect()]
    assert sorted(names) == ["api_date_key_format", "api_freshness", "api_payload_valid"]
    whole = ingest.daily(frame, stored, as_of).quality.filter(F.col("check_name").isin(names))
    assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect()))
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "1. open" in plan(whole) and "1. open" not in plan(found)


def test_daily_rows(daily):
    raw = {r["ticker"]: r["count"] for r in daily.raw.groupBy("ticker").count().collect()}
    assert raw == {"FULL": 5, "REJECTED": 5, "MANY": 5, "KEYS": 5}
    prices = {r["ticker"]: r["count"] for r in daily.prices.groupBy("ticker").count().collect()}
    assert prices == {"FULL": 5, "KEYS": 5}


def test_backfill_keeps_unreadable_dates_raw(spark):
    docs = spark.createDataFrame(
        [("A", doc({**{f"2024-01-{d:02d}": row() for d in range(1, 6)}, "x": row()})), ("B", "[]")],
        "ticker string, doc string",
    )
    load = ingest.backfill(docs)
    assert load.raw.filter("trade_date IS NULL").count() == 1
    s = statuses(load)
    assert s["A", "backfill_reconciliation"] == ("fail", 6.0)
    assert s["B", "backfill_ingestion_exception"] == ("fail", None)
    assert load.prices.count() == 5


def test_first_run_mark(spark):
    tickers = spark.createDataFrame([("A",), ("B",)], "ticker string")
    stored = spark.createDataFrame([("A", "2024-01-05")], "ticker string, date string")
    marks = ingest.high_water_mark(tickers, stored, F.lit("2024-04-09").cast("date")).collect()
    assert {r["ticker"]: str(r["last_date"]) for r in marks} == {"A": "2024-01-05", "B": "2024-01-01"}


def test_calendar(spark):
    df = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-01-07')) AS d")
    nexts = [str(r[0]) for r in df.orderBy("d").select(next_trading_day(F.col("d"))).collect()]
    assert nexts == ["2024-01-02", "2024-01-03", "2024-01-04", "2024-01-05"] + ["2024-01-08"] * 3
    pairs = df.alias("a").join(df.alias("b"), F.col("a.d") <= F.date_add(F.col("b.d"), 2))
    both = pairs.select(
        business_days(F.col("a.d"), F.col("b.d")).alias("n"),
        F.size(business_day_sequence(F.col("a.d"), F.col("b.d"))).alias("m"),
    ).collect()
    assert len(both) > 28 and all(r["n"] == r["m"] for r in both)
    version = spark.range(1).select(
        version_string(F.lit("A"), F.lit("2024-01-02 03:04:05").cast("timestamp"))
    )
    assert version.first()[0] == "A_v20240102T030405"


def test_ticker_lists(spark):
    assert parse_tickers(" a, b,,") == ["A", "B"]
    assert parse_tickers(" , ", ["Z"]) == parse_tickers(None, ["Z"]) == ["Z"]
    df = spark.createDataFrame([(" a, b,,",), ("B",)], "t string")
    assert {r[0] for r in ticker_list(df, "t").collect()} == {"A", "B"}
    assert [r[0] for r in ticker_list(df.limit(0).union(df.selectExpr("' ,' AS t").limit(1)), "t", ["Z"]).collect()] == ["Z"]
