"""Whole jobs on stored tables, and the streams."""

import datetime as dt
import json
import os
import re

import pytest
from pyspark.sql import functions as F

from barline import schemas
from barline.operators import quality
from barline.operators.indicators import stock_features
from barline.operators.merge import upsert
from barline.operators.validate import RunContext
from barline.plans import jobs, maintenance
from barline.session import scratch_folder
from barline.sources import payload
from barline.sources.tables import KeyedTable, stage
from barline.streaming.features import stream_features
from barline.streaming.ingest import gather_stream, ingest_stream, read_documents, read_payload_files
from tests.test_indicators import assert_same, frame, got, series, walk


def document(days_closes):
    rows = {
        str(d): {"1. open": f"{c}", "2. high": f"{c + 1}", "3. low": f"{c - 1}", "4. close": f"{c}", "5. volume": "100"}
        for d, c in days_closes
    }
    return json.dumps({"Time Series (Daily)": rows})


def weekdays(start, n):
    out, d = [], start
    while len(out) < n:
        if d.weekday() < 5:
            out.append(d)
        d += dt.timedelta(days=1)
    return out


DAYS = weekdays(dt.date(2024, 1, 1), 130)


def docs(spark, first, last):
    data = [
        (t, document([(d, round(50 + float(c), 4)) for d, c in zip(DAYS, walk(130, seed))][first:last]))
        for t, seed in (("A", 1), ("B", 2))
    ]
    return spark.createDataFrame(data, "ticker string, doc string")


def snapshot(table, spark, drop):
    return sorted(map(str, table.read(spark).drop(*drop).collect()))


@pytest.fixture(scope="module")
def store(spark):
    store = jobs.Store(scratch_folder(spark, "test-store"))
    jobs.ingest_backfill(spark, store, docs(spark, 0, 100), RunContext("run-1", "load", "backfill"))
    return store


def test_daily_equals_full_load_and_rerun_changes_nothing(spark, store):
    as_of = F.lit(str(DAYS[-1])).cast("date")
    jobs.ingest_daily(spark, store, docs(spark, 60, 130), as_of, RunContext("run-2", "load", "daily"))
    assert store.prices.read(spark).count() == 260

    def upserted():
        rows = quality.read_results(spark, store.quality).filter("check_name = 'rows_upserted' AND run_id = 'run-2'")
        return [r.observed_value for r in rows.collect()]

    assert upserted() == [30.0, 30.0]
    once = [snapshot(t, spark, ["updated_at", "ingested_at", "created_at"]) for t in (store.prices, store.raw, store.features)]
    jobs.ingest_daily(spark, store, docs(spark, 60, 130), as_of, RunContext("run-2", "load", "daily"))
    again = [snapshot(t, spark, ["updated_at", "ingested_at", "created_at"]) for t in (store.prices, store.raw, store.features)]
    assert once == again
    whole = stock_features(store.prices.read(spark))
    assert_same(got(store.features.read(spark)), got(whole))
    assert quality.read_results(spark, store.quality).filter("status = 'fail'").count() == 0
    # The run's rows are those of its last execution, which found nothing new.
    assert upserted() == [0.0, 0.0]


def test_a_new_day_reads_no_history(spark, monkeypatch):
    """A load after the last stored day reads the periods it writes, and of the rest one row per ticker."""
    store = jobs.Store(scratch_folder(spark, "test-new-day"))
    jobs.ingest_backfill(spark, store, docs(spark, 0, 120), RunContext("run-1", "load", "backfill"))
    reads, read = [], KeyedTable.read

    def noted(table, session, periods=None):
        reads.append((table.path.rsplit("/", 1)[1], periods))
        return read(table, session, periods)

    monkeypatch.setattr(KeyedTable, "read", noted)
    as_of = F.lit(str(DAYS[129])).cast("date")
    jobs.ingest_daily(spark, store, docs(spark, 120, 130), as_of, RunContext("run-2", "load", "daily"))
    touched = sorted({str(d)[:7] for d in DAYS[120:130]})
    assert {name for name, periods in reads if periods is None} == {"series"}
    assert all(set(periods) <= set(touched) for name, periods in reads if name in ("prices", "raw_prices", "features"))
    monkeypatch.undo()
    assert_same(got(store.features.read(spark)), got(stock_features(store.prices.read(spark))))
    row = {r.ticker: r for r in store.series.read(spark).collect()}["A"]
    assert (row.state.rows, row.state.last_date, row.feature_last) == (130, DAYS[129], DAYS[129])
    assert row.feature_rows == store.features.read(spark).filter("ticker = 'A'").count()
    plan = store.features.read(spark, touched)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*period#", plan)


def test_train_predict_maintain(spark, store):
    at = F.lit("2024-07-01 06:00:00").cast("timestamp")
    jobs.train(spark, store, at)
    models = store.models.read(spark).collect()
    assert {m["model_version"] for m in models} == {"A_v20240701T060000", "B_v20240701T060000"}
    assert all(m["mae"] > 0 and m["training_end"] == DAYS[-1] for m in models)
    jobs.predict(spark, store)
    jobs.predict(spark, store)
    assert store.predictions.read(spark).count() == 2
    metrics = {m["ticker"]: m for m in jobs.maintain(spark, store).collect()}
    assert metrics["A"]["records"] == metrics["A"]["recent_rows"] + metrics["A"]["gap_rows"] + 1
    stored = store.predictions.read(spark)
    assert stored.filter("predicted_close IS NULL").count() == 0
    assert stored.groupBy("ticker", "predicted_date").count().filter("count > 1").count() == 0
    repeat = {m["ticker"]: m["records"] for m in jobs.maintain(spark, store).collect()}
    assert repeat == {"A": 1, "B": 1}  # only the row whose actual is still unknown


def test_maintenance_reads_what_is_open_only(spark, monkeypatch):
    """The second run reads the last months; both find what the whole tables would give, also after a late bar."""
    store = jobs.Store(scratch_folder(spark, "test-open"))
    jobs.ingest_backfill(spark, store, docs(spark, 0, 115), RunContext("run-1"))
    jobs.train(spark, store, F.lit("2024-06-20 06:00:00").cast("timestamp"))

    def whole():
        gaps = maintenance.prediction_gaps(store.features.read(spark), store.predictions.read(spark), store.prices.read(spark))
        current = store.current_model(spark)
        records = maintenance.prediction_records(gaps, current, current.drop("lo_close", "hi_close"))
        return sorted(map(str, maintenance.maintenance_report(store.features.read(spark), current, records).collect()))

    reads, read = [], KeyedTable.read

    def noted(table, session, periods=None):
        reads.append((table.path.rsplit("/", 1)[1], periods))
        return read(table, session, periods)

    def maintained():
        want = whole()
        reads.clear()
        monkeypatch.setattr(KeyedTable, "read", noted)
        got_ = sorted(map(str, jobs.maintain(spark, store).collect()))
        monkeypatch.undo()
        assert got_ == want
        return {p for name, periods in reads if name in ("features", "prices") for p in periods}

    assert len(maintained()) > 4
    as_of = F.lit(str(DAYS[129])).cast("date")
    jobs.ingest_daily(spark, store, docs(spark, 115, 130), as_of, RunContext("run-2"))
    assert maintained() <= {"2024-06", "2024-07"}
    settled = {r.ticker: r.settled_until for r in store.series.read(spark).collect()}
    assert all(DAYS[126] < d < DAYS[129] for d in settled.values())
    late = store.prices.read(spark).filter("ticker = 'A' AND date = DATE'2024-05-14'").withColumn("close", F.col("close") + 1)
    jobs.store_prices(spark, store, stage(late, "late"), RunContext("run-3"))
    settled = {r.ticker: r.settled_until for r in store.series.read(spark).collect()}
    assert settled["A"] == dt.date(2024, 5, 13) and settled["B"] > DAYS[126]
    maintained()


def test_a_load_leaves_no_staged_copy(spark):
    """What a load writes aside is deleted when it is merged; only the store stays, also after late bars."""
    base = scratch_folder(spark, "test-leftovers")
    before = set(os.listdir(os.path.dirname(base)))
    store = jobs.Store(f"{base}/store", grain="yyyy")
    for k, part in enumerate(((0, 60), (50, 80))):
        jobs.ingest_backfill(spark, store, docs(spark, *part), RunContext(f"run-{k}"))
    as_of = F.lit(str(DAYS[99])).cast("date")
    jobs.ingest_daily(spark, store, docs(spark, 70, 100), as_of, RunContext("run-2"))
    left = [f for f in set(os.listdir(os.path.dirname(base))) - before if os.listdir(f"{os.path.dirname(base)}/{f}")]
    assert left == []
    assert_same(got(store.features.read(spark)), got(stock_features(store.prices.read(spark))))


def test_rebuild_features(spark, store):
    before = snapshot(store.features, spark, [])
    jobs.rebuild_features(spark, store, RunContext("run-3"))
    assert len(snapshot(store.features, spark, [])) == len(before)


def test_quality_log_failure_only_warns(spark):
    row = quality.exception_row(spark, "feature_engineering_exception", "A", ValueError("boom"))
    assert json.loads(row.first()["details"]) == {"error": "boom"}
    stored = quality.with_context(row, RunContext("r", "d", "t"))
    assert not quality.store_results(stored, "unknown-scheme://nowhere/x", "load")
    path = scratch_folder(spark, "quality")
    for part in ("load", "load", "other"):  # the same part again replaces its rows
        assert quality.store_results(stored, path, part)
    assert quality.read_results(spark, path).count() == 2
    assert quality.read_results(spark, path).columns == [f.name for f in schemas.QUALITY_RESULTS]


def test_a_job_that_dies_says_so(spark):
    store = jobs.Store(scratch_folder(spark, "test-dies"))
    broken = docs(spark, 0, 60).withColumn("doc", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        jobs.ingest_backfill(spark, store, broken, RunContext("run-x", "load", "backfill"))
    rows = quality.read_results(spark, store.quality).collect()
    assert [(r.check_name, r.status, r.run_id, "boom" in r.details) for r in rows] == [
        ("backfill_ingestion_exception", "fail", "run-x", True)
    ]


def test_models_of_their_time(spark):
    """Training adds versions; a forecast takes the latest one known at its time."""
    store = jobs.Store(scratch_folder(spark, "test-models"))
    jobs.ingest_backfill(spark, store, docs(spark, 0, 100), RunContext("run-1"))
    at = lambda text: F.lit(text).cast("timestamp")
    jobs.train(spark, store, at("2024-05-20 06:00:00"))
    only_a = docs(spark, 100, 130).filter("ticker = 'A'")
    jobs.ingest_daily(spark, store, only_a, F.lit(str(DAYS[-1])).cast("date"), RunContext("run-2"))
    late = store.fitted.read(spark).filter("ticker = 'A'").withColumns(
        {"trained_at": at("2024-07-01 06:00:00"), "model_version": F.lit("A_v2"), "slope": F.lit(0.0), "intercept": F.lit(0.5)}
    )
    store.fitted.merge(stage(late, "late"), lambda t, s, k: upsert(t, s, k))
    now = {r.ticker: r.model_version for r in store.current_model(spark).collect()}
    assert now == {"A": "A_v2", "B": "B_v20240520T060000"}
    jobs.predict(spark, store, at("2024-06-01 00:00:00"))
    assert {r.model_version for r in store.predictions.read(spark).collect()} == {"A_v20240520T060000", "B_v20240520T060000"}
    jobs.predict(spark, store)
    assert {r.model_version for r in store.predictions.read(spark).collect()} == set(now.values())


def test_read_documents(spark, tmp_path):
    (tmp_path / "aa.json").write_text('{"Note":\n"x"}')
    docs_ = payload.read_documents(spark, str(tmp_path)).collect()
    assert [(r["ticker"], r["doc"]) for r in docs_] == [("AA", '{"Note":\n"x"}')]


def test_stream_equals_batch_and_replay_changes_nothing(spark):
    base = scratch_folder(spark, "test-stream")
    store = jobs.Store(f"{base}/store", grain="yyyy")
    for part in ((0, 70), (60, 130)):
        docs(spark, *part).coalesce(1).write.mode("append").parquet(f"{base}/docs")

    def run(checkpoint):
        ingest_stream(read_documents(spark, f"{base}/docs", 1), store, f"{base}/{checkpoint}").awaitTermination()

    run("c1")
    once = snapshot(store.prices, spark, ["created_at", "updated_at"])
    assert len(once) == 260
    log = sorted(map(str, quality.read_results(spark, store.quality).drop("created_at").collect()))
    run("c2")  # a lost checkpoint: everything is read again
    again = sorted(map(str, quality.read_results(spark, store.quality).drop("created_at").collect()))
    assert [r for r in again if "feature" not in r and "source_base" not in r] == [
        r for r in log if "feature" not in r and "source_base" not in r
    ]
    assert snapshot(store.prices, spark, ["created_at", "updated_at"]) == once
    whole = jobs.Store(f"{base}/whole", grain="yyyy")
    jobs.ingest_backfill(spark, whole, docs(spark, 0, 130), RunContext("r"))
    assert snapshot(whole.prices, spark, ["created_at", "updated_at"]) == once
    assert_same(got(store.features.read(spark)), got(whole.features.read(spark)))


def test_files_are_gathered_in_many_batches_and_loaded_in_one(spark, tmp_path):
    store, whole = jobs.Store(f"{tmp_path}/store", grain="yyyy"), jobs.Store(f"{tmp_path}/whole", grain="yyyy")
    data = [(f"T{i}", document([(d, 50.0 + i) for d in DAYS[:30]])) for i in range(7)]
    (tmp_path / "files").mkdir()
    for step in (data[:5], data[5:]):
        for ticker, doc in step:
            (tmp_path / "files" / f"{ticker}.json").write_text(doc)
        gather_stream(read_payload_files(spark, f"{tmp_path}/files", 2), f"{tmp_path}/docs", f"{tmp_path}/c1").awaitTermination()
        load = ingest_stream(read_documents(spark, f"{tmp_path}/docs"), store, f"{tmp_path}/c2")
        load.awaitTermination()
    assert len(os.listdir(f"{tmp_path}/c1/commits")) >= 2 * 4 and load.lastProgress["batchId"] == 1  # with a .crc each
    jobs.ingest_backfill(spark, whole, spark.createDataFrame(data, "ticker string, doc string"), RunContext("r"))
    assert snapshot(store.prices, spark, ["created_at", "updated_at"]) == snapshot(whole.prices, spark, ["created_at", "updated_at"])
    assert store.prices.read(spark).count() == 7 * 30


def test_stream_refuses_what_the_batch_refuses(spark):
    base = scratch_folder(spark, "test-stream-gate")
    good = document([(d, 50.0) for d in DAYS[:10]])
    bad = good.replace('"100"', '"-1"', 3)  # three of ten rows with a negative volume
    data = spark.createDataFrame([("GOOD", good), ("BAD", bad), ("NONE", "not json")], "ticker string, doc string")
    data.write.parquet(f"{base}/docs")
    store, whole = jobs.Store(f"{base}/store"), jobs.Store(f"{base}/whole")
    ingest_stream(read_documents(spark, f"{base}/docs"), store, f"{base}/c").awaitTermination()
    jobs.ingest_backfill(spark, whole, data, RunContext("stream"))
    times = ["created_at", "updated_at", "ingested_at"]
    for mine, theirs in ((store.prices, whole.prices), (store.raw, whole.raw)):
        assert snapshot(mine, spark, [c for c in times if c in mine.schema.names]) == snapshot(
            theirs, spark, [c for c in times if c in mine.schema.names]
        )
    assert {r[0] for r in store.prices.read(spark).select("ticker").distinct().collect()} == {"GOOD"}
    assert store.raw.read(spark).filter("ticker = 'BAD'").count() == 10
    logs = [sorted(map(str, quality.read_results(spark, s.quality).drop("created_at").collect())) for s in (store, whole)]
    for s in (store, whole):
        held = [(r.ticker, r.payload_status, r.doc) for r in spark.read.parquet(s.quarantine).collect()]
        assert held == [("NONE", "non_json", "not json")]
    assert logs[0] == logs[1] and any("reject_ratio_threshold" in r for r in logs[0])


def test_stream_features_take_late_bars_and_gaps(spark):
    base = scratch_folder(spark, "test-stream-features")
    store = jobs.Store(f"{base}/store", grain="yyyy")
    gappy = list(walk(200, 8))
    gappy[70] = None
    bars = frame(spark, series("A", gappy), series("B", walk(60, 9)))
    late = "ticker = 'A' AND date = '1990-01-05'"
    cuts = ["1990-01-01", "1990-04-01", "2000-01-01"]
    parts = [bars.filter(f"date >= '{a}' AND date < '{b}' AND NOT ({late})") for a, b in zip(cuts, cuts[1:])]
    for part in (*parts, bars.filter(late)):
        part.coalesce(1).write.mode("append").parquet(f"{base}/bars")
        arriving = spark.readStream.schema(bars.schema).parquet(f"{base}/bars")
        stream_features(arriving, store, f"{base}/c").awaitTermination()
    assert store.prices.read(spark).count() == 260
    assert_same(got(store.features.read(spark)), got(stock_features(bars)))
