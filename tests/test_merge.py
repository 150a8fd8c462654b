"""Merge functions and the stored table."""

import datetime as dt
import re

from pyspark.sql import functions as F

from barline import schemas
from barline.operators.merge import (
    coalesce_merge, dedup_source, duplicate_keys, fill_from, replace_by_key, upsert,
)
from barline.session import scratch_folder
from barline.sources.tables import KeyedTable

KEY = ["k"]
T = "k int, a double, b double, made string"
S = "k int, a double, b double"


def rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((x is not None, x) for x in r))


def frames(spark):
    target = spark.createDataFrame([(1, 1.0, None, "t"), (2, 2.0, 2.0, "t"), (None, 9.0, 9.0, "t")], T)
    source = spark.createDataFrame([(2, 20.0, None), (3, 30.0, 3.0), (None, 8.0, 8.0)], S)
    return target, source


def test_upsert(spark):
    target, source = frames(spark)
    merged = upsert(target, source, KEY, on_insert={"made": F.lit("s")})
    assert rows(merged) == rows(
        spark.createDataFrame(
            [(1, 1.0, None, "t"), (2, 20.0, None, "t"), (3, 30.0, 3.0, "s"), (None, 9.0, 9.0, "t"),
             (None, 8.0, 8.0, "s")], T,
        )
    )
    kept = upsert(target, source, KEY, keep=["a"], touch={"made": F.lit("now")}).filter("k = 2").first()
    assert tuple(kept) == (2, 2.0, None, "now")


def test_merging_twice_equals_once(spark):
    target, source = frames(spark)
    source = source.filter("k IS NOT NULL")
    for merge in (upsert, coalesce_merge, replace_by_key):
        once = merge(target, source, KEY)
        assert rows(merge(once, source, KEY)) == rows(once), merge.__name__


def test_coalesce_merge_keeps_stored_values(spark):
    target, source = frames(spark)
    source = source.unionByName(spark.createDataFrame([(1, 10.0, 10.0)], S))
    by = {r["k"]: tuple(r) for r in coalesce_merge(target, source.filter("k IS NOT NULL"), KEY).collect()}
    assert by == {
        1: (1, 1.0, 10.0, "t"), 2: (2, 2.0, 2.0, "t"), 3: (3, 30.0, 3.0, None), None: (None, 9.0, 9.0, "t"),
    }


def test_replace_loses_other_columns(spark):
    target, source = frames(spark)
    by = {r["k"]: tuple(r) for r in replace_by_key(target, source.filter("k = 2"), KEY).collect()}
    assert by[2] == (2, 20.0, None, None) and by[1] == (1, 1.0, None, "t") and len(by) == 3


def test_fill_from(spark):
    target, _ = frames(spark)
    lookup = spark.createDataFrame([(1, 5.0), (2, 6.0)], "k int, v double")
    by = {r["k"]: r["b"] for r in fill_from(target, lookup, KEY, "b", "v").collect()}
    assert by == {1: 5.0, 2: 2.0, None: 9.0}
    none = fill_from(target, lookup, KEY, "b", "v", only=F.col("k") > 1)
    assert {r["k"]: r["b"] for r in none.collect()}[1] is None


def test_dedup_is_deterministic_and_keeps_null_keys(spark):
    df = spark.createDataFrame(
        [(1, 1.0, 5.0), (1, 2.0, 1.0), (1, 2.0, 4.0), (None, 1.0, 1.0), (None, 1.0, 1.0)], S
    )
    kept = rows(dedup_source(df, KEY, [F.col("a")]))
    assert kept == [(None, 1.0, 1.0), (None, 1.0, 1.0), (1, 2.0, 4.0)]
    assert rows(duplicate_keys(df, KEY)) == [(1, 3)]


def test_dedup_combines_copies_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0)], S)
    plan = dedup_source(df, KEY, [F.col("a")])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan


def test_stored_table_replaces_touched_months_only(spark):
    table = KeyedTable(
        scratch_folder(spark, "test-table"), schemas.PREDICTIONS, schemas.KEYS["predictions"], "predicted_date"
    )
    assert table.read(spark).count() == 0
    ddl = "ticker string, predicted_date date, predicted_close double"
    first = [("A", dt.date(2024, 1, 5), 1.0), ("A", dt.date(2024, 2, 5), 2.0)]
    table.merge(spark.createDataFrame(first, ddl), lambda t, s, k: upsert(t, s, k))
    january = {f for f in table.read(spark).filter("predicted_date < '2024-02-01'").inputFiles()}
    second = [("A", dt.date(2024, 2, 5), 3.0), ("B", dt.date(2024, 2, 6), 4.0)]
    table.merge(spark.createDataFrame(second, ddl), lambda t, s, k: upsert(t, s, k))
    got = {(r["ticker"], str(r["predicted_date"])): r["predicted_close"] for r in table.read(spark).collect()}
    assert got == {("A", "2024-01-05"): 1.0, ("A", "2024-02-05"): 3.0, ("B", "2024-02-06"): 4.0}
    assert {f for f in table.read(spark).inputFiles() if "period=2024-01" in f} == {
        f for f in january if "period=2024-01" in f
    }
    assert table.read(spark).schema == schemas.PREDICTIONS
    pruned = table.read(spark, ["2024-02"])
    assert pruned.count() == 2
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*period#", plan)


def test_interrupted_replacement_is_finished_by_the_next_merge(spark):
    table = KeyedTable(
        scratch_folder(spark, "test-crash"), schemas.PREDICTIONS, schemas.KEYS["predictions"], "predicted_date"
    )
    ddl = "ticker string, predicted_date date, predicted_close double"
    day = dt.date(2024, 1, 5)
    merged = schemas.conform(spark.createDataFrame([("A", day, 1.0), ("B", day, 2.0)], ddl), schemas.PREDICTIONS)
    table._write(merged, table._pending)  # complete copy, replacement not done
    table.merge(spark.createDataFrame([("B", day, 3.0)], ddl), lambda t, s, k: upsert(t, s, k))
    assert {r["ticker"]: r["predicted_close"] for r in table.read(spark).collect()} == {"A": 1.0, "B": 3.0}


def test_replacement_moves_the_merged_files(spark, tmp_path):
    table = KeyedTable(f"{tmp_path}/t", schemas.PREDICTIONS, schemas.KEYS["predictions"], "predicted_date")
    ddl = "ticker string, predicted_date date, predicted_close double"
    source = spark.createDataFrame([("A", dt.date(2024, 1, 5), 1.0), ("A", dt.date(2024, 2, 5), 2.0)], ddl)
    # The first merge has nothing to join with.
    first = upsert(table.read(spark), source, table.keys)
    assert "Join" not in first._jdf.queryExecution().optimizedPlan().toString()
    table._write(schemas.conform(first, schemas.PREDICTIONS), table._pending)
    names = lambda folder: sorted(p.name for p in (tmp_path / folder).glob("period=*/*.parquet"))
    written = names("t__pending")
    table.recover(spark)
    assert names("t") == written and not (tmp_path / "t__pending").exists()
    # One period moved, then the driver died.
    table._write(schemas.conform(source.withColumn("predicted_close", F.lit(9.0)), schemas.PREDICTIONS), table._pending)
    (tmp_path / "t/gone").mkdir()
    (tmp_path / "t/period=2024-01").rename(tmp_path / "t/gone/old")
    (tmp_path / "t__pending/period=2024-01").rename(tmp_path / "t/period=2024-01")
    (tmp_path / "t/gone").rename(tmp_path / "gone")
    table.recover(spark)
    assert {r["predicted_close"] for r in table.read(spark).collect()} == {9.0} and table.read(spark).count() == 2


def test_table_without_newer_columns_reads(spark):
    path = f'{scratch_folder(spark, "test-old")}/t'
    old = spark.createDataFrame([("A", dt.date(2024, 1, 5), 1.0)], "ticker string, date date, close double")
    old.withColumn("period", F.lit("2024-01")).write.partitionBy("period").parquet(path)
    read = KeyedTable(path, schemas.FEATURES, schemas.KEYS["features"], "date").read(spark)
    assert read.columns == [f.name for f in schemas.FEATURES.fields]
    assert read.first()["close"] == 1.0 and read.first()["bb_width"] is None


def test_conform_and_feature_prefix(spark):
    df = spark.createDataFrame([("2024-01-05", "1.5", "A")], "date string, close string, ticker string")
    out = schemas.conform(df, schemas.FEATURES, {"rsi_14": F.lit(50)})
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in schemas.FEATURES]
    assert out.first()["rsi_14"] == 50.0
    assert schemas.feature_prefix(13)[-1] == "volume_sma_20"
    for n in (0, 18):
        try:
            schemas.feature_prefix(n)
        except ValueError:
            continue
        raise AssertionError(n)
