"""What several operators share: texts out of Arrow batches, keys for rows, fixed patterns."""

from __future__ import annotations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from barline.sources.tables import stage

#: Characters that end a word; all others, punctuation included, belong to one.
BLANKS = r"[\x20\x09-\x0D]+"

#: Every byte that is no ASCII letter, digit or part of a longer character becomes a blank; A-Z become a-z.
LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def text_bytes(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The texts of a batch in UTF-8; NULL is empty.

    ``bytes.lower`` changes A-Z only, and ``bytes.split`` parts at exactly the
    characters of ``BLANKS``.
    """
    return [b"" if t is None else t for t in batch.column(column).cast(pa.binary()).to_pylist()]


def row_key(*columns: str | Column) -> Column:
    """A 64-bit key of a row's content. Rows that share one by chance are told apart by the check that follows."""
    return F.xxhash64(*columns)


def free_name(frame: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column of ``frame`` is called that."""
    names = {c.lower() for c in frame.columns}
    while name.lower() in names:
        name += "_"
    return name


def null_last(column: str | Column) -> Column:
    """A string that is never NULL and sorts like ``column`` by code point, NULL last."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.concat(F.lit("0"), c.cast("string")), F.lit("1"))


def join_few(rows: DataFrame, wanted: DataFrame, key: str, how: str = "inner", bits: int = 1 << 23) -> DataFrame:
    """``rows.join(wanted, key, how)``, inner or left_semi, for when few of many wide rows are wanted.

    ``key`` is a hash. A bitmap of the wanted keys lets most other rows go before
    the join moves them. The bitmap is broadcast; it has ``bits`` bits, whatever the
    data. Where it fills up, more rows move and the result stays the same.
    """
    slot = F.pmod(F.col(key), F.lit(bits))
    place = F.floor(slot / 64).cast("int")
    bit = F.expr(f"shiftleft(1L, cast(pmod({key}, 64) as int))")
    bitmap = wanted.select(place.alias("_place"), bit.alias("_bit")).groupBy("_place").agg(F.bit_or("_bit").alias("_bits"))
    some = (
        rows.withColumn("_place", place)
        .join(F.broadcast(bitmap), "_place")
        .filter(F.col("_bits").bitwiseAND(bit) != 0)
        .drop("_place", "_bits")
    )
    return some.join(wanted, key, how)


def ranked(rows: DataFrame, group: str, order: list[str], purpose: str) -> DataFrame:
    """``rows`` with ``rank``: their places from 0 among rows of equal ``group`` by ``order``, NULL first.

    Rows are dealt by ranges of (group, order, a running number), so a group that
    holds a third of all rows is many ranges, and so are rows that repeat each
    other. A range numbers its rows as they stream by; what a range has to add to
    its first group is at most one row per range, which is what is broadcast. The
    rows are written once, sorted, and keep that order in each file. They should
    come from a scan or a stage, so that a task that is run again sees them alike.
    """
    tie, part, nth, more = (free_name(rows, c) for c in ("_tie", "_part", "_nth", "_more"))
    by = [F.col(c).asc_nulls_first() for c in (group, *order, tie)]
    dealt = rows.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by).drop(tie)
    names = dealt.columns

    def number(batches):
        here, last, n = TaskContext.get().partitionId(), None, -1
        for b in batches:
            places = []
            for key in b.column(group).to_pylist():
                n = n + 1 if n >= 0 and key == last else 0
                last = key
                places.append(n)
            columns = [*b.columns, pa.array([here] * len(places), pa.int32()), pa.array(places, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*names, part, nth])

    fields = [*dealt.schema.fields, T.StructField(part, T.IntegerType()), T.StructField(nth, T.LongType())]
    placed = stage(dealt.mapInArrow(number, T.StructType(fields)), purpose)
    held = placed.groupBy(group, part).agg((F.max(nth) + 1).alias(more))
    before = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.select(F.col(group).alias("_g"), F.col(part).alias("_p"), F.sum(more).over(before).alias(more)).filter(F.col(more) > 0)
    found = placed.join(F.broadcast(offsets), F.col(group).eqNullSafe(F.col("_g")) & (F.col(part) == F.col("_p")), "left")
    return found.select(*names, (F.col(nth) + F.coalesce(F.col(more), F.lit(0))).alias("rank"))
