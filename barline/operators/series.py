"""Windows over keyed series that never need a whole series in one task.

A plain ``Window.partitionBy("ticker")`` sends each series to one task. Here a
series is cut into blocks of whole days. A series has one row per day, so a block
holds at most ``block_days`` rows, whatever the series: no counting, no second
plan for long ones. Rows move once, to their (ticker, block).

What a block has to know of the rows before it is a small state: the last rows
themselves (the halo), counts, averages so far. Each block is reduced to a summary,
the summaries of a ticker are folded in order, and every block gets the state that
the ones before it leave: a prefix scan on two levels, over rows within blocks and
over blocks within tickers. A state after the last block is also all that is needed
to go on when new rows come.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from barline.functions.once import with_computed

#: Days in a block, and so the most rows it can have.
BLOCK_DAYS = 2048
#: The block of rows without a day, before all others.
NO_DAY = -(2**31)


@dataclass(frozen=True)
class Segmented:
    """Rows with ``_seg``, ``_own``, ``_before``, ``_rows`` and the window to use on them.

    ``_before`` counts the ticker's rows ahead of the block's first row (its halo
    included), ``_rows`` all rows of the ticker.
    """

    df: DataFrame
    key: str
    order: str

    @property
    def ordered(self):
        return Window.partitionBy(self.key, "_seg").orderBy(self.order)

    def last_rows(self, n: int):
        """Frame of the current row and the ``n - 1`` before it."""
        return self.ordered.rowsBetween(-(n - 1), 0)

    def position(self) -> Column:
        """1-based position in the whole series."""
        return F.col("_before") + F.row_number().over(self.ordered)

    def length(self) -> Column:
        """Rows of the whole series."""
        return F.col("_rows")


def packed(
    df: DataFrame, *, key: str = "ticker", order: str = "date", block_days: int = BLOCK_DAYS, more: Sequence[Column] = ()
) -> DataFrame:
    """One row per (key, ``_seg``): ``list``, its rows as structs, by ``order``; ``more`` are aggregates of ``row``.

    ``_seg`` is never NULL. The blocks are read twice, for their summaries and for their
    rows; a join on a nullable ``_seg`` would put a filter under one of the two only, and
    Spark then computes and shuffles the rows once for each.
    """
    block = F.coalesce(F.floor(F.unix_date(F.to_date(order)) / F.lit(block_days)).cast("int"), F.lit(NO_DAY))
    rows = F.struct(order, *(c for c in df.columns if c not in (key, order)))
    blocks = df.select(key, block.alias("_seg"), rows.alias("row")).repartition(key, "_seg")
    return blocks.groupBy(key, "_seg").agg(F.sort_array(F.collect_list("row")).alias("list"), *more)


def last_of(rows: Column, n: int) -> Column:
    """The last ``n`` elements, or all."""
    return F.slice(rows, F.greatest(F.size(rows) - F.lit(n), F.lit(0)) + 1, F.lit(n))


def scanned(
    blocks: DataFrame,
    summary: Column,
    zero: Column,
    step: Callable[[Column, Column], Column],
    *,
    key: str = "ticker",
    start: DataFrame | None = None,
) -> DataFrame:
    """Per (key, ``_seg``): ``carry``, the state that the blocks before it leave, and ``total``, that of all.

    ``step`` takes a state and a summary to the next state; ``start`` (key, ``state``) is
    where a key begins, else at ``zero``. What meets in one task are a key's
    summaries, one per block.
    """
    listed = blocks.select(key, F.struct("_seg", summary.alias("s")).alias("b")).groupBy(key)
    listed = listed.agg(F.sort_array(F.collect_list("b")).alias("blocks"))
    if start is not None:
        listed = listed.join(start.select(key, "state"), key, "left")
        zero = F.coalesce("state", zero)
    out = F.struct(F.lit(0).alias("_seg"), zero.alias("carry"))
    begin = F.struct(zero.alias("state"), F.slice(F.array(out), 1, 0).alias("out"))

    def folded(acc: Column, b: Column) -> Column:
        before = F.array(F.struct(b["_seg"].alias("_seg"), acc["state"].alias("carry")))
        return F.struct(step(acc["state"], b["s"]).alias("state"), F.concat(acc["out"], before).alias("out"))

    # Computed once: a filter on the total would fold a key's blocks again for each mention.
    folds = with_computed(listed, {"f": F.aggregate("blocks", begin, folded)})
    return folds.select(key, F.col("f.state").alias("total"), F.inline("f.out"))


def with_halo(blocks: DataFrame, *, order: str = "date") -> DataFrame:
    """Rows of ``blocks`` (``list``) after those of their ``halo``, for which ``_own`` is false.

    Rows without a day count for those after them, but are not returned themselves.
    """
    size = F.size("halo")
    rows = F.transform(F.concat("halo", "list"), lambda r, i: F.struct((i >= size).alias("_own"), r.alias("row")))
    kept = [c for c in blocks.columns if c not in ("list", "halo")]
    met = blocks.select(*kept, F.inline(rows)).select(*kept, "_own", "row.*")
    return met.filter(~F.col("_own") | F.col(order).isNotNull())


def segment(
    df: DataFrame,
    lookback: int,
    *,
    key: str = "ticker",
    order: str = "date",
    block_days: int = BLOCK_DAYS,
    bounds: Sequence[str] = (),
    within: Callable[[Column, Column, Column], Column] | None = None,
) -> Segmented:
    """``df`` in blocks, each with the ``lookback`` rows before it; one row per key and day.

    The columns in ``bounds`` become ``within(value, minimum, maximum)`` of the key's rows:
    the bounds are found on the same way, without another pass or join.
    """
    blocks = haloed(df, lookback, key=key, order=order, block_days=block_days, bounds=bounds, within=within)
    return Segmented(with_halo(blocks, order=order), key, order)


def haloed(
    df: DataFrame,
    lookback: int,
    *,
    key: str = "ticker",
    order: str = "date",
    block_days: int = BLOCK_DAYS,
    bounds: Sequence[str] = (),
    within: Callable[[Column, Column, Column], Column] | None = None,
) -> DataFrame:
    """What ``segment`` cuts, a row per block: its rows in ``list``, those before it in ``halo``.

    Without ``within``, the rows stay as they are and ``_lo``, ``_hi`` hold the bounds.
    """
    names, found = (("lo", "hi"), (F.min, F.max)) if bounds else ((), ())
    more = [F.array(*[f(F.col(f"row.{c}").cast("double")) for c in bounds]).alias(n) for n, f in zip(names, found)]
    blocks = packed(df, key=key, order=order, block_days=block_days, more=more)
    rows = blocks.schema["list"].dataType.simpleString()
    state = f"struct<rows: bigint, halo: {rows}{''.join(f', {n}: array<double>' for n in names)}>"
    summary = F.struct(F.size("list").cast("bigint").alias("n"), last_of(F.col("list"), lookback).alias("tail"), *names)
    unknown = [F.array(*[F.lit(None) for _ in bounds]).alias(n) for n in names]
    zero = F.struct(F.lit(0).alias("rows"), F.array().alias("halo"), *unknown).cast(state)

    def step(before: Column, s: Column) -> Column:
        halo = last_of(F.concat(before["halo"], s["tail"]), lookback)
        lower = lambda a, b: F.least(a, b)
        higher = lambda a, b: F.greatest(a, b)
        wider = [F.zip_with(before[n], s[n], f).alias(n) for n, f in zip(names, (lower, higher))]
        return F.struct((before["rows"] + s["n"]).alias("rows"), halo.alias("halo"), *wider).cast(state)

    met = blocks.drop(*names).join(scanned(blocks, summary, zero, step, key=key), [key, "_seg"])
    counts = [(F.col("carry.rows") - F.size("carry.halo")).alias("_before"), F.col("total.rows").alias("_rows")]
    place = {c: i for i, c in enumerate(bounds)}

    def row(r: Column) -> Column:
        at = lambda c: (F.col("total.lo")[place[c]], F.col("total.hi")[place[c]])
        return F.struct(*[(within(r[c], *at(c)) if c in place else r[c]).alias(c) for c in fields])

    fields = blocks.schema["list"].dataType.elementType.names
    halo, own = (F.transform(c, row) if within else F.col(c) for c in ("carry.halo", "list"))
    told = [F.col(f"total.{n}").alias(f"_{n}") for n in names if not within]
    return met.select(key, "_seg", *counts, *told, halo.alias("halo"), own.alias("list"))


def own_rows(df: DataFrame) -> DataFrame:
    """Drop the halo rows and the helper columns."""
    return df.filter("_own").drop("_seg", "_own", "_before", "_rows")
