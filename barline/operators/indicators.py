"""The seventeen technical-indicator features.

Rolling features look back over a block's rows and the halo before it, in numpy
(:mod:`barline.operators.feature_rows`). The exponential averages are affine scans:
the rows of a block, from its first known close on, take an average ``y`` to
``gain * y + end``, so a block is a few numbers, and folding them over the blocks of
a ticker gives each block the averages it begins with. The state behind that fold is kept per ticker by :mod:`barline.plans.features`,
to go on from when new bars come.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from barline.operators.feature_rows import features as features_of_rows
from barline.operators.series import BLOCK_DAYS, last_of, packed, scanned
from barline.schemas import FEATURE_COLUMNS, FEATURES, SERIES_STATE

# Window lengths and gates.
MIN_HISTORY_ROWS = 26
MAX_SOURCE_NULL_RATIO = 0.01

#: Rows before a block that its rolling windows reach: 50 less the row itself.
HALO_ROWS = 49
#: A task works on a block and its halo at once, so this bounds its memory.
MOST_BLOCK_DAYS = 3000

STATE = SERIES_STATE.simpleString()


def indicators(bars: DataFrame, *, block_days: int = BLOCK_DAYS) -> DataFrame:
    """(ticker, date, close, volume) -> ticker, date and all features, NULLs kept."""
    blocks, carries = _scan(bars, block_days)
    return features_of(blocks.join(carries.drop("total"), ["ticker", "_seg"]))


def stock_features(
    bars: DataFrame,
    *,
    min_rows: int = MIN_HISTORY_ROWS,
    max_null_ratio: float = MAX_SOURCE_NULL_RATIO,
    block_days: int = BLOCK_DAYS,
) -> DataFrame:
    """The stored feature table: gated tickers, complete rows only.

    A ticker with fewer than ``min_rows`` bars, or with more than
    ``max_null_ratio`` of them lacking close or volume, gives no rows.
    """
    blocks, carries = _scan(bars, block_days)
    gated = carries.filter(usable(F.col("total"), min_rows, max_null_ratio)).drop("total")
    return complete(features_of(blocks.join(gated, ["ticker", "_seg"])))


def series_states(bars: DataFrame, *, block_days: int = BLOCK_DAYS) -> DataFrame:
    """``ticker`` and ``state`` after its last bar."""
    _, carries = _scan(bars, block_days)
    return _totals(carries)


def resumed(bars: DataFrame, states: DataFrame, *, block_days: int = BLOCK_DAYS) -> tuple[DataFrame, DataFrame]:
    """Features of ``bars`` that follow on ``states`` (ticker, state), gates and all, and the states after them.

    Reads nothing of the bars before. A ticker without a state begins anew.
    """
    blocks, carries = _scan(bars, block_days, states)
    gated = carries.filter(usable(F.col("total"))).drop("total")
    return complete(features_of(blocks.join(gated, ["ticker", "_seg"]))), _totals(carries)


def _totals(carries: DataFrame) -> DataFrame:
    return carries.groupBy("ticker").agg(F.any_value("total").alias("state"))


def usable(state: Column, min_rows: int = MIN_HISTORY_ROWS, max_null_ratio: float = MAX_SOURCE_NULL_RATIO) -> Column:
    """Whether a ticker's bars so far pass the source gates."""
    return (state["rows"] >= min_rows) & (state["nulls"] / state["rows"] <= max_null_ratio)


def complete(features: DataFrame) -> DataFrame:
    return features.na.drop("any", subset=["date", *FEATURE_COLUMNS])


def min_history(bars: DataFrame, min_rows: int = MIN_HISTORY_ROWS) -> DataFrame:
    """Bars of tickers with at least ``min_rows`` of them."""
    long = bars.groupBy("ticker").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_rows)
    return bars.join(long, "ticker", "left_semi")


def bar_blocks(bars: DataFrame, block_days: int = BLOCK_DAYS) -> DataFrame:
    """Blocks of the columns that features need."""
    if block_days > MOST_BLOCK_DAYS:
        raise ValueError(f"block_days is at most {MOST_BLOCK_DAYS}")
    source = bars.select(
        "ticker", F.to_date("date").alias("date"), F.col("close").cast("double"), F.col("volume").cast("bigint")
    )
    return packed(source, block_days=block_days)


def _scan(bars: DataFrame, block_days: int, states: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    blocks = bar_blocks(bars, block_days)
    return blocks, scanned(blocks, summary_of(F.col("list")), no_state(), advanced, start=states)


#: Sums that a block's rows are reduced to, see :func:`summary_of`.
_SUMS = ("gain_12", "end_12", "gain_26", "end_26", "k_12", "k_26", "k")
_SCAN = (
    "struct<n: bigint, nulls: bigint, first: bigint, value: double, last: bigint, "
    + ", ".join(f"{c}: double" for c in _SUMS) + ">"
)


def no_state() -> Column:
    """The state of a ticker without bars."""
    known = {"rows": F.lit(0), "nulls": F.lit(0), "gap": F.lit(0), "halo": F.array()}
    return F.struct(*(known.get(f.name, F.lit(None)).alias(f.name) for f in SERIES_STATE.fields)).cast(STATE)


def summary_of(rows: Column) -> Column:
    """What a block does to a state: its counts and last rows, and its part of the affine scan.

    Coefficients hold from the first known close on: an average that is ``y`` there
    is ``gain * y + end`` at the block's end, and the signal line takes ``k_12``,
    ``k_26`` of the two averages there, and ``k``.
    """
    q, a = _decay(9), 1.0 - _decay(9)
    zero = F.struct(
        F.lit(0).alias("n"), F.lit(0).alias("nulls"), *(F.lit(None).alias(c) for c in ("first", "value", "last")),
        *(F.lit(0.0).alias(c) for c in _SUMS),
    )

    def signal(acc: Column) -> list[Column]:
        """The row before takes part in the signal line, with the averages it had."""
        return [
            (q * acc["k_12"] + a * acc["gain_12"]).alias("k_12"),
            (q * acc["k_26"] + a * acc["gain_26"]).alias("k_26"),
            (q * acc["k"] + a * (acc["end_12"] - acc["end_26"])).alias("k"),
        ]

    def row(acc: Column, r: Column) -> Column:
        n, x = acc["n"] + 1, r["close"]
        known, begun = x.isNotNull(), acc["first"].isNotNull()
        averages = []
        for span in (12, 26):
            left, taken = _shares(n - acc["last"], span)
            gain, end = acc[f"gain_{span}"], acc[f"end_{span}"]
            averages += [
                F.when(known & begun, gain * left).when(known, F.lit(1.0)).otherwise(gain).alias(f"gain_{span}"),
                F.when(known & begun, end * left + x * taken).otherwise(end).alias(f"end_{span}"),
            ]
        lacking = (x.isNull() | r["volume"].isNull()).cast("bigint")
        return F.struct(
            n.alias("n"), (acc["nulls"] + lacking).alias("nulls"), F.coalesce(acc["first"], F.when(known, n)).alias("first"),
            F.coalesce(acc["value"], x).alias("value"), F.when(known, n).otherwise(acc["last"]).alias("last"),
            *averages, *signal(acc),
        )

    def done(acc: Column) -> Column:
        counts = [acc[c].alias(c) for c in ("n", "nulls", "first", "value", "last", *_SUMS[:4])]
        early = F.slice(rows, F.lit(1), F.greatest(F.size(rows) - F.lit(HALO_ROWS), F.lit(0)))
        return F.struct(
            *counts, *signal(acc), last_of(rows, HALO_ROWS).alias("tail"), _last_known(early).alias("early"),
            F.try_element_at(rows, F.lit(1))["date"].alias("first_date"),
            F.try_element_at(rows, F.lit(-1))["date"].alias("last_date"),
        )

    return F.aggregate(rows, zero.cast(_SCAN), row, done)


def advanced(state: Column, s: Column) -> Column:
    """The state after a block with summary ``s``."""
    halo = F.concat(state["halo"], s["tail"])
    passed = F.slice(halo, F.lit(1), F.greatest(F.size(halo) - F.lit(HALO_ROWS), F.lit(0)))
    begun, known = state["ema_12"].isNotNull(), s["first"].isNotNull()
    at = {}  # the averages at the block's first known close
    for span in (12, 26):
        left, taken = _shares(state["gap"] + s["first"], span)
        at[span] = F.when(begun, state[f"ema_{span}"] * left + s["value"] * taken).otherwise(s["value"])
    # Until then macd stands still, and the signal line draws near it.
    quiet = F.when(known, s["first"] - 1).otherwise(s["n"])
    kept = F.pow(F.lit(_decay(9)), quiet)
    before = F.when(begun, kept * state["signal"] + (1.0 - kept) * (state["ema_12"] - state["ema_26"]))
    after = F.pow(F.lit(_decay(9)), s["n"] - quiet) * F.coalesce(before, F.lit(0.0))
    signal = after + s["k_12"] * at[12] - s["k_26"] * at[26] + s["k"]
    averages = [
        F.when(known, s[f"gain_{n}"] * at[n] + s[f"end_{n}"]).otherwise(state[f"ema_{n}"]).alias(f"ema_{n}") for n in (12, 26)
    ]
    return F.struct(
        (state["rows"] + s["n"]).alias("rows"), (state["nulls"] + s["nulls"]).alias("nulls"),
        F.coalesce(state["first_date"], s["first_date"]).alias("first_date"), s["last_date"].alias("last_date"),
        last_of(halo, HALO_ROWS).alias("halo"), F.coalesce(s["early"], _last_known(passed), state["older"]).alias("older"),
        F.when(known, s["n"] - s["last"]).otherwise(state["gap"] + s["n"]).alias("gap"), *averages,
        F.when(known, signal).otherwise(before).alias("signal"),
    ).cast(STATE)


def _last_known(rows: Column) -> Column:
    closes = F.filter(F.transform(rows, lambda r: r["close"]), lambda c: c.isNotNull())
    return F.try_element_at(closes, F.lit(-1))


def _shares(gap: Column, span: int) -> tuple[Column, Column]:
    """What a known value, ``gap`` rows after the last one, leaves of the average, and its own part."""
    q, a = _decay(span), 1.0 - _decay(span)
    faded = F.pow(F.lit(q), gap)
    left = F.when(gap == 1, F.lit(q)).otherwise(faded / (faded + F.lit(a)))
    return left, F.when(gap == 1, F.lit(a)).otherwise(F.lit(a) / (faded + F.lit(a)))


def features_of(blocks: DataFrame) -> DataFrame:
    """All features of the rows of ``blocks``: ticker, ``_seg``, ``list`` and the ``carry`` they begin with."""
    carried = [F.col(f"carry.{c}").alias(c) for c in ("halo", "older", "gap", "ema_12", "ema_26", "signal")]
    schema = to_arrow_schema(FEATURES)
    return blocks.select("ticker", "list", *carried).mapInArrow(lambda batches: features_of_rows(batches, schema), FEATURES)


def _decay(span: int) -> float:
    return 1.0 - 2.0 / (span + 1.0)
