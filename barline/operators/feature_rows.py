"""The features of a task's blocks, in numpy.

Spark's sliding frames evaluate every aggregate over its whole frame, 50 rows for one
row, and would do so for the halo rows too, which outnumber a short block's own. Here
only a block's own rows have windows. Sums and deviations take a window's rows in its
order, as Spark's aggregates do, so a window's result does not depend on the block.
These functions are pickled by value, so executors need no copy of this package.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows (halo included) that are worked on at once, or those of one block.
PIECE_ROWS = 65_536

Numbers = tuple[np.ndarray, np.ndarray]  # values, and where they are known


def features(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Blocks (``ticker``, ``halo``, ``list`` and what the average carries in) to their rows with all features."""
    for batch in batches:
        ahead, own = (np.asarray(batch.column(c).value_lengths()).astype(np.int64) for c in ("halo", "list"))
        ends, first = np.cumsum(ahead + own), 0
        while first < batch.num_rows:
            upto = int(np.searchsorted(ends, (ends[first - 1] if first else 0) + PIECE_ROWS, side="right"))
            upto = max(upto, first + 1)
            yield _piece(batch.slice(first, upto - first), ahead[first:upto], own[first:upto], schema)
            first = upto


def _piece(blocks: pa.RecordBatch, ahead: np.ndarray, own: np.ndarray, schema: pa.Schema) -> pa.RecordBatch:
    size = ahead + own
    start = np.cumsum(size) - size
    block = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(block)) - start[block]  # of a row within its block and halo
    at = np.flatnonzero(place >= ahead[block])  # a block's own rows
    before = np.flatnonzero(place < ahead[block])
    halo, rows = blocks.column("halo").flatten(), blocks.column("list").flatten()

    def joined(name: str) -> Numbers:
        values, known = np.zeros(len(block)), np.zeros(len(block), dtype=bool)
        for where, part in ((before, halo), (at, rows)):
            # Not `part.field`, which passes over a struct's own offset.
            column = pc.struct_field(part, name)
            known[where] = np.asarray(column.is_valid())
            values[where] = column.cast(pa.float64(), safe=False).fill_null(0.0).to_numpy(zero_copy_only=False)
        return values, known

    close, volume = joined("close"), joined("volume")
    with np.errstate(all="ignore"):
        filled = _filled(close, start[block], block, blocks.column("older"))
        returns = _change(filled, np.arange(len(block)), place, 1)
        step = _delta(close, place)
        gain = _mean(np.maximum(step[0], 0.0), step[1], at, place, 14)
        loss = _mean(np.maximum(-step[0], 0.0), step[1], at, place, 14)
        sma_20, sma_50 = (_mean(*close, at, place, n) for n in (20, 50))
        std_20, volatility = _deviation(*close, at, place, 20), _deviation(*returns, at, place, 14)
        volume_sma = _mean(*volume, at, place, 20)
        rs = _ratio(gain, loss)
        mine = lambda c: (c[0][at], c[1][at])
        found = {
            "close": mine(close), "daily_return": mine(returns), "sma_20": sma_20, "sma_50": sma_50,
            "rsi_14": (100.0 - 100.0 / (1.0 + rs[0]), rs[1]),
            "bb_upper": (sma_20[0] + 2.0 * std_20[0], sma_20[1]), "bb_lower": (sma_20[0] - 2.0 * std_20[0], sma_20[1]),
            "volatility_14": volatility, "volume_sma_20": volume_sma,
            "bb_width": _ratio((4.0 * std_20[0], sma_20[1]), sma_20),
            "volume_ratio_20": _ratio(mine(volume), volume_sma),
            "return_3d": _change(filled, at, place, 3), "return_5d": _change(filled, at, place, 5),
            **_averages(*mine(close), own, blocks),
        }
    columns = {"ticker": blocks.column("ticker").take(pa.array(block[at])), "date": pc.struct_field(rows, "date")}
    columns |= {c: pa.array(values, mask=~known) for c, (values, known) in found.items()}
    batch = pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in schema], schema=schema)
    # Rows without a day count for those after them, but are not returned themselves.
    return batch.filter(batch.column("date").is_valid())


def _filled(close: Numbers, start: np.ndarray, block: np.ndarray, older: pa.Array) -> Numbers:
    """The last known close up to each row, which may be older than the halo."""
    values, known = close
    last = np.maximum.accumulate(np.where(known, np.arange(len(values)), -1))
    inside = last >= start
    carried = older.fill_null(0.0).to_numpy(zero_copy_only=False)[block]
    return np.where(inside, values[last], carried), inside | np.asarray(older.is_valid())[block]


def _change(filled: Numbers, at: np.ndarray, place: np.ndarray, periods: int) -> Numbers:
    """Relative change against ``periods`` rows ago."""
    values, known = filled
    past = np.maximum(at - periods, 0)
    ratio, there = _ratio((values[at], known[at]), (values[past], known[past] & (place[at] >= periods)))
    return ratio - 1.0, there


def _delta(close: Numbers, place: np.ndarray) -> Numbers:
    """Plain difference against the row before; a gap is not filled."""
    values, known = close
    past = np.maximum(np.arange(len(values)) - 1, 0)
    return values - values[past], known & known[past] & (place >= 1)


def _ratio(a: Numbers, b: Numbers) -> Numbers:
    """Unknown where the divisor is zero."""
    there = a[1] & b[1] & (b[0] != 0.0)
    return np.divide(a[0], b[0], out=np.zeros(len(a[0])), where=there), there


def _full(known: np.ndarray, at: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """Whether the last ``n`` rows of ``at`` are in the block or halo and all known."""
    count = np.concatenate([[0], np.cumsum(known)])
    return (place[at] >= n - 1) & (count[at + 1] - count[np.maximum(at - n + 1, 0)] == n)


def _mean(values: np.ndarray, known: np.ndarray, at: np.ndarray, place: np.ndarray, n: int) -> Numbers:
    full = _full(known, at, place, n)
    rows, total = at[full], np.zeros(int(full.sum()))
    for back in range(n - 1, -1, -1):
        total += values[rows - back]
    return _spread(total / n, full)


def _deviation(values: np.ndarray, known: np.ndarray, at: np.ndarray, place: np.ndarray, n: int) -> Numbers:
    """Of a sample, by updates of mean and squares row by row: nothing cancels out."""
    full = _full(known, at, place, n)
    rows = at[full]
    mean, squares = np.zeros(len(rows)), np.zeros(len(rows))
    for i in range(1, n + 1):
        off = values[rows - (n - i)] - mean
        mean += off / i
        squares += off * (off - off / i)
    return _spread(np.sqrt(squares / (n - 1)), full)


def _spread(values: np.ndarray, full: np.ndarray) -> Numbers:
    out = np.zeros(len(full))
    out[full] = values
    return out, full


def _averages(values: np.ndarray, known: np.ndarray, own: np.ndarray, blocks: pa.RecordBatch) -> dict[str, Numbers]:
    """Exponential averages, each block from what is carried into it.

    ``y = (q^g * y_prev + a * x) / (q^g + a)`` with ``a = 2 / (span + 1)``, ``q = 1 - a`` and
    ``g`` the rows since the last known value; a row without a value keeps the last ``y``.
    """
    (a12, a26, a9), xs, there = (2.0 / (span + 1.0) for span in (12, 26, 9)), values.tolist(), known.tolist()
    q12, q26, q9 = 1.0 - a12, 1.0 - a26, 1.0 - a9
    fast, slow, line = [0.0] * len(xs), [0.0] * len(xs), [0.0] * len(xs)
    begun = np.ones(len(xs), dtype=bool)
    carried = (blocks.column(c).to_pylist() for c in ("gap", "ema_12", "ema_26", "signal"))
    i = 0
    for n, gap, y12, y26, signal in zip(own.tolist(), *carried, strict=True):
        signal, first, end = signal or 0.0, i, i + n
        if y12 is None:
            while i < end and not there[i]:
                i += 1
            begun[first:i] = False
            if i == end:
                continue
            y12 = y26 = xs[i]
            gap, fast[i], slow[i] = 0, y12, y26
            i += 1
        for i in range(i, end):
            gap += 1
            if there[i]:
                x = xs[i]
                if gap == 1:
                    y12, y26 = q12 * y12 + a12 * x, q26 * y26 + a26 * x
                else:
                    left12, left26 = q12**gap, q26**gap
                    y12, y26 = (left12 * y12 + a12 * x) / (left12 + a12), (left26 * y26 + a26 * x) / (left26 + a26)
                gap = 0
            signal = q9 * signal + a9 * (y12 - y26)
            fast[i], slow[i], line[i] = y12, y26, signal
        i = end
    ema_12, ema_26 = np.array(fast), np.array(slow)
    found = {"ema_12": ema_12, "ema_26": ema_26, "macd": ema_12 - ema_26, "macd_signal": np.array(line)}
    return {c: (v, begun) for c, v in found.items()}
