"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact length per source. A source whose target exceeds
its size is taken whole as often as it fits; the rest of the target is a budget
that a part of its documents has to fill. The budget is spread over the lengths
in proportion, and a bounded-knapsack dynamic programme over what the rounding
left picks the counts per length that come nearest to it. Which documents of a
length are taken is drawn by a seeded hash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from barline.llm.common import null_last, text_bytes
from barline.sources.tables import stage

#: Words that the dynamic programme covers; the proportional part leaves at most this much to it.
WINDOW = 1 << 16


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
    seed: int = 7,
    splits: int = 64,
) -> DataFrame:
    """How often each document goes into the mix.

    Sources in order of code point, NULL last, weigh ``weights`` in turn and share
    ``share`` times all words; no target passes ``cap`` times its source. Returns
    one row per row of ``docs``: ``doc_id``, ``source``, ``size``, ``source_size``,
    ``target``, ``copies`` (times taken) and ``taken`` (words).

    NULL and empty texts have size 0 and are never taken. A NULL source is a source.
    NULL and repeated ids are rows like any other. An empty table gives no rows.
    Columns besides the three named are not read.

    Nothing bigger than a source's table of lengths meets in one task: its rows are
    distinct lengths, at most the square root of twice the source's words. The list
    of sources (one row each) is ranked in one task.
    """
    named = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).alias("text")
    )
    sized = stage(_sizes(named), "mix-sizes")
    targets = _targets(sized, weights, share, cap)
    bucket = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(splits))
    keyed = sized.withColumns({"key": null_last("source"), "bucket": bucket})
    buckets = keyed.groupBy("key", "size", "bucket").agg(F.count("*").alias("n"))
    lengths = buckets.groupBy("key", "size").agg(F.sum("n").alias("n")).join(targets, "key")
    fitted = lengths.groupBy("key").applyInPandas(
        _fit_source, "key string, size long, source_size long, target double, epochs int, picked long"
    )
    # A length's documents are ordered by bucket, then by hash: whole buckets first.
    before = Window.partitionBy("key", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    picks = (
        buckets.join(fitted, ["key", "size"])
        .withColumn("left", F.col("picked") - F.coalesce(F.sum("n").over(before), F.lit(0)))
        .withColumn("picked", F.greatest(F.lit(0), F.least("left", "n")))
        .drop("left", "n")
    )
    drawn = Window.partitionBy("key", "size", "bucket").orderBy(F.xxhash64("doc_id", F.lit(seed + 1)), "doc_id")
    copies = (F.col("epochs") + (F.row_number().over(drawn) <= F.col("picked")).cast("int")).alias("copies")
    return (
        keyed.join(picks, ["key", "size", "bucket"])
        .select("doc_id", "source", "size", "source_size", "target", copies)
        .withColumn("taken", F.col("copies") * F.col("size"))
    )


def _sizes(named: DataFrame) -> DataFrame:
    kind = named.schema["doc_id"].dataType.simpleString()
    source = named.schema["source"].dataType.simpleString()

    def count(batches):
        for b in batches:
            sizes = pa.array([len(t.split()) for t in text_bytes(b, "text")], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("source"), sizes], ["doc_id", "source", "size"])

    return named.mapInArrow(count, f"doc_id {kind}, source {source}, size long")


def _targets(sized: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """One row per source. The level is where weights times level, cut at the caps, add up to the budget."""
    sources = sized.groupBy(null_last("source").alias("key")).agg(F.sum("size").alias("source_size"))
    nth = F.pmod(F.row_number().over(Window.orderBy("key")) - 1, F.lit(len(weights))) + 1
    ranked = sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), nth))
    most = cap * F.col("source_size")
    order = Window.orderBy(most / F.col("weight"), "key")
    everything = Window.partitionBy()
    full = F.coalesce(F.sum(most).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    budget = F.least(F.lit(share), F.lit(cap)) * F.sum("source_size").over(everything)
    return (
        ranked.withColumn("level", (budget - full) / open_weight)
        .withColumn("level", F.max("level").over(everything))
        .select("key", "source_size", F.least(most, F.col("weight") * F.col("level")).alias("target"))
    )


def _fit_source(lengths: pd.DataFrame) -> pd.DataFrame:
    out = lengths.sort_values("size").reset_index(drop=True)
    whole, target = int(out.source_size[0]), float(out.target[0])
    epochs = int(target // whole) if whole else 0
    out["epochs"] = np.where(out["size"] > 0, epochs, 0)
    out["picked"] = fit_counts(out["size"].to_numpy(), out["n"].to_numpy(), target - epochs * whole)
    return out[["key", "size", "source_size", "target", "epochs", "picked"]]


def fit_counts(sizes: np.ndarray, counts: np.ndarray, budget: float, window: int = WINDOW) -> np.ndarray:
    """How many documents of each size to take, at most ``counts``, so that their words come nearest to ``budget``."""
    counts = np.where(sizes > 0, counts, 0)
    whole = int(sizes @ counts)
    if whole == 0 or budget <= 0:
        return np.zeros_like(counts)
    exact = counts * min(1.0, budget / whole)
    taken = np.floor(exact).astype(np.int64)
    spare = counts - taken
    left = int(round(budget)) - int(sizes @ taken)
    for i in np.argsort(taken - exact, kind="stable"):  # largest fraction first
        if left <= window:
            break
        if spare[i] and sizes[i] <= left:
            taken[i] += 1
            spare[i] -= 1
            left -= int(sizes[i])
    for i in np.argsort(-sizes, kind="stable"):
        if left <= window:
            break
        n = min(int(spare[i]), left // int(sizes[i] or 1), -(-(left - window) // int(sizes[i] or 1)))
        taken[i] += n
        spare[i] -= n
        left -= n * int(sizes[i])
    return taken + _knapsack(sizes, spare, left, window)


def _knapsack(sizes: np.ndarray, spare: np.ndarray, left: int, window: int) -> np.ndarray:
    """Bounded knapsack: counts whose sum is nearest to ``left``, the smaller of two as near.

    Reachable sums are the bits of one integer; a size's count is split into
    powers of two. ``piece_of`` holds the piece by which a sum was first reached,
    so the sum less that piece was reached by earlier pieces only.
    """
    extra = np.zeros_like(spare)
    if left <= 0:
        return extra
    if left > window:  # only larger documents are spare: one of them, if that is nearer
        fits = np.flatnonzero(spare > 0)
        if len(fits) and sizes[fits].min() - left < left:
            extra[fits[np.argmin(sizes[fits])]] = 1
        return extra
    most = 2 * left
    mask, reached = (1 << (most + 1)) - 1, 1
    piece_of = np.full(most + 1, -1)
    pieces: list[tuple[int, int, int]] = []
    for i in np.argsort(-sizes, kind="stable"):
        rest, n = int(spare[i]), 1
        while rest and n * int(sizes[i]) <= most:
            n = min(n, rest)
            words = n * int(sizes[i])
            fresh = (reached << words) & mask & ~reached
            if fresh:
                bits = np.frombuffer(fresh.to_bytes(most // 8 + 1, "little"), np.uint8)
                piece_of[np.flatnonzero(np.unpackbits(bits, bitorder="little"))] = len(pieces)
                pieces.append((int(i), n, words))
                reached |= fresh
            rest -= n
            n *= 2
        if reached >> left & 1:
            break
    sums = np.concatenate([[0], np.flatnonzero(piece_of >= 0)])
    at = int(sums[np.argmin(np.abs(sums - left))])
    while at:
        i, n, words = pieces[piece_of[at]]
        extra[i] += n
        at -= words
    return extra
