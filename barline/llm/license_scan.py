"""License scan by an exact set-similarity join of text blocks with license templates.

Tokens are ordered by how often the whole corpus has them, rarest first. A block
that holds enough of a template's tokens holds one of its rarest (prefix filter);
it must be long enough (length filter); and after the first common token of the
order only the tokens that follow can still be common (positional filter). What
passes is counted exactly. Blocks are all runs of so many words, wherever they begin:
around each prefix token a window slides from one of the template's tokens to the next.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from barline.llm.common import LETTERS, text_bytes


@dataclass(frozen=True)
class Template:
    """``threshold``: share of the distinct words that a block must hold. ``exact``: and consecutively."""

    label: str
    text: str
    threshold: float = 0.85
    exact: bool = False


# The phrases that are counted.
BASE = [
    Template("mit", "under the mit license", 1.0, True),
    Template("apache-2", "apache license version 2", 1.0, True),
    Template("cc-by-nc", "cc by nc", 1.0, True),
]
# Opening words of well-known licenses.
MORE = [
    Template("gpl-3", "licensed under the gnu general public license version 3"),
    Template("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    Template("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("apache-2-notice", "licensed under the apache license version 2 0 you may not use this file except in compliance with the license"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
]


def token_counts(docs: DataFrame, tokens: set[bytes], text_col: str = "text") -> dict[bytes, int]:
    """How often the corpus has each of the templates' tokens. At most one row per token reaches the driver."""

    def count(batches):
        n = dict.fromkeys(tokens, 0)
        for b in batches:
            for text in text_bytes(b, "text"):
                for word in text.translate(LETTERS).split():
                    if word in n:
                        n[word] += 1
        found = [(w, c) for w, c in n.items() if c]
        if found:
            words, counts = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(counts, pa.int64())], ["token", "n"])

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "token binary, n long")
    return {bytes(r.token): r.n for r in counted.groupBy("token").agg(F.sum("n").alias("n")).collect()}


def license_scan(
    docs: DataFrame, templates: list[Template], *, id_col: str = "doc_id", text_col: str = "text", block: int = 64
) -> DataFrame:
    """Per row ``doc_id``, ``n_words`` and ``found``: (``label``, ``start``, ``end``, ``score``) of each match.

    A word is a run of ASCII letters, digits and other characters beyond ASCII, A-Z
    lower-cased. For an exact template each place of its words is a match; for the
    others every ``block`` words in a row in which at least ``threshold`` of its words occur,
    wherever they begin: of such that overlap in a run, the one with most; ``start``
    and ``end`` (exclusive) count words, and ``score`` is the share of the template's
    words that occur. ``block`` grows to twice the longest template if it is less.
    NULL and empty texts have no words and no match; NULL and repeated ids and
    repeated rows are scanned each by itself. An empty table gives no rows. Columns
    besides the two named are not read.
    """
    split = [t.text.encode().translate(LETTERS).split() for t in templates]
    block = max([block, *(2 * len(words) for words in split)])
    counts = token_counts(docs, {w for words in split for w in words}, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    orders = _orders(templates, split, counts)
    index = _prefix_index(orders)

    def scan(batches):
        for b in batches:
            sizes, found = [], []
            for text in text_bytes(b, "text"):
                words = text.translate(LETTERS).split()
                sizes.append(len(words))
                found.append(_matches(words, templates, orders, index, block))
            kinds = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(sizes, pa.int64()), pa.array(found, kinds)], ["doc_id", "n_words", "found"]
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(
        scan, f"doc_id {kind}, n_words long, found array<struct<label:string,start:long,end:long,score:double>>"
    )


class Order(NamedTuple):
    """A template's distinct tokens, rarest of the corpus first, by rank; how many to reach; and its words."""

    rank: dict[bytes, int]
    least: int
    words: list[bytes]


def _orders(templates: list[Template], split: list[list[bytes]], counts: dict[bytes, int]) -> list[Order]:
    out = []
    for template, words in zip(templates, split):
        tokens = sorted(set(words), key=lambda w: (counts.get(w, 0), w))
        least = math.ceil(template.threshold * len(tokens) - 1e-9)
        out.append(Order({w: i for i, w in enumerate(tokens)}, least, words))
    return out


def _prefix_index(orders: list[Order]) -> dict[bytes, list[int]]:
    """Token to the templates in whose prefix it is: a window that reaches the overlap holds a token of the prefix."""
    index: dict[bytes, list[int]] = {}
    for t, order in enumerate(orders):
        for token, rank in order.rank.items():
            if rank <= len(order.rank) - order.least:
                index.setdefault(token, []).append(t)
    return index


def _matches(words: list[bytes], templates: list[Template], orders: list[Order], index: dict, block: int) -> list[dict]:
    places: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        if w in index:
            for t in index[w]:
                places.setdefault(t, []).append(i)
    found = []
    for t, at in places.items():
        hits = _exact(words, at, orders[t]) if templates[t].exact else _windows(words, at, orders[t], block)
        found += [{"label": templates[t].label, "start": s, "end": e, "score": score} for s, e, score in hits]
    return sorted(found, key=lambda f: (f["start"], f["end"], f["label"]))


def _exact(words: list[bytes], at: list[int], order: Order) -> Iterator[tuple[int, int, float]]:
    """Where all of the template's words stand in a row; its rarest word is at one of the places."""
    n, starts = len(order.words), set()
    for i in at:
        starts.update(i - k for k, w in enumerate(order.words) if w == words[i])
    for s in sorted(starts):
        if s >= 0 and words[s : s + n] == order.words:
            yield s, s + n, 1.0


def _windows(words: list[bytes], at: list[int], order: Order, block: int) -> Iterator[tuple[int, int, float]]:
    """The best window of each run of windows that reach the overlap and meet one another.

    A window may as well begin at one of the template's tokens. Only those around a
    prefix token are looked at, in stretches; a stretch whose tokens are too few
    (length), or too late in the order (position), holds no match.
    """
    rank, least, size = order.rank, order.least, len(order.rank)
    stretches: list[list[int]] = []
    for i in at:
        if stretches and i - block < stretches[-1][1]:
            stretches[-1][1] = i + block
        else:
            stretches.append([max(0, i - block + 1), i + block])
    best = None
    for low, high in stretches:
        met = [(i, rank[w]) for i, w in enumerate(words[low:high], low) if w in rank]
        held = {r for _, r in met}
        if len(held) < least or size - min(held) < least:
            continue
        times, last, distinct = [0] * size, 0, 0
        for start, r in met:
            while last < len(met) and met[last][0] < start + block:
                times[met[last][1]] += 1
                distinct += times[met[last][1]] == 1
                last += 1
            if distinct >= least:
                if best is not None and start >= best[3]:
                    yield best[:3]
                    best = None
                end, score = min(start + block, len(words)), distinct / size
                if best is None or score > best[2]:
                    best = (start, end, score, end)
                else:
                    best = (*best[:3], end)
            times[r] -= 1
            distinct -= times[r] == 0
    if best is not None:
        yield best[:3]
