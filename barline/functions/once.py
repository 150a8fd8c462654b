"""Columns that are computed once, whatever is filtered on them later."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def with_computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``withColumns`` for expensive expressions such as JSON parses.

    The optimizer moves a filter below a projection by copying the projected
    expression into it, which would run a parse once per mention. It does not
    move filters below a generator, so the columns go through a one-element
    ``inline``.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline_outer(F.array(row)))
