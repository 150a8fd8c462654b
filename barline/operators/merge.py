"""Keyed merges as pure functions ``(target, source) -> merged``.

All are equality joins on the table's natural key, which spreads over its
parts: one large ticker is many keys. NULL key parts never match, as in a SQL
unique constraint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def dedup_source(source: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the last by ``order``, then by all other columns.

    An aggregate, so any number of copies of one key is reduced before the
    shuffle. Rows with a NULL key part are different keys and all stay.
    """
    rest = [c for c in source.columns if c not in keys]
    complete = _all_set(keys)
    best = F.max_by(F.struct(*rest), F.struct(*order, *rest)).alias("best")
    kept = source.filter(complete).groupBy(*keys).agg(best).select(*keys, "best.*")
    return kept.select(*source.columns).unionByName(source.filter(~complete))


def duplicate_keys(source: DataFrame, keys: list[str]) -> DataFrame:
    """Keys the source holds more than once."""
    return (
        source.filter(_all_set(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    *,
    keep: list[str] = (),
    touch: dict[str, Column] | None = None,
    on_insert: dict[str, Column] | None = None,
) -> DataFrame:
    """Last writer wins.

    Matched rows take every source column except ``keep`` (the stored value
    stays) and get ``touch`` values; ``on_insert`` fills columns the source does
    not carry on new rows. The source must hold one row per key.
    """
    touch, on_insert = touch or {}, on_insert or {}

    def merged(c: str, t: Column | None, s: Column | None, matched: Column, new: Column) -> Column:
        given = s if s is not None else on_insert.get(c, F.lit(None))
        if c in touch:
            fresh = touch[c]
        elif c in keep or s is None:
            fresh = t
        else:
            fresh = s
        return F.when(matched, fresh).when(new, given).otherwise(t)

    return _full_join(target, source, keys, merged)


def coalesce_merge(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Stored values win; the source fills NULLs and adds new keys."""

    def merged(c, t, s, matched, new):
        return t if s is None else F.coalesce(t, s)

    return _full_join(target, source, keys, merged)


def replace_by_key(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Delete matching keys, insert the source; columns it lacks become NULL."""
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.unionByName(source, allowMissingColumns=True).select(*target.columns)


def fill_from(
    target: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    column: str,
    value: str,
    only: Column | None = None,
) -> DataFrame:
    """Set ``column`` from ``lookup.value`` where it is NULL (and ``only`` holds).

    ``lookup`` holds one row per key.
    """
    found = lookup.select(*keys, F.col(value).alias("_found"))
    wanted = F.col(column).isNull() if only is None else F.col(column).isNull() & only
    joined = target.join(found, keys, "left")
    filled = F.when(wanted, F.col("_found")).otherwise(F.col(column))
    return joined.withColumn(column, filled).select(*target.columns)


def _all_set(keys: list[str]) -> Column:
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).isNotNull()
    return condition


def _full_join(target: DataFrame, source: DataFrame, keys: list[str], merged) -> DataFrame:
    t = target.withColumn("_t", F.lit(True)).alias("t")
    s = source.withColumn("_s", F.lit(True)).alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    both = t.join(s, on, "full_outer")
    matched = F.col("_t").isNotNull() & F.col("_s").isNotNull()
    new = F.col("_t").isNull()
    columns = []
    for c in target.columns:
        if c in keys:
            columns.append(F.when(new, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
            continue
        s_col = F.col(f"s.{c}") if c in source.columns else None
        columns.append(merged(c, F.col(f"t.{c}"), s_col, matched, new).alias(c))
    return both.select(*columns)
