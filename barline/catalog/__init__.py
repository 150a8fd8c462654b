"""All named queries and the SQL they are checked against."""

from importlib import import_module

from barline.catalog.registry import ORACLE, QUERIES

_AREAS = ["features", "sources", "dashboard", "merges", "forecasts", "streams"]


def _load() -> None:
    for area in _AREAS:
        import_module(f"barline.catalog.{area}")


def queries() -> dict:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(ORACLE)
