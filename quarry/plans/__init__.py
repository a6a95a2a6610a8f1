"""Registered queries over the driver's tables, each with its SQL twin where one exists."""

from quarry.plans.registry import QUERIES, SQL


def _load() -> None:
    from quarry.plans import closed, geometry, language, learning, models, tabular  # noqa: F401


def all_queries():
    _load()
    return dict(QUERIES)


def all_sql():
    _load()
    return dict(SQL)
