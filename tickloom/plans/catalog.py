"""Every query by name, with the SQL that DuckDB runs beside it."""

from __future__ import annotations

from tickloom.plans import base
from tickloom.plans import book_queries, indicator_queries, option_queries, relational_queries, table_queries  # noqa: F401


def queries() -> dict[str, base.Query]:
    return dict(base.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(base.ORACLES)
