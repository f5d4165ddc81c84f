"""All queries of the title-block part."""

from __future__ import annotations

from .plans import box_queries, record_queries, text_queries  # noqa: F401  (they register themselves)


def queries() -> dict:
    return dict(text_queries.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(text_queries.SQL)
