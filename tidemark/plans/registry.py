"""All registered queries over the driver's tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

FLAGSHIP = "measurement_daily_buckets"
QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register a function of (spark, sf_dir) and the SQL that must give the same rows."""

    def put(f: Callable) -> Callable:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return put


from tidemark.plans import entity_queries, feed_queries, invariant_queries, json_queries, measurement_queries, projection_queries, revision_queries, routing_queries, text_queries  # noqa: E402, F401
