"""Registered queries: a callable over the test tables and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wearline.bindings import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Named starting points of the oracle texts, in dependency order.
_VIEWS = {
    "telemetry": (fx.TELEMETRY_SQL,),
    "labels": (fx.TELEMETRY_SQL, fx.LABELS_SQL),
    "prepared": (fx.TELEMETRY_SQL, fx.LABELS_SQL, fx.PREPARED_SQL),
    "feedback": (fx.FEEDBACK_SQL,),
    "grouped_feedback": (fx.GROUPED_FEEDBACK_SQL,),
    "requests": (fx.REQUESTS_SQL,),
    "registry": (fx.REGISTRY_SQL,),
    "triggers": (fx.TRIGGERS_SQL,),
}


def oracle(body: str, *views: str, ctes: tuple[str, ...] = (), recursive: bool = False) -> str:
    """`body` behind the named fixture views and extra common table expressions."""
    texts: list[str] = []
    for v in views:
        texts += [t for t in _VIEWS[v] if t not in texts]
    texts += list(ctes)
    return f"with {'recursive ' if recursive else ''}{','.join(texts)}\n{body}" if texts else body


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under `name`; `sql` is its oracle."""
    def keep(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return keep
