
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from auriga.plans.cases import Cases
from auriga.plans.oracle_tables import compose


@dataclass(frozen=True)
class Query:
    build: Callable[[Cases], DataFrame]
    sql: str | None


def catalogue() -> dict[str, Query]:
    from auriga.plans.catalog import checks, ingest, metrics, risk, tables, texts

    queries: dict[str, Query] = {}

    def add(name: str, build: Callable[[Cases], DataFrame], sql: str | None = None, **extra: str) -> None:
        queries[name] = Query(build, compose(sql, extra) if sql else None)

    for module in (tables, metrics, checks, texts, risk, ingest):
        module.register(add)
    return queries
