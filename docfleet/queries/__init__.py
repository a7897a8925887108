"""Registry of runnable queries: name -> (Spark callable, DuckDB statement or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from docfleet.plans.views import Source, duck_sql


@dataclass(frozen=True)
class Query:
    name: str
    item: str  # inventory id(s) it shows
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(item: str, sql: str | None = None):
    """Register a function ``(v) -> DataFrame``, with ``v`` a :class:`Source`."""

    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Source(spark, sf_dir))

        if fn.__name__ in REGISTRY:
            raise ValueError(f"query {fn.__name__} is registered twice")
        REGISTRY[fn.__name__] = Query(fn.__name__, item, run, duck_sql(sql) if sql else None)
        return fn

    return add


def load_all() -> dict[str, Query]:
    from docfleet.queries import documents, files, history, hygiene, live, lookups, status  # noqa: F401

    return REGISTRY
