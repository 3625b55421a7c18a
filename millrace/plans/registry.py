"""Name -> (Spark callable, SQL text or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.session import configure

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def register(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the equivalent over views of the same tables."""

    def wrap(fn: Query) -> Query:
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        REGISTRY[name] = (run, sql)
        return fn

    return wrap
