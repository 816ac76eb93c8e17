"""Where the query modules put their jobs and the SQL that checks them."""
from __future__ import annotations

import importlib
import pkgutil
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewater.session import prepare

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register ``fn(spark, sf_dir)`` under ``key``, with its checking SQL if one exists."""

    def register(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"query {key!r} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        run.__name__ = key
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = sql
        return run

    return register


def load_all() -> None:
    """Import every plan module once, so that all queries are registered."""
    import tidewater.plans as plans

    for module in pkgutil.iter_modules(plans.__path__):
        if module.name != "registry":
            importlib.import_module(f"tidewater.plans.{module.name}")
