"""The query registry: ``register`` adds a callable ``(spark, sf_dir) ->
DataFrame`` and, where the result is expressible in SQL, its DuckDB oracle.

Every registered query reads whole tables (through the input views of
``sources/views.py``); none caps, samples or subsets rows.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from shopflow.config import ensure_utc
from shopflow.params import DEFAULT_PARAMS as P  # noqa: F401  (shared by the modules)

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            return fn(spark, sf_dir)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return deco


DATES = f"date between '{P.start_date}' and '{P.end_date}'"
# S1 on its own shows the date-window scan with a window inside the data.
S1_START, S1_END = "2024-01-05", "2024-01-25"
