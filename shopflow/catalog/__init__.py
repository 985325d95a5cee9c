"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator or job, with an independent DuckDB SQL oracle for each.

The modules register their queries on import, in this order.
"""

from shopflow.catalog import area, sessions, funnel, ads, text, functions, streams, stream_state, sinks, stored  # noqa: F401
from shopflow.catalog.registry import ORACLES, QUERIES, register  # noqa: F401
