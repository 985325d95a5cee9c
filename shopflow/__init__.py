"""shopflow: online-shop behaviour analytics written on the Spark DataFrame,
SQL and Structured Streaming APIs.

Layout
------
sources/    table readers, the derived input views, ad-log reader, text lines
functions/  scalar column functions (dates, strings, JSON, rounding)
operators/  reusable DataFrame -> DataFrame operators (filters, top-n,
            consecutive pairs, distinct concat, table maintenance, joins)
plans/      the analytics jobs: session ratios, page conversion, area top-3,
            advertising statistics, word counts, top-1 per key
streaming/  the same jobs as Structured Streaming queries
catalog/    the registered queries with their DuckDB oracle SQL
cli.py      one command per job, as the reference's programs ran
"""

from shopflow.config import build_session, work_dir, ensure_utc  # noqa: F401
from shopflow.params import TaskParams  # noqa: F401

__all__ = ["build_session", "work_dir", "ensure_utc", "TaskParams"]
