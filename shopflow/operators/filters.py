"""Optional-parameter filters.

Every filter follows the reference's rule: an unset parameter lets every row
pass; a set parameter fails rows whose data is missing.  Each returns a
``Column`` predicate so that the conjunction stays one expression that
Catalyst can push down or fold; nothing runs in Python per row.
"""

from __future__ import annotations

import functools
import operator
from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopflow.params import TaskParams


def _true() -> Column:
    return F.lit(True)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def between_filter(c: Column | str, lo: int | None, hi: int | None) -> Column:
    """``lo <= c <= hi``; passes when either bound is unset; NULL fails."""
    if lo is None or hi is None:
        return _true()
    return F.coalesce(_col(c).between(F.lit(lo), F.lit(hi)), F.lit(False))


def any_of_filter(c: Column | str, values: Iterable[str], is_array: bool = False) -> Column:
    """some data value equals some parameter value (compared as text).

    ``c`` is a scalar column or, with ``is_array``, an array column.  Unset
    (empty) parameters pass; NULL data, or the ``-1`` sentinel, fails.
    """
    vals = [str(v) for v in values]
    if not vals:
        return _true()
    col = _col(c)
    if is_array:
        as_text = F.transform(col, lambda x: x.cast("string"))
        hit = F.arrays_overlap(F.filter(as_text, lambda x: x != F.lit("-1")), F.array(*[F.lit(v) for v in vals]))
    else:
        text = col.cast("string")
        hit = (text != F.lit("-1")) & text.isin(*vals)
    return F.coalesce(hit, F.lit(False))


def equal_filter(c: Column | str, value: str | None) -> Column:
    """``c = value``; passes when unset, NULL fails."""
    if value is None or value == "":
        return _true()
    return F.coalesce(_col(c).cast("string") == F.lit(str(value)), F.lit(False))


def conjunction(conds: Iterable[Column]) -> Column:
    return functools.reduce(operator.and_, conds, _true())


def session_filter(params: TaskParams) -> Column:
    """the session job's filter over age, profession, city, sex, keywords
    and clicked categories, from a session row joined with its user."""
    return conjunction([
        between_filter("age", params.start_age, params.end_age),
        any_of_filter("professional", params.professionals),
        any_of_filter("city", params.cities),
        equal_filter("sex", params.sex),
        any_of_filter("search_keywords", params.keywords, is_array=True),
        any_of_filter("click_category_ids", params.category_ids, is_array=True),
    ])


def apply_session_filter(sessions: DataFrame, params: TaskParams) -> DataFrame:
    return sessions.where(session_filter(params))


def date_range(df: DataFrame, start: str, end: str, col: str = "date") -> DataFrame:
    """Inclusive date range on ``yyyy-MM-dd`` text; reaches the parquet
    scan as pushed filters when ``date`` is a stored column."""
    return df.where(F.col(col).between(F.lit(start), F.lit(end)))


def sentinel_to_null(c: Column | str, sentinel: int = -1) -> Column:
    """``-1`` means "none" in the click columns; make it NULL."""
    return F.nullif(_col(c), F.lit(sentinel).cast(T.LongType()))
