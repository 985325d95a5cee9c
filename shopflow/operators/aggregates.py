"""Aggregate expressions and small aggregation operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def group_concat_distinct(c: Column | str, sep: str = ",") -> Column:
    """A5: the distinct values of a group, sorted, joined by ``sep``.

    ``collect_set`` is partially aggregated on the map side, so a hot group
    ships one set per map task; the set is bounded by the number of distinct
    values, never by the number of rows.  NULLs are skipped.
    """
    return F.array_join(F.array_sort(F.collect_set(_col(c))), sep)


def count_by(df: DataFrame, keys: list[str], name: str = "click_count") -> DataFrame:
    """Rows per key (map-side partial count, then final merge)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of one column."""
    return df.select(col).distinct()


def with_task_id(df: DataFrame, task_id: str | None) -> DataFrame:
    """Prepend the caller's task id as a ``taskid`` column (result tables of
    the reference carry one); unchanged when ``task_id`` is None."""
    if task_id is None:
        return df
    return df.select(F.lit(task_id).alias("taskid"), *df.columns)
