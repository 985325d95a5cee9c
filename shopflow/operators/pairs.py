"""Consecutive-row pairs within a group (W4, O1), safe under skew.

A plain ``lead()`` over ``Window.partitionBy(group)`` puts a whole group into
one task; a single session holding a third of all rows would then be one
straggler.  Here a row also has a slice, a number computed from the row itself
that never falls along the group's order (a fixed-width piece of its time).  The rows are
shuffled once, by (group, slice), so a hot group is spread over as many tasks as it has
slices; ``lead()`` gives the pairs inside a slice.  The pair that crosses
slices is stitched from the last row of one slice and the first row of
the group's next one: a second, narrow shuffle of one row for each (group, slice).

The slices' width changes the cost only, never the result: narrower ones split
a hot group further and cost more edge rows.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE = "__slice"


def sliced_rows(df: DataFrame, group_col: str, slice_col: Column, order_cols: Sequence[str], value_col: str) -> DataFrame:
    """Rows with ``next`` (the value that follows in the slice), ``is_first`` and ``is_last`` of the slice.

    ``order_cols`` must order rows uniquely within a group (end it with an id);
    NULL sorts first.  ``slice_col`` must not fall along that order; a NULL slice comes first.
    """
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    rows = df.select(group_col, slice_col.alias(SLICE), *order_cols, F.col(value_col).alias("value"))
    clustered = rows.repartition(group_col, SLICE)  # the one shuffle of all rows
    w = Window.partitionBy(group_col, SLICE).orderBy(*order)
    return clustered.select(
        group_col, SLICE, "value", F.lead("value").over(w).alias("next"),
        F.row_number().over(w).alias("__n"), F.lead(F.lit(True)).over(w).alias("__more"),
    ).select(group_col, SLICE, "value", "next", (F.col("__n") == 1).alias("is_first"), F.col("__more").isNull().alias("is_last"))


def stitched_edges(rows: DataFrame, group_col: str) -> DataFrame:
    """(group, value, next) of the pairs that cross slices, from ``sliced_rows``."""
    edges = rows.where("is_first or is_last").groupBy(group_col, SLICE).agg(
        F.max(F.when(F.col("is_first"), F.col("value"))).alias("__first"),
        F.max(F.when(F.col("is_last"), F.col("value"))).alias("value"))
    along = Window.partitionBy(group_col).orderBy(F.col(SLICE).asc_nulls_first())
    return edges.select(group_col, "value", F.lead("__first").over(along).alias("next")).where(F.col("next").isNotNull())


def consecutive_pairs(
    df: DataFrame,
    group_col: str,
    slice_col: Column,
    order_cols: Sequence[str],
    value_col: str,
    prev_name: str = "from_value",
    next_name: str = "to_value",
) -> DataFrame:
    """One row ``(group, prev, next)`` per pair of consecutive rows of a group."""
    rows = sliced_rows(df, group_col, slice_col, order_cols, value_col)
    inner = rows.where(F.col("next").isNotNull()).select(group_col, "value", "next")
    pairs = inner.unionByName(stitched_edges(rows, group_col))
    return pairs.select(group_col, F.col("value").alias(prev_name), F.col("next").alias(next_name))
