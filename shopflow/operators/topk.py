"""Per-group top-n.

``row_number() <= n`` over a window: Spark plans this as a partial
``WindowGroupLimit`` before the shuffle and a final one after it, so a group
never ships more than ``n`` rows per map task, even when one group holds a
large share of the data.  The order list must end in a unique column so ties
are broken the same way on every run.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(
    df: DataFrame,
    partition_by: Sequence[str | Column],
    order_by: Sequence[str | Column],
    n: int,
    rank_col: str | None = None,
) -> DataFrame:
    """Keep the first ``n`` rows per group in ``order_by`` order.

    With ``rank_col`` the 1-based position is kept as a column.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    name = rank_col or "__rn"
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= F.lit(n))
    return out if rank_col else out.drop(name)
