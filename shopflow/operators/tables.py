"""Table maintenance as DataFrame operators (K6-K9).

Each takes the stored table and a batch and returns the new table; none
reads a row per key.  A key column that is NULL equals NULL, as in K6's grouping.
"""

from __future__ import annotations

import functools
import operator
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert_add(stored: DataFrame, delta: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """K6: existing key -> value + delta, new key -> inserted.

    A union and one aggregation; the partial aggregate merges each map task's
    rows of a key first, so a hot key costs one row per task in the shuffle.
    """
    cols = [*keys, *values]
    both = stored.select(*cols).unionByName(delta.select(*cols))
    aggs = [F.sum(v).cast(stored.schema[v].dataType).alias(v) for v in values]
    return both.groupBy(*keys).agg(*aggs)


def without_keys(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``other``; NULL equals NULL (an anti join)."""
    side = other.select(*[F.col(k).alias(f"__{k}") for k in keys])
    match = functools.reduce(operator.and_, [df[k].eqNullSafe(side[f"__{k}"]) for k in keys])
    return df.join(side, match, "left_anti")


def upsert_replace(stored: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K7: existing key -> delta's row, new key -> inserted."""
    return without_keys(stored, delta, keys).unionByName(delta.select(*stored.columns))


def replace_groups(stored: DataFrame, batch: DataFrame, group_keys: Sequence[str]) -> DataFrame:
    """K8: drop every stored row of the groups present in ``batch``, then add ``batch``."""
    kept = without_keys(stored, batch.select(*group_keys).distinct(), group_keys)
    return kept.unionByName(batch.select(*stored.columns))


def insert_new(stored: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K9: add the keys of ``new`` not stored yet (idempotent)."""
    fresh = new.select(*stored.columns).dropDuplicates(list(keys))
    return stored.unionByName(without_keys(fresh, stored, keys))
