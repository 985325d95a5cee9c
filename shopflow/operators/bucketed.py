"""Stored tables bucketed and sorted by their key (K6, K7, S10): joined without moving the stored side.

A catalog table of ``buckets`` buckets keeps the rows of a key in one file of each bucket.  A batch
is dealt to the same number of tasks by the same hash, and each task merges it with its
bucket; only the batch is shuffled, however large the stored table is.  Size the
buckets so that one fits a task (100 TB of counts: tens of thousands).

A key column may be NULL and equals NULL, as in the other table operators.  Hash
buckets do not serve null-safe equality, so rows with a NULL in the key take the plain operator beside.
"""

from __future__ import annotations

import functools
import operator
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopflow.operators import tables
from shopflow.operators.joins import lookup_with_default


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str) -> DataFrame:
    """(Re)write a catalog table of sorted buckets with its files at ``path``; returns the table.

    The rows are dealt by key first, so that each bucket is one file.
    """
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def _whole(keys: Sequence[str]) -> Column:
    return functools.reduce(operator.and_, [F.col(k).isNotNull() for k in keys])


def _merged(stored: DataFrame, delta: DataFrame, keys: Sequence[str], values: Sequence[str], merge) -> DataFrame:
    """Stored rows and the delta's, one row for each key: a full outer join of which only the delta is dealt."""
    cols, whole = [*keys, *values], _whole(keys)
    new = delta.where(whole).select(*[F.col(c).alias(f"__{c}") for c in cols], F.lit(True).alias("__new"))
    match = functools.reduce(operator.and_, [F.col(k) == F.col(f"__{k}") for k in keys])
    both = stored.where(whole).select(*cols, F.lit(True).alias("__old")).join(new, match, "full_outer")
    return both.select(*[F.coalesce(k, f"__{k}").alias(k) for k in keys],
                       *[merge(F.col(v), F.col(f"__{v}")).cast(stored.schema[v].dataType).alias(v) for v in values])


def upsert_add_bucketed(stored: DataFrame, delta: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """K6 on a bucketed table that holds each key once: existing key -> value + delta, new key -> inserted."""
    total = delta.groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values])
    plus = lambda a, b: F.when(F.col("__new").isNull(), a).when(F.col("__old").isNull(), b).when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)
    odd = tables.upsert_add(stored.where(~_whole(keys)), delta.where(~_whole(keys)), keys, values)
    return _merged(stored, total, keys, values, plus).unionByName(odd)


def upsert_replace_bucketed(stored: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K7 on a bucketed table that holds each key once: existing key -> delta's row, new key -> inserted."""
    values = [c for c in stored.columns if c not in keys]
    replace = lambda a, b: F.when(F.col("__new"), b).otherwise(a)
    odd = tables.upsert_replace(stored.where(~_whole(keys)), delta.where(~_whole(keys)), keys)
    return _merged(stored, delta, keys, values, replace).unionByName(odd)


def lookup_bucketed(batch: DataFrame, stored: DataFrame, keys: Sequence[str], value: str, default: int = 0) -> DataFrame:
    """S10 on a bucketed table: the stored value of each batch row's key; the batch goes to the buckets."""
    return lookup_with_default(batch, stored, keys, value, default)
