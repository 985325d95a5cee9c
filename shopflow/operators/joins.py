"""Join helpers: size-checked broadcast, anti-join filter, lookup with default.

Broadcasting is decided on the optimizer's size estimate of the side to
ship, against the session's ``spark.sql.autoBroadcastJoinThreshold`` unless a
bound is given.  Above the bound the join stays a shuffle join; AQE may still
turn it into a broadcast at runtime when the shuffled side proves small, and
splits skewed partitions of a sort-merge join (``spark.sql.adaptive.skewJoin``).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
          "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}


def parse_bytes(text: str) -> int:
    """``'10485760b'``, ``'10MB'``, ``'-1'`` -> bytes (Spark's byte-size syntax)."""
    t = text.strip().lower()
    num = t.rstrip("kmgtb")
    return int(float(num) * _UNITS[t[len(num):]])


def broadcast_bound(spark) -> int:
    """The session's broadcast bound in bytes (``spark.sql.autoBroadcastJoinThreshold``,
    10 MB by default; -1 disables broadcasting)."""
    return parse_bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB"))


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate of a plan, or None if unknown."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return int(str(size))
    except Exception:  # pragma: no cover - estimate unavailable
        return None


def fits_broadcast(df: DataFrame, max_bytes: int | None = None) -> bool:
    """True when the optimizer's size estimate of ``df`` is known and within
    ``max_bytes`` (default: the session's broadcast bound)."""
    limit = max_bytes if max_bytes is not None else broadcast_bound(df.sparkSession)
    if limit < 0:
        return False
    size = estimated_bytes(df)
    return size is not None and size <= limit


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Mark ``df`` for broadcast only when its estimated size is within bound."""
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df


def exclude_keys(df: DataFrame, excluded: DataFrame, keys: Sequence[str], max_broadcast: int | None = None) -> DataFrame:
    """Rows of ``df`` whose key is not in ``excluded`` (left anti join)."""
    side = broadcast_if_small(excluded.select(*keys).distinct(), max_broadcast)
    return df.join(side, list(keys), "left_anti")


def lookup_with_default(
    df: DataFrame, stored: DataFrame, keys: Sequence[str], value: str, default: int = 0, alias: str | None = None
) -> DataFrame:
    """Attach ``stored.value`` by key, ``default`` when absent.

    One hash or sort-merge join replaces the reference's query per key.
    """
    side = stored.select(*keys, F.col(value).alias("__v"))
    out = df.join(side, list(keys), "left")
    return out.withColumn(alias or value, F.coalesce(F.col("__v"), F.lit(default))).drop("__v")
