"""Tables partitioned by date: replacing only the dates that a batch touches (K8), and scans that open only the dates asked for."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.operators.tables import replace_groups


def replace_groups_partitioned(path: str, batch: DataFrame, group_keys: Sequence[str], staging: str, date: str = "date") -> None:
    """K8 on a Parquet table partitioned by ``date``: the groups in ``batch`` are replaced; files of other dates stay as they are.

    The touched dates' new content is written to ``staging`` first, then put in their place by a
    dynamic partition overwrite.  A call that is repeated after a failure with the
    same ``staging`` takes what is there, so it may be repeated at any point and any number of times.
    ``group_keys`` must include ``date``.
    """
    if date not in group_keys:
        raise ValueError("a group lies within a date")
    spark = batch.sparkSession
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{staging}/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        stored = spark.read.schema(batch.schema).parquet(path).select(*batch.columns)
        dates = batch.select(F.col(date).alias("__date")).distinct()
        touched = stored.join(dates, stored[date].eqNullSafe(F.col("__date")), "left_semi")
        new = replace_groups(touched, batch, group_keys)
        new.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(staging)
    rows = spark.read.schema(batch.schema).parquet(staging)
    (rows.hint("rebalance", date).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date).parquet(path))


def rows_of_dates(table: DataFrame, dates: DataFrame, date: str = "date") -> DataFrame:
    """Rows of the dates in ``dates``, found while the query runs: the dates are read first and only their partitions opened."""
    return table.join(dates.select(date).distinct(), date, "left_semi")
