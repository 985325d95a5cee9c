"""Q9/Q10: word counts of text lines, and Q8: top-1 row per key.

Lines are split on single spaces with Java's rules (functions/strings.py).
The batch count keeps empty tokens, as a plain ``split(" ")`` does; the
streaming count drops them.  Counting is a hash aggregate with a map-side
partial step, so a very frequent word costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.functions.strings import java_split_space
from shopflow.operators.topk import top_n


def tokens(lines: DataFrame, line_col: str = "line", keep_empty: bool = True) -> DataFrame:
    """X17 + explode: one row per token of every line."""
    words = lines.select(F.explode(java_split_space(line_col)).alias("word"))
    return words if keep_empty else words.where(F.col("word") != F.lit(""))


def word_count(lines: DataFrame, line_col: str = "line", keep_empty: bool = True) -> DataFrame:
    """(word, count) over all lines."""
    return tokens(lines, line_col, keep_empty).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def text_file_lines(spark, path: str) -> DataFrame:
    """One row per line of text files (column ``line``)."""
    return spark.read.option("lineSep", "\n").text(path).withColumnRenamed("value", "line")


def delimited_rows(lines: DataFrame, ddl: str, sep: str = ",", line_col: str = "value") -> DataFrame:
    """Rows from delimited text with an explicit schema (no inference).

    Fields that do not fit the type become NULL (``mode`` PERMISSIVE).
    """
    parsed = F.from_csv(F.col(line_col), ddl, {"sep": sep, "mode": "PERMISSIVE"})
    return lines.select(parsed.alias("r")).select("r.*")


def top1_per_key(df: DataFrame, key: str = "id", order_col: str = "age", tie_col: str = "name") -> DataFrame:
    """The row with the highest ``order_col`` per ``key`` (ties: smaller ``tie_col``)."""
    return top_n(df, [key], [F.desc(order_col), F.asc(tie_col)], 1)
