"""Running word count of a text stream (empty tokens dropped)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shopflow.plans.words import word_count
from shopflow.sources.store import ResultTable, summed
from shopflow.streaming.ads import start_batches

WORD_COUNT_SCHEMA = T.StructType([
    T.StructField("word", T.StringType(), True),
    T.StructField("count", T.LongType(), True),
])


def start_word_count(lines: DataFrame, table: ResultTable, checkpoint: str,
                     trigger: dict | None = None) -> StreamingQuery:
    """F9 + A11 on a stream: each batch adds the counts of its own words to the table."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        table.write(word_count(batch, "line", keep_empty=False), batch_id)
    return start_batches(lines, fn, checkpoint, trigger)


def read_word_count(table: ResultTable) -> DataFrame:
    """The running counts: all batches added up."""
    return summed(table.rows(), ["word"], "count")
