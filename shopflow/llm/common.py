"""Helpers shared by the operators: worker memo, written steps, piece-wise tokenization."""

from __future__ import annotations

import ctypes
import functools
import os
import re
import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopflow.config import fresh_dir

#: Texts are handed to a tokenizer in slices of at most this many characters.
SLICE_CHARS = 4_000_000
#: Bytes of an Arrow batch that goes to Python; Spark's own limit is 64 MB, which a task holds several times over (JVM and Python).
BATCH_BYTES = 4 << 20
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def worker_memo(key, make: Callable):
    """``make()`` once per Python worker process (tokenizers and memo tables are slow to build).

    Workers outlive a step, so only the latest key's value is kept: the next step's tables take its place.
    """
    store = sys.modules.setdefault("_shopflow_llm_memo", types.ModuleType("_shopflow_llm_memo"))
    if getattr(store, "key", None) != key:
        store.key = store.value = None  # freed before the new one is made
        store.value = make()
        store.key = key
    return store.value


@functools.cache
def _c_library() -> ctypes.CDLL | None:
    try:
        return ctypes.CDLL(None)
    except (OSError, TypeError):
        return None


def give_back() -> None:
    """Memory that this process has freed goes back to the system, where the C library can be told to."""
    trim = getattr(_c_library(), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _released(run: Callable) -> Callable:
    """``run`` with freed memory given back, Arrow's after each batch, the C library's after the last one.

    Both would keep it, also in workers that wait for a task.
    """
    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool = pa.default_memory_pool()
        for out in run(given):
            yield out
            out = None
            pool.release_unused()
        pool.release_unused()
        give_back()
    return batches


def map_batches(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` in batches of about ``BATCH_BYTES``, or of the limit that the session has been given (a longer row is a batch)."""
    conf = df.sparkSession.conf
    if BATCH_LIMIT not in conf.getAll:
        conf.set(BATCH_LIMIT, str(BATCH_BYTES))
    return df.mapInArrow(_released(run), schema)


def written(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back (cuts the lineage)."""
    path = fresh_dir(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def free_names(taken: list[str], *names: str) -> list[str]:
    """``names``, each with as many underscores before it as it takes to differ from all ``taken`` (case aside)."""
    taken, out = {t.lower() for t in taken}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(columns: list[str]) -> list[str]:
    """Column names as they may be selected, whatever signs are in them."""
    return ["`" + c.replace("`", "``") + "`" for c in columns]


def kept_and_text(docs: DataFrame, keep: list[str], text: str) -> tuple[DataFrame, int]:
    """The columns ``keep`` as ``c0``, ``c1``, ... with ``text`` after them, and the place of ``text``; a text that is kept is not sent twice."""
    columns = [F.col(c).alias(f"c{i}") for i, c in enumerate(quoted(keep))]
    if text in keep and text.isidentifier():
        return docs.select(*columns), keep.index(text)
    return docs.select(*columns, F.col(text).alias("__text")), len(keep)


def least_hashes(rows: DataFrame, group: str, hash_: str, n: int) -> DataFrame:
    """The ``n`` rows of least ``hash_`` (evenly spread over 64 bits) of each ``group``, of which there must be few.

    Each group's count says how low its least hashes lie, so only about 2 ``n`` rows of it are
    ranked, whatever the table's size.
    """
    counts = rows.groupBy(F.col(group).alias("__g")).agg(F.count("*").alias("__n"))
    low = (2.0 * n + 50) / F.col("__n")
    near = rows.join(F.broadcast(counts), F.col(group) == F.col("__g")).where(F.col(hash_) / F.lit(2.0**64) + 0.5 < low)
    rank = F.row_number().over(Window.partitionBy(group).orderBy(hash_))
    return near.withColumn("__r", rank).where(F.col("__r") <= n).select(*rows.columns)


def slices(texts: list[str], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` characters in all."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def text_list(column: pa.Array) -> list[str]:
    """The texts of an Arrow column; null counts as empty."""
    return [x or "" for x in column.to_pylist()]


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


SPACE_RUN = re.compile(r"\s ")
CUT = re.compile(r"(?<!\s) ")


def space_cuts(text: str) -> list[str]:
    """``text`` cut at the spaces that no white space precedes (the spaces are left out).

    The GPT-2 pattern always starts a new match there.  ``str``'s white space includes all
    of the pattern's, so no cut is made where the pattern would not make one.
    """
    return CUT.split(text) if SPACE_RUN.search(text) else text.split(" ")
