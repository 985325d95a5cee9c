"""Result tables of stream jobs as plain Parquet folders, and sinks (K1-K3).

A stream's ``foreachBatch`` may run a batch twice after a failure, and Parquet
cannot be changed in place.  So a batch writes its own rows only, to the folder
``batch_id=<n>`` of the table, with Spark's own committer; a repeated batch
replaces that folder and nothing else.  What the table says is a query over
all batches: deltas are summed (K6), the latest batch of a key (K7) or of
a group (K8) counts, keys are made distinct (K9).

``compact`` folds finished batches while the stream runs: each full block of
``every`` batches into one part, each full block of ``every`` parts into a larger one, and so
on.  So a table of n batches has about ``every * log(n)`` folders, each row is
rewritten once for each level, and what a read lists and opens stays small.  A
part is named by the batches it stands for; readers find the parts from the
folder listing alone.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = "batch_id"
#: Folder of folded parts: ``folded/first=<first batch>/batch_id=<last batch>``.
FOLDED, FIRST = "folded", "first"
#: Batches (or parts) that are folded into one.
EVERY = 16


class ResultTable:
    """Rows of many batches under ``root/batch_id=<n>``, inside it by ``partition_by``.

    ``merge`` says what rows with a ``batch_id`` amount to; applied to the results for
    neighbouring blocks of batches it must give the result for all of them.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, partition_by: Sequence[str] = (),
                 merge: Callable[[DataFrame], DataFrame] | None = None):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.partition_by, self.merge = list(partition_by), merge

    def write(self, df: DataFrame, batch_id: int) -> None:
        """Write (or replace) the rows of one batch; no rows are an empty batch."""
        self._write(df, f"{self.root}/{BATCH}={batch_id}")

    def _write(self, df: DataFrame, path: str) -> None:
        out = df.select(*[f.name for f in self.schema.fields])
        if self.partition_by:  # few files for few rows, many for a large partition
            out = out.hint("rebalance", *self.partition_by)
        (out.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
         .partitionBy(*self.partition_by).parquet(path))

    def _path(self, path: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _numbers(self, folder: str, name: str) -> list[int]:
        """n of all sub-folders ``<name>=<n>``."""
        fs, path = self._path(folder)
        if not fs.exists(path):
            return []
        found = [x.getPath().getName() for x in fs.listStatus(path) if x.isDirectory()]
        return sorted(int(x[len(name) + 1:]) for x in found if x.startswith(name + "="))

    def batches(self) -> list[int]:
        """The batches that have a folder of their own."""
        return self._numbers(self.root, BATCH)

    def folds(self) -> list[tuple[int, int]]:
        """(first, last) batch of all finished folded parts."""
        out = []
        for first in self._numbers(f"{self.root}/{FOLDED}", FIRST):
            for last in self._numbers(f"{self.root}/{FOLDED}/{FIRST}={first}", BATCH):
                fs, done = self._path(f"{self._folded(first, last)}/_SUCCESS")
                if fs.exists(done):
                    out.append((first, last))
        return out

    def _folded(self, first: int, last: int) -> str:
        return f"{self.root}/{FOLDED}/{FIRST}={first}/{BATCH}={last}"

    def parts(self, before: int | None = None) -> list[tuple[int, int]]:
        """The (first, last) that together hold every batch (``before`` one) once: the largest folds, then batches."""
        singles = self.batches()  # listed first: what is folded meanwhile is then still here
        return _cover(self.folds(), singles, before)

    def rows(self, before: int | None = None, between: tuple | None = None) -> DataFrame:
        """All rows with a ``batch_id`` (a folded part's is its last); with ``before`` those of earlier batches only.

        ``between``: least and greatest value of the first partition column, so that other partitions are not opened.
        """
        return self._read(self.parts(before), between)

    def _read(self, parts: Sequence[tuple[int, int]], between: tuple | None = None) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField(BATCH, T.LongType(), True)])
        singles = [f"{self.root}/{BATCH}={b}" for a, b in parts if a == b]
        folds = [self._folded(a, b) for a, b in parts if a != b]
        found = []
        if singles:
            found.append(self.spark.read.schema(schema).option("basePath", self.root).parquet(*singles).select(*schema.names))
        if folds:
            wide = T.StructType([*schema.fields, T.StructField(FIRST, T.LongType(), True)])
            found.append(self.spark.read.schema(wide).option("basePath", f"{self.root}/{FOLDED}").parquet(*folds).select(*schema.names))
        if not found:
            return self.spark.createDataFrame([], schema)
        rows = found[0] if len(found) == 1 else found[0].unionByName(found[1])
        return rows if between is None else rows.where(F.col(self.partition_by[0]).between(*map(F.lit, between)))

    def read(self, before: int | None = None, between: tuple | None = None) -> DataFrame:
        """What the table says."""
        return self.merge(self.rows(before, between))

    def compact(self, done: int, every: int = EVERY) -> None:
        """Fold the full blocks of the batches up to ``done``, which must be finished for good.

        The stream may go on writing later batches meanwhile, and readers may read: a part
        counts once its writer has committed it, and what it stands for is removed by the next
        call that finds it there, so a reader has ``every`` batches' time.  A call
        that died is made up for by the next one.
        """
        self._remove(self.folds())
        size = every
        while size <= done + 1:
            blocks: dict[int, list[tuple[int, int]]] = {}
            for first, last in self.parts():
                if last - first + 1 < size and (first // size + 1) * size <= done + 1:
                    blocks.setdefault(first // size, []).append((first, last))
            for k, inside in blocks.items():
                self._write(self.merge(self._read(inside)), self._folded(k * size, (k + 1) * size - 1))
            size *= every

    def _remove(self, folds: Sequence[tuple[int, int]]) -> None:
        """Remove batches and parts that a larger part stands for."""
        old = [f"{self.root}/{BATCH}={b}" for b in self.batches() if any(x <= b <= y for x, y in folds)]
        old += [self._folded(a, b) for a, b in folds if any(x <= a and b <= y and (x, y) != (a, b) for x, y in folds)]
        for folder in old:
            fs, path = self._path(folder)
            fs.delete(path, True)

    def fold(self, new_root: str, read: Callable[[DataFrame], DataFrame], upto: int) -> ResultTable:
        """A new table whose batch ``upto`` holds ``read`` of all batches up to it, and no other batch.

        Run it while the stream is stopped, and go on with the new table and the same checkpoint.
        """
        out = ResultTable(self.spark, new_root, self.schema, self.partition_by, self.merge)
        out.write(read(self.rows(upto + 1)), upto)
        return out


def _cover(folds: Sequence[tuple[int, int]], singles: Sequence[int], before: int | None) -> list[tuple[int, int]]:
    """Disjoint folds, the largest first, and the single batches outside them; all end before ``before``."""
    limit = before if before is not None else float("inf")
    chosen: list[tuple[int, int]] = []
    for a, b in sorted(folds, key=lambda f: f[0] - f[1]):
        if b < limit and not any(x <= a and b <= y for x, y in chosen):
            chosen.append((a, b))
    rest = [b for b in singles if b < limit and not any(x <= b <= y for x, y in chosen)]
    for a, b in folds:
        if a < limit <= b and not any(x <= a <= y for x, y in chosen) and not any(a <= s < limit for s in rest):
            raise ValueError(f"batches {a} to {b} have been folded: what was there before batch {before} is not known any more")
    return sorted(chosen + [(b, b) for b in rest])


def summed(rows: DataFrame, keys: Sequence[str], value: str = "click_count") -> DataFrame:
    """K6 read: the deltas of each key added up."""
    return rows.groupBy(*keys).agg(F.sum(value).cast("bigint").alias(value))


def latest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K7 read: each key's row of its latest batch."""
    others = [c for c in rows.columns if c not in (*keys, BATCH)]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), BATCH).alias("__r"))
    return newest.select(*keys, "__r.*")


def latest_groups(rows: DataFrame, group: Sequence[str]) -> DataFrame:
    """K8 read: all rows that the latest batch of each group has (a group is small: it is one row of lists meanwhile)."""
    others = [c for c in rows.columns if c not in (*group, BATCH)]
    written = rows.groupBy(*group, BATCH).agg(F.collect_list(F.struct(*others)).alias("__r"))
    newest = written.groupBy(*group).agg(F.max_by("__r", BATCH).alias("__r"))
    return newest.select(*group, F.inline("__r"))


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    mode: str = "append",
    batchsize: int = 1000,
    num_partitions: int | None = None,
) -> None:
    """K1: append (or overwrite) rows into a JDBC table.

    Each task writes its partition with batched inserts; ``num_partitions``
    bounds the number of concurrent connections the database sees, without
    bounding the tasks that compute the rows.
    """
    props = {"batchsize": str(batchsize)}
    if user is not None:
        props["user"] = user
    if password is not None:
        props["password"] = password
    out = df.repartition(num_partitions) if num_partitions else df
    out.write.jdbc(url, table, mode=mode, properties=props)


def replace_table(df: DataFrame, name: str, path: str | None = None, partition_by: Sequence[str] = ()) -> None:
    """K2: replace a catalog table with ``df`` (drop + create as one overwrite).

    With ``path`` the table's files go to that (shared) location instead of
    the warehouse folder.  ``partition_by`` (dates) makes a folder for each value,
    few files for few rows and many for a large one.
    """
    w = (df.hint("rebalance", *partition_by) if partition_by else df).write.mode("overwrite").partitionBy(*partition_by)
    if path is not None:
        w = w.option("path", path)
    w.saveAsTable(name)


# Text comes back as it was: no trimming, quotes doubled, NULL and '' told apart,
# a line ends with \n only.  A text equal to the NULL mark comes back as NULL.
CSV_OPTIONS = {
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "nullValue": "\\N", "lineSep": "\n",
    "quote": '"', "escape": '"',
}


def write_csv(df: DataFrame, path: str, single_file: bool = True, header: bool = True) -> None:
    """K3: write CSV.

    ``single_file`` is the caller's choice and gives one file at any size; the rows
    go to the one writer by a shuffle, so everything before it still runs on all tasks.
    """
    out = df.repartition(1) if single_file else df
    out.write.mode("overwrite").options(**CSV_OPTIONS, emptyValue='""').option("header", header).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """What ``write_csv`` wrote."""
    return spark.read.schema(schema).options(**CSV_OPTIONS, emptyValue="").option("header", header).csv(path)
