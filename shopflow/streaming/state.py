"""Statistics that a stream keeps in Spark's state store: running counts (T3, T5, T6), top-n (T7), sliding windows (T4).

The counts of all keys seen so far live in the state store (RocksDB, its changes written to the
checkpoint), without a watermark, so nothing expires and a late click counts whenever it
arrives.  A micro-batch puts out the keys it changed, with their new totals, and the
result table takes them as they are (K7): no batch reads what earlier batches wrote.
The number of tasks that share the state is fixed at the first start (``state_tasks``); Spark
keeps it in the checkpoint.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from shopflow.functions.dates import TIME_FORMAT
from shopflow.plans import ads, words
from shopflow.sources.store import ResultTable, latest, latest_groups, summed
from shopflow.streaming import ads as sa
from shopflow.streaming import words as sw
from shopflow.streaming.compaction import Compaction

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the repository on their path

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


#: Tasks of a micro-batch that share the state, for each core.
TASKS_PER_CORE = 2


def state_tasks(spark: SparkSession) -> int:
    """``spark.sql.shuffle.partitions``, but at most ``TASKS_PER_CORE`` for each core.

    Every task opens, syncs and commits a RocksDB instance of its own in every micro-batch, which
    takes far longer than a task's rows; an instance holds its keys on disk, so few large ones do.
    """
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), TASKS_PER_CORE * spark.sparkContext.defaultParallelism)


def start_update(frame: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Run ``sink`` over each micro-batch's changed keys, with state in RocksDB.

    Timers also run in batches without data, of which a query that is to end by itself
    (``availableNow``) has none.
    """
    trigger, conf = trigger or {"processingTime": "2 seconds"}, frame.sparkSession.conf
    wanted = STATE_CONF | {"spark.sql.streaming.noDataMicroBatches.enabled": str("processingTime" in trigger).lower(),
                           "spark.sql.shuffle.partitions": str(state_tasks(frame.sparkSession))}
    before = {key: conf.get(key, None) for key in wanted}
    for key, value in wanted.items():  # the query takes a copy when it starts
        conf.set(key, value)
    try:
        w = frame.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint)
        return w.trigger(**trigger).start()
    finally:
        for key, value in before.items():
            if value is None:
                conf.unset(key)
            else:
                conf.set(key, value)


def counts_sink(table: ResultTable) -> Callable[[DataFrame, int], None]:
    """Write the changed keys and their totals; fold finished batches of the table."""
    compaction = Compaction(table)

    def sink(changed: DataFrame, batch_id: int) -> None:
        table.write(changed, batch_id)
        compaction.after(batch_id)
    return sink


def latest_by(keys: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    return lambda rows: latest(rows, keys)


# ---- T3, T5, T6: running counts ----

def running_ad_stat(lines: DataFrame) -> DataFrame:
    """Clicks per (date, province, city, ad) of all batches so far."""
    return ads.ad_stat(ads.parse_ad_log(lines))


def running_trend(lines: DataFrame) -> DataFrame:
    """T5: clicks per minute and ad of all batches so far."""
    return ads.minute_trend(ads.parse_ad_log(lines))


def running_words(lines: DataFrame) -> DataFrame:
    """Words of all batches so far, empty tokens dropped."""
    return words.word_count(lines, "line", keep_empty=False)


# ---- T7: top-n from changed counts ----

def running_province_counts(lines: DataFrame) -> DataFrame:
    """Clicks per (date, province, ad) of all batches so far: the counts that a ranking follows."""
    return ads.parse_ad_log(lines).groupBy(*ads.PROVINCE_KEYS).agg(F.count(F.lit(1)).alias("click_count"))


def reranked(before: DataFrame, changed: DataFrame, n: int = 3) -> DataFrame:
    """The top-n of every (date, province) in ``changed`` from its top-n ``before`` and its changed totals.

    Totals only grow, so an ad that is in the top-n now was in it before or has just
    changed, and the greater of its two totals is the present one.
    """
    group = ["date", "province"]
    touched = before.join(changed.select(*group).distinct(), group, "left_semi")
    columns = [*ads.PROVINCE_KEYS, "click_count"]
    known = touched.select(*columns).unionByName(changed.select(*columns))
    return ads.province_top3(known.groupBy(*ads.PROVINCE_KEYS).agg(F.max("click_count").alias("click_count")), n)


def top3_state_sink(top3: ResultTable, n: int = 3) -> Callable[[DataFrame, int], None]:
    """Replace the ranking of the touched groups; reads the rankings of the batch's dates and no counts."""
    compaction = Compaction(top3)

    def sink(changed: DataFrame, batch_id: int) -> None:
        changed.persist()
        try:
            dates = changed.agg(F.min("date"), F.max("date")).first()
            before = top3.read(batch_id, tuple(d or "" for d in dates))  # an empty batch has no dates
            top3.write(reranked(before, changed, n), batch_id)
        finally:
            changed.unpersist()
        compaction.after(batch_id)
    return sink


# ---- T4: sliding windows ----

RING = T.StructType([T.StructField("last", T.LongType()), T.StructField("counts", T.ArrayType(T.LongType()))])
WINDOWS = T.StructType([
    T.StructField("kind", T.StringType()),  # window: clicks to add to a window; minute: to a minute's; ring: the minutes still open, if any
    T.StructField("adid", T.LongType()),
    T.StructField("at", T.LongType()),  # window start, minute, or the ring's last minute (minutes since the epoch)
    T.StructField("n", T.LongType()),
    T.StructField("counts", T.ArrayType(T.LongType())),
])


class Ring:
    """One ad's last ``width`` minutes: a count for each, and what has to be said when they move on.

    ``closed`` and ``expired`` collect additions to windows and to minutes.  A window is closed
    once its last minute lies before the ring's last one.
    """

    def __init__(self, width: int, last: int | None = None, counts: Sequence[int] = ()):
        self.width, self.last = width, last
        self.counts = [int(x) for x in counts] or [0] * width  # counts[m % width]
        self.closed: dict[int, int] = {}
        self.expired: dict[int, int] = {}

    def _advance(self, minute: int) -> None:
        """Make ``minute`` the last one; windows and minutes that end before are put out."""
        if self.last is None:
            self.last = minute
            return
        total, start = sum(self.counts), self.last - self.width + 1  # the one full window in the ring
        end = minute - self.width + 1
        while start < end and total:
            self.closed[start] = self.closed.get(start, 0) + total
            gone = self.counts[start % self.width]
            if gone:
                self.expired[start] = self.expired.get(start, 0) + gone
                self.counts[start % self.width] = 0
                total -= gone
            start += 1
        self.last = minute

    def add(self, minute: int, n: int) -> None:
        if self.last is None or minute > self.last:
            self._advance(minute)
        first = self.last - self.width + 1
        if minute >= first:
            self.counts[minute % self.width] += n
        else:
            self.expired[minute] = self.expired.get(minute, 0) + n
        for start in range(minute - self.width + 1, min(minute + 1, first)):  # windows that are closed already
            self.closed[start] = self.closed.get(start, 0) + n

    def expire(self) -> None:
        """Close everything: what is still open goes to the tables."""
        if self.last is not None:
            self._advance(self.last + self.width)
        self.last = None


def _minutes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts per (ad, minute) of each Arrow batch, so that a hot ad sends few rows."""
    for batch in batches:
        got = pa.Table.from_batches([batch]).group_by(["adid", "minute"]).aggregate([("n", "sum")])
        yield from got.rename_columns(["adid", "minute", "n"]).combine_chunks().to_batches()


def _slide(width: int, silent_ms: int):
    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ring = Ring(width, *state.get) if state.exists else Ring(width)
        if state.hasTimedOut:
            ring.expire()
        else:
            minutes: dict[int, int] = {}
            for frame in frames:
                for minute, n in zip(frame["minute"].tolist(), frame["n"].tolist()):
                    minutes[minute] = minutes.get(minute, 0) + n
            for minute in sorted(minutes):
                ring.add(minute, minutes[minute])
        if ring.last is None:
            state.remove()
        else:
            state.update((ring.last, ring.counts))
            state.setTimeoutDuration(silent_ms)
        rows = [("window", key[0], at, n, []) for at, n in ring.closed.items()]
        rows += [("minute", key[0], at, n, []) for at, n in ring.expired.items()]
        rows.append(("ring", key[0], ring.last or 0, 0, [] if ring.last is None else ring.counts))
        yield pd.DataFrame(rows, columns=WINDOWS.names)
    return step


def sliding_changes(lines: DataFrame, window_minutes: int = 60, silent_ms: int = 3_600_000) -> DataFrame:
    """T4: what each micro-batch changes in the windows of ``window_minutes`` that slide by a minute.

    Every ad has a ring of minute counts in the state store.  As its last minute moves on, the
    sum over the ring follows by adding and subtracting, windows that have ended are put out
    once, and minutes that leave the ring go to the minute table.  A late click adds to the
    closed windows it belongs to, and to its minute.  An ad without clicks for ``silent_ms`` is
    closed as a whole by a timer, and opens again with its next click.  All that is put out is added
    up, so it does not matter when a window was closed or how late a click came.
    """
    log = ads.parse_ad_log(lines)
    minute = F.floor(F.unix_micros("ts") / F.lit(60_000_000)).cast("long")
    clicks = log.select("adid", minute.alias("minute"), F.lit(1).cast("long").alias("n"))
    partial = clicks.mapInArrow(_minutes_of, "adid long, minute long, n long")
    return partial.groupBy("adid").applyInPandasWithState(
        _slide(window_minutes, silent_ms), WINDOWS, RING, "update", GroupStateTimeout.ProcessingTimeTimeout)


COUNT = T.StructType([T.StructField("day", T.LongType()), T.StructField("at", T.LongType()), T.StructField("adid", T.LongType()),
                      T.StructField("n", T.LongType())])
OPEN = T.StructType([T.StructField("adid", T.LongType()), T.StructField("last", T.LongType()), T.StructField("counts", T.ArrayType(T.LongType()))])


class SlidingTables:
    """Result tables of the sliding windows: additions to closed windows and to minutes (K6), rings still open (K7)."""

    def __init__(self, spark: SparkSession, root: str, window_minutes: int = 60):
        r, self.width = root.rstrip("/"), window_minutes
        add = lambda rows: summed(rows, ["day", "at", "adid"], "n")
        self.windows = ResultTable(spark, f"{r}/windows", COUNT, ["day"], add)
        self.minutes = ResultTable(spark, f"{r}/minutes", COUNT, ["day"], add)
        self.rings = ResultTable(spark, f"{r}/rings", OPEN, [], latest_by(["adid"]))

    def _open(self) -> DataFrame:
        """(adid, place, minute, n): the minutes of all open rings, first to last."""
        rings = self.rings.read().where(F.size("counts") > 0)
        first = F.col("last") - F.lit(self.width - 1)
        order = F.transform(F.sequence(F.lit(0), F.lit(self.width - 1)),
                            lambda i: F.element_at("counts", (F.pmod(first + i, F.lit(self.width)) + 1).cast("int")))
        return rings.select("adid", first.alias("first"), order.alias("counts"))

    def read_windows(self) -> DataFrame:
        """(adid, b, click_count): every window with a click, by its first minute ``b``."""
        rest = lambda i: F.aggregate(F.slice("counts", i + 1, F.lit(self.width)), F.lit(0).cast("long"), lambda a, x: a + x)
        totals = F.transform(F.sequence(F.lit(0), F.lit(self.width - 1)), rest)
        open_ = self._open().select("adid", "first", F.posexplode(totals).alias("i", "n")).select(
            "adid", (F.col("first") + F.col("i")).alias("at"), "n")
        return self._added(self.windows, open_)

    def read_minutes(self) -> DataFrame:
        """(adid, b, click_count): every minute with a click."""
        open_ = self._open().select("adid", "first", F.posexplode("counts").alias("i", "n")).select(
            "adid", (F.col("first") + F.col("i")).alias("at"), "n")
        return self._added(self.minutes, open_)

    def _added(self, table: ResultTable, open_: DataFrame) -> DataFrame:
        both = table.rows().select("adid", "at", "n").unionByName(open_)
        return both.groupBy("adid", F.col("at").alias("b")).agg(F.sum("n").alias("click_count")).where("click_count > 0")


def sliding_sink(tables: SlidingTables) -> Callable[[DataFrame, int], None]:
    """Write one batch's additions and rings."""
    compactions = [Compaction(t) for t in (tables.windows, tables.minutes, tables.rings)]

    def sink(changes: DataFrame, batch_id: int) -> None:
        changes.persist()
        try:
            count = ["at", "adid", "n", F.floor(F.col("at") / 1440).alias("day")]
            tables.windows.write(changes.where("kind = 'window'").select(*count), batch_id)
            tables.minutes.write(changes.where("kind = 'minute'").select(*count), batch_id)
            tables.rings.write(changes.where("kind = 'ring'").select("adid", F.col("at").alias("last"), "counts"), batch_id)
        finally:
            changes.unpersist()
        for c in compactions:
            c.after(batch_id)
    return sink


# ---- one statistic as a job ----

KINDS = ("stat", "trend", "words", "top3", "sliding")


class StateJob:
    """One of ``KINDS`` with its result tables below ``root``: ``start`` it on a stream of lines, ``read`` what it says."""

    def __init__(self, spark: SparkSession, kind: str, root: str):
        root = root.rstrip("/")

        def counts(schema: T.StructType, keys: Sequence[str], partition_by: Sequence[str] = ()) -> tuple:
            table = ResultTable(spark, f"{root}/tables", schema, partition_by, latest_by(keys))
            return counts_sink(table), table.read

        if kind == "stat":
            self.changes, (self.sink, self.read) = running_ad_stat, counts(sa.AD_STAT_SCHEMA, ads.STAT_KEYS, ["date"])
        elif kind == "trend":
            self.changes, (self.sink, self.read) = running_trend, counts(sa.TREND_SCHEMA, sa.TREND_KEYS, ["date"])
        elif kind == "words":
            self.changes, (self.sink, self.read) = running_words, counts(sw.WORD_COUNT_SCHEMA, ["word"])
        elif kind == "top3":
            table = ResultTable(spark, f"{root}/tables", sa.PROVINCE_TOP3_SCHEMA, ["date"], lambda rows: latest_groups(rows, sa.GROUP_KEYS))
            self.changes, self.sink, self.read = running_province_counts, top3_state_sink(table), table.read
        elif kind == "sliding":
            tables = SlidingTables(spark, f"{root}/tables")
            self.changes, self.sink, self.read = sliding_changes, sliding_sink(tables), lambda: window_texts(tables.read_windows(), tables.width)
        else:
            raise ValueError(f"not one of {KINDS}: {kind}")
        self.checkpoint = f"{root}/checkpoint"

    def start(self, lines: DataFrame, trigger: dict | None = None) -> StreamingQuery:
        return start_update(self.changes(lines), self.sink, self.checkpoint, trigger)


def window_texts(windows: DataFrame, width: int) -> DataFrame:
    """Windows by their first minute ``b`` with begin and end as text."""
    text = lambda minute: F.date_format(F.timestamp_seconds(minute * F.lit(60)), TIME_FORMAT)
    return windows.select(text(F.col("b")).alias("window_start"), text(F.col("b") + width).alias("window_end"), "adid", "click_count")
