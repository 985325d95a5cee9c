"""Q4-Q7 as streaming jobs.

Each micro-batch adds its own counts; nothing waits for a watermark, so a late
click counts whenever it arrives, as in a count that is kept for ever.  State
lives in ``ResultTable``s: a batch writes its deltas to its own folder, a
repeated batch replaces it, and the tables are read by summing deltas (K6), taking
the latest batch of a group (K8) or distinct users (K9).  Finished batches are
folded beside the stream, so what a batch reads of the tables stays a few folders.
Running counts in Spark's state store are in ``streaming/state.py``.

* ``AdStreamJob`` is the live job: every micro-batch re-reads the blacklist of
  the batches before (J4), drops blacklisted users' clicks, adds the batch's
  counts per (date, user, ad) (K6), blacklists users whose total passes the
  threshold (F7, A9, K9), adds city counts (Q5), replaces the top-3 of the
  (date, province) groups it touched (Q6, K8) and adds the per-minute trend
  (Q7), from which the sliding hour is read (T4).  A user is blocked from the
  batch after the one that crossed the threshold.
* ``delta_sink`` and ``top3_sink`` run one statistic alone, without a blacklist.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.util import inheritable_thread_target

from shopflow.functions.dates import TIME_FORMAT
from shopflow.plans import ads
from shopflow.sources.store import BATCH, EVERY, ResultTable, latest_groups, summed
from shopflow.streaming.compaction import Compaction

S, L = T.StringType(), T.LongType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


USER_COUNT_SCHEMA = _schema(("date", S), ("userid", L), ("adid", L), ("click_count", L))
BLACKLIST_SCHEMA = _schema(("userid", L))
AD_STAT_SCHEMA = _schema(("date", S), ("province", S), ("city", S), ("adid", L), ("click_count", L))
PROVINCE_TOP3_SCHEMA = _schema(("date", S), ("province", S), ("adid", L), ("click_count", L))
TREND_SCHEMA = _schema(("date", S), ("hour", S), ("minute", S), ("adid", L), ("click_count", L))
TREND_KEYS = ["date", "hour", "minute", "adid"]
GROUP_KEYS = ["date", "province"]


def trend_windows(trend: DataFrame, window_minutes: int = 60) -> DataFrame:
    """T4: windows of ``window_minutes`` sliding by a minute, from summed minute counts."""
    minute = F.to_timestamp(F.concat("date", "hour", "minute"), "yyyyMMddHHmm")
    per_minute = trend.select("adid", (F.unix_timestamp(minute) / 60).cast("bigint").alias("b"), F.col("click_count").alias("n"))
    start = F.col("b") * F.lit(60)
    return ads.window_counts_from_buckets(per_minute, window_minutes).select(
        F.date_format(F.timestamp_seconds(start), TIME_FORMAT).alias("window_start"),
        F.date_format(F.timestamp_seconds(start + F.lit(60 * window_minutes)), TIME_FORMAT).alias("window_end"),
        "adid", "click_count")


class AdTables:
    """The result tables of the live job under one shared root, and how they are read."""

    def __init__(self, spark: SparkSession, root: str):
        r = root.rstrip("/")
        add = lambda keys: lambda rows: summed(rows, keys)
        self.user_counts = ResultTable(spark, f"{r}/ad_user_click_count", USER_COUNT_SCHEMA, ["date"], add(ads.USER_KEYS))
        self.blacklist = ResultTable(spark, f"{r}/ad_blacklist", BLACKLIST_SCHEMA, [], lambda rows: rows.select("userid").distinct())
        self.ad_stat = ResultTable(spark, f"{r}/ad_stat", AD_STAT_SCHEMA, ["date"], add(ads.STAT_KEYS))
        self.province_top3 = ResultTable(spark, f"{r}/ad_province_top3", PROVINCE_TOP3_SCHEMA, ["date"],
                                         lambda rows: latest_groups(rows, GROUP_KEYS))
        self.click_trend = ResultTable(spark, f"{r}/ad_click_trend", TREND_SCHEMA, ["date"], add(TREND_KEYS))

    def all(self) -> list[ResultTable]:
        return [self.user_counts, self.blacklist, self.ad_stat, self.province_top3, self.click_trend]

    def read_user_counts(self) -> DataFrame:
        return self.user_counts.read()

    def read_blacklist(self, before: int | None = None) -> DataFrame:
        return self.blacklist.read(before)

    def read_ad_stat(self) -> DataFrame:
        return self.ad_stat.read()

    def read_province_top3(self) -> DataFrame:
        return self.province_top3.read()

    def read_click_trend(self) -> DataFrame:
        return self.click_trend.read()

    def read_sliding_hour(self) -> DataFrame:
        return trend_windows(self.read_click_trend())


def _dates(rows: DataFrame) -> tuple[str, str]:
    """Least and greatest date: two values, with which history is read by partition."""
    return tuple(d or "" for d in rows.agg(F.min("date"), F.max("date")).first())


def _touched_top3(stat: ResultTable, batch_id: int, touched: DataFrame, dates: tuple[str, str]) -> DataFrame:
    """Top-3 of the groups in ``touched``, from the city counts of their dates up to this batch."""
    rows = stat.rows(batch_id + 1, dates).join(touched, GROUP_KEYS, "left_semi")
    return ads.province_top3(ads.province_ad_counts(rows))


class AdStreamJob:
    """The live ad job; ``parallel`` runs the three independent table chains of a micro-batch as concurrent
    Spark jobs (threads of the driver); finished batches are folded once in ``every`` batches."""

    def __init__(self, tables: AdTables, threshold: int = ads.BLACKLIST_THRESHOLD, parallel: bool = True, every: int = EVERY):
        self.t = tables
        self.threshold = threshold
        self.parallel = parallel
        self.compactions = [Compaction(table, every) for table in tables.all()]

    def process_batch(self, batch: DataFrame, batch_id: int) -> None:
        t = self.t
        # The blacklist of the batches before: a retry of the batch filters
        # exactly as its first attempt did.
        log = ads.without_blacklisted(ads.parse_ad_log(batch), t.read_blacklist(batch_id)).persist()
        dates = _dates(log)

        def blacklist_chain() -> None:  # T8: K6 -> S10 + F7 -> A9 -> K9
            counts = ads.user_click_counts(log)
            t.user_counts.write(counts, batch_id)
            stored = t.user_counts.rows(batch_id + 1, dates).join(counts.select(*ads.USER_KEYS), ads.USER_KEYS, "left_semi")
            totals = summed(stored, ads.USER_KEYS)
            # Users that are on the list already have no clicks left in this batch.
            t.blacklist.write(ads.users_over_threshold(totals, self.threshold), batch_id)

        def stat_chain() -> None:  # Q5 counts, then Q6 top-3 of the touched groups
            t.ad_stat.write(ads.ad_stat(log), batch_id)
            touched = log.select(*GROUP_KEYS).distinct()
            t.province_top3.write(_touched_top3(t.ad_stat, batch_id, touched, dates), batch_id)

        def trend_chain() -> None:  # Q7 per-minute counts (trend dates are yyyyMMdd)
            t.click_trend.write(ads.minute_trend(log), batch_id)

        chains = (blacklist_chain, stat_chain, trend_chain)
        try:
            if self.parallel:
                with ThreadPoolExecutor(max_workers=len(chains)) as pool:
                    for f in [pool.submit(inheritable_thread_target(log.sparkSession)(c)) for c in chains]:
                        f.result()
            else:
                for c in chains:
                    c()
        finally:
            log.unpersist()
        for c in self.compactions:
            c.after(batch_id)

    def start(self, lines: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        """Start on a stream of lines (``value``); ``trigger``
        defaults to the reference's 2-second micro-batches."""
        return start_batches(lines, self.process_batch, checkpoint, trigger)


def delta_sink(table: ResultTable, count: Callable[[DataFrame], DataFrame]):
    """foreachBatch function: parse the batch's lines and write its counts."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        table.write(count(ads.parse_ad_log(batch)), batch_id)
    return fn


def top3_sink(stat: ResultTable, top3: ResultTable):
    """foreachBatch function for T7: write the batch's city counts, then replace the
    top-3 of the groups it touched."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        stat.write(ads.ad_stat(ads.parse_ad_log(batch)), batch_id)
        touched = stat.rows().where(F.col(BATCH) == batch_id).select(*GROUP_KEYS).distinct()
        top3.write(_touched_top3(stat, batch_id, touched, _dates(touched)), batch_id)
    return fn


def start_batches(lines: DataFrame, sink, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Run a ``foreachBatch`` function over a stream of lines."""
    w = lines.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": "2 seconds"})).start()
