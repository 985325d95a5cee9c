"""The stream queries (T2-T8, Q10): replay, run to completion, read the result.

Each replays its input from the test tables as text files, runs the streaming
query to the end with an ``availableNow`` trigger, and returns the final result
table.  ``*_unordered`` replays in an order that has nothing to do with time,
so that most clicks arrive late.
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from shopflow.catalog.ads import Q_THRESHOLD, STAT_CTE, ad_with
from shopflow.catalog.registry import ORACLES, register
from shopflow.catalog.text import JAVA_TOKENS
from shopflow.config import fresh_dir
from shopflow.oracle import with_views
from shopflow.plans import ads
from shopflow.sources import views
from shopflow.sources.store import ResultTable, latest_groups, summed
from shopflow.streaming import ads as sa
from shopflow.streaming import words as sw
from shopflow.streaming.sources import ad_log_stream, text_line_stream, write_replay_files

# Micro-batches of a replay (fewer for few files); how many files there are follows from the data.
BATCHES = 4
DOCUMENTS_PER_PART = 250
AVAILABLE_NOW = {"availableNow": True}


def _by_date(ts):
    return F.date_format(ts, "yyyy-MM-dd")


def _by_week(ts):
    """Days since the epoch in sevens, as text that sorts."""
    return F.lpad(F.floor(F.unix_date(F.to_date(ts)) / 7).cast("string"), 6, "0")


def _ad_lines(spark, sf_dir, ordered=True, weekly=False):
    """The ad log as a stream of lines, by time or in an order that ignores it; ``weekly``: a micro-batch for each week."""
    out = fresh_dir(spark, "replay")
    lines = views.ad_log_lines_with_time(spark, sf_dir)
    ts = F.col("ts").cast("timestamp")
    mixed = F.pmod(F.xxhash64("value"), F.lit(16))
    part = _by_week(ts) if weekly else _by_date(ts) if ordered else F.lpad(mixed.cast("string"), 2, "0")
    n = write_replay_files(lines, part, ts if ordered else F.xxhash64("value"), "value", out, whole_parts=weekly)
    return ad_log_stream(spark, out, max_files_per_trigger=1 if weekly else max(1, math.ceil(n / BATCHES)))


def _run_deltas(spark, lines, schema, count):
    table = ResultTable(spark, fresh_dir(spark, "tables"), schema, ["date"])
    sa.start_batches(lines, sa.delta_sink(table, count), fresh_dir(spark, "checkpoints"), AVAILABLE_NOW).awaitTermination()
    return table


def _ad_stat(spark, sf_dir, ordered):
    return summed(_run_deltas(spark, _ad_lines(spark, sf_dir, ordered), sa.AD_STAT_SCHEMA, ads.ad_stat).rows(), ads.STAT_KEYS)


def _trend(spark, sf_dir, ordered):
    return summed(_run_deltas(spark, _ad_lines(spark, sf_dir, ordered), sa.TREND_SCHEMA, ads.minute_trend).rows(), sa.TREND_KEYS)


def _province_top3(spark, sf_dir, ordered):
    stat = ResultTable(spark, fresh_dir(spark, "tables"), sa.AD_STAT_SCHEMA, ["date"])
    top3 = ResultTable(spark, fresh_dir(spark, "tables"), sa.PROVINCE_TOP3_SCHEMA, ["date"])
    sa.start_batches(_ad_lines(spark, sf_dir, ordered), sa.top3_sink(stat, top3), fresh_dir(spark, "checkpoints"),
                     AVAILABLE_NOW).awaitTermination()
    return latest_groups(top3.rows(), sa.GROUP_KEYS)


@register("stream_ad_stat", ad_with(STAT_CTE) + "select * from stat")
def q_stream_ad_stat(spark, sf_dir):
    """Running clicks per date, province, city, ad: batch deltas, summed."""
    return _ad_stat(spark, sf_dir, True)


@register("stream_ad_stat_unordered", ORACLES["stream_ad_stat"])
def q_stream_ad_stat_unordered(spark, sf_dir):
    """T3 with clicks that arrive in any order."""
    return _ad_stat(spark, sf_dir, False)


@register("stream_ad_trend", ORACLES["ad_minute_trend"])
def q_stream_ad_trend(spark, sf_dir):
    """T5: running clicks per minute and ad."""
    return _trend(spark, sf_dir, True)


@register("stream_ad_trend_unordered", ORACLES["ad_minute_trend"])
def q_stream_ad_trend_unordered(spark, sf_dir):
    """T5 with clicks that arrive in any order."""
    return _trend(spark, sf_dir, False)


@register("stream_sliding_hour", ORACLES["sliding_hour_clicks"])
def q_stream_sliding_hour(spark, sf_dir):
    """T4: 60-minute windows sliding by a minute, read from the stream's minute counts."""
    return sa.trend_windows(_trend(spark, sf_dir, True))


@register("stream_sliding_unordered", ORACLES["sliding_hour_clicks"])
def q_stream_sliding_unordered(spark, sf_dir):
    """T4 with clicks that arrive in any order."""
    return sa.trend_windows(_trend(spark, sf_dir, False))


@register("stream_province_top3", ORACLES["province_top3_ads"])
def q_stream_province_top3(spark, sf_dir):
    """Each batch replaces the top-3 of the (date, province) groups it touched."""
    return _province_top3(spark, sf_dir, True)


@register("stream_province_top3_unordered", ORACLES["province_top3_ads"])
def q_stream_province_top3_unordered(spark, sf_dir):
    """T7 with clicks that arrive in any order."""
    return _province_top3(spark, sf_dir, False)


def _live(spark, sf_dir):
    """The live job over one micro-batch for each week."""
    tabs = sa.AdTables(spark, fresh_dir(spark, "tables"))
    lines = _ad_lines(spark, sf_dir, weekly=True)
    sa.AdStreamJob(tabs, Q_THRESHOLD).start(lines, fresh_dir(spark, "checkpoints"), AVAILABLE_NOW).awaitTermination()
    return tabs


# What the live job counts: a user's clicks up to and in the week in which one ad's
# clicks of a day passed the threshold; those of later weeks are dropped.
_WEEK = "cast(floor(date_diff('day', date '1970-01-01', cast(date as date)) / 7) as bigint)"
_LIVE_CTES = [
    ("crossed", f"select userid, min({_WEEK}) as w from (select date, userid, adid, count(*) as n from parsed "
                f"group by 1, 2, 3) where n > {Q_THRESHOLD} group by 1"),
    ("live", f"select p.* from parsed p left join crossed c on p.userid = c.userid where c.w is null or {_WEEK} <= c.w"),
]


def _live_oracle(sql):
    return ad_with(*_LIVE_CTES) + sql


@register("stream_blacklist", ORACLES["blacklist_users"])
def q_stream_blacklist(spark, sf_dir):
    """The live job's final blacklist; it equals the batch one, as only users on it are ever filtered."""
    return _live(spark, sf_dir).read_blacklist()


@register("stream_live_ad_stat", _live_oracle(
    "select date, province, city, adid, count(*) as click_count from live group by 1, 2, 3, 4"))
def q_stream_live_ad_stat(spark, sf_dir):
    """T2/J4 + Q5: the live job's city counts, without the clicks of users blacklisted in earlier batches."""
    return _live(spark, sf_dir).read_ad_stat()


@register("stream_live_top3", _live_oracle(
    "select date, province, adid, click_count from (select *, row_number() over (partition by date, province "
    "order by click_count desc, adid) as rn from (select date, province, adid, count(*) as click_count from live "
    "group by 1, 2, 3)) where rn <= 3"))
def q_stream_live_top3(spark, sf_dir):
    """T2/J4 + Q6: the live job's top-3 per date and province."""
    return _live(spark, sf_dir).read_province_top3()


@register("stream_live_trend", _live_oracle(
    "select strftime(m, '%Y%m%d') as date, strftime(m, '%H') as hour, strftime(m, '%M') as minute, adid, "
    "count(*) as click_count from (select date_trunc('minute', ts) as m, adid from live) group by m, adid"))
def q_stream_live_trend(spark, sf_dir):
    """T2/J4 + Q7: the live job's clicks per minute and ad."""
    return _live(spark, sf_dir).read_click_trend()


def document_line_stream(spark, sf_dir):
    """The documents' lines as a stream."""
    out = fresh_dir(spark, "replay")
    part = F.lpad(F.floor(F.col("doc_id") / DOCUMENTS_PER_PART).cast("string"), 12, "0")
    n = write_replay_files(views.document_lines(spark, sf_dir), part, F.col("doc_id"), "line", out)
    return text_line_stream(spark, out, max_files_per_trigger=max(1, math.ceil(n / BATCHES)))


@register("stream_word_count", with_views("doc_lines") +
          f"select word, count(*) as count from (select unnest({JAVA_TOKENS}) as word from doc_lines) "
          "where word <> '' group by word")
def q_stream_word_count(spark, sf_dir):
    """Running word counts of a line stream, empty tokens dropped."""
    table = ResultTable(spark, fresh_dir(spark, "tables"), sw.WORD_COUNT_SCHEMA)
    sw.start_word_count(document_line_stream(spark, sf_dir), table, fresh_dir(spark, "checkpoints"), AVAILABLE_NOW).awaitTermination()
    return sw.read_word_count(table)
