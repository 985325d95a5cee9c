"""Q4-Q7: advertising click statistics.

The same functions serve the batch jobs and the bodies of the streaming
queries (streaming/ads.py): each takes parsed log rows and returns a
DataFrame.  All counts are hash aggregates with a map-side partial step, so a
hot user, ad or province costs one partial row per map task in the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopflow.functions.dates import DATE_FORMAT, DATEKEY_FORMAT
from shopflow.operators.aggregates import count_by
from shopflow.operators.joins import exclude_keys, lookup_with_default
from shopflow.operators.tables import insert_new, upsert_add
from shopflow.operators.topk import top_n

# Fixed value: more than this many clicks by one user on one ad in one day
# puts the user on the blacklist.
BLACKLIST_THRESHOLD = 100

# Validity rule: a click's time lies in the years 1 to 9999 (UTC, milliseconds).
MIN_TIME_MS, MAX_TIME_MS = -62_135_596_800_000, 253_402_300_799_999

USER_KEYS = ["date", "userid", "adid"]
STAT_KEYS = ["date", "province", "city", "adid"]
PROVINCE_KEYS = ["date", "province", "adid"]


def parse_ad_log(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """``<epoch ms> <province> <city> <userid> <adid>`` -> typed columns.

    Lines with fewer than five fields or a non-numeric time, user or ad are
    dropped, as is a time outside the years 1 to 9999.  ``date`` is ``yyyy-MM-dd`` of the click in the session zone.

    The split line comes out of a generator of one row, which neither the filter nor the
    projection above it can be folded into: each line is split once.
    """
    split = lines.select(F.explode(F.array(F.split(F.col(value_col), " "))).alias("f"))
    field = lambda i: F.try_element_at(F.col("f"), F.lit(i))  # noqa: E731  (1-based)
    ms = field(1).try_cast("bigint")
    parsed = split.select(
        ms.alias("ts_ms"),
        field(2).alias("province"),
        field(3).alias("city"),
        field(4).try_cast("bigint").alias("userid"),
        field(5).try_cast("bigint").alias("adid"),
    ).where(F.col("ts_ms").between(MIN_TIME_MS, MAX_TIME_MS) & F.col("userid").isNotNull() & F.col("adid").isNotNull()
            & F.col("province").isNotNull() & F.col("city").isNotNull())
    ts = F.timestamp_millis("ts_ms")
    return parsed.select("ts_ms", ts.alias("ts"), F.date_format(ts, DATE_FORMAT).alias("date"),
                         "province", "city", "userid", "adid")


def without_blacklisted(log: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Drop clicks of blacklisted users (anti join, size-checked broadcast)."""
    return exclude_keys(log, blacklist, ["userid"])


def user_click_counts(log: DataFrame) -> DataFrame:
    """Clicks per (date, userid, adid)."""
    return count_by(log, USER_KEYS)


def users_over_threshold(counts: DataFrame, threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    """F7 + A9: distinct users with a stored total strictly above ``threshold``."""
    return counts.where(F.col("click_count") > F.lit(threshold)).select("userid").distinct()


def blacklist_update(
    stored_counts: DataFrame,
    stored_blacklist: DataFrame,
    batch_log: DataFrame,
    threshold: int = BLACKLIST_THRESHOLD,
) -> tuple[DataFrame, DataFrame]:
    """Q4 step for one batch: add the batch's counts to the stored counts (K6),
    test the new totals of the batch's keys (S10, F7), add new users (A9, K9).

    Returns ``(new_counts, new_blacklist)``.
    """
    batch_counts = user_click_counts(batch_log)
    new_counts = upsert_add(stored_counts, batch_counts, USER_KEYS, ["click_count"])
    # Totals of the batch's keys only: batch count + stored count (0 if none),
    # without aggregating the whole stored table a second time.
    both = lookup_with_default(batch_counts, stored_counts, USER_KEYS, "click_count", alias="stored_count")
    totals = both.select(*USER_KEYS, (F.col("click_count") + F.col("stored_count")).alias("click_count"))
    new_users = users_over_threshold(totals, threshold)
    return new_counts, insert_new(stored_blacklist, new_users, ["userid"])


def ad_stat(log: DataFrame) -> DataFrame:
    """Q5: clicks per (date, province, city, adid)."""
    return count_by(log, STAT_KEYS)


def province_ad_counts(stat: DataFrame) -> DataFrame:
    """A10: roll city counts up to (date, province, adid)."""
    return stat.groupBy(*PROVINCE_KEYS).agg(F.sum("click_count").cast("bigint").alias("click_count"))


def province_top3(province_counts: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` most clicked ads per (date, province); ties: smaller adid."""
    return top_n(province_counts, ["date", "province"], [F.desc("click_count"), F.asc("adid")], n)


def minute_trend(log: DataFrame) -> DataFrame:
    """Q7/T5: clicks per minute and ad, keyed by date ``yyyyMMdd``, hour, minute."""
    per_minute = log.groupBy(F.date_trunc("minute", "ts").alias("minute_ts"), "adid").agg(
        F.count(F.lit(1)).alias("click_count"))
    return per_minute.select(
        F.date_format("minute_ts", DATEKEY_FORMAT).alias("date"),
        F.date_format("minute_ts", "HH").alias("hour"),
        F.date_format("minute_ts", "mm").alias("minute"),
        "adid", "click_count",
    )


def bucket_counts(log: DataFrame, slide_minutes: int = 1) -> DataFrame:
    """Clicks per (ad, slide bucket ``b``); ``b`` counts slides since the epoch."""
    slide_s = slide_minutes * 60
    bucket = F.floor(F.unix_micros("ts") / F.lit(slide_s * 1_000_000)).cast("bigint")
    return log.groupBy("adid", bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"))


def window_counts_from_buckets(per_bucket: DataFrame, k: int, part: int | None = None) -> DataFrame:
    """(adid, b, click_count) for every window of ``k`` buckets starting at ``b``
    that holds at least one click, from per-bucket counts (adid, b, n).

    A bucket ``b`` adds its count to the starts ``b-k+1`` to ``b``: one step up and one step
    down.  Along the starts, the running sum of the steps is the count of every start up to the
    next step; stretches with a count are enumerated.  An ad's span is cut into parts of
    ``part`` starts (default: at least a day of minutes, never less than ``k``); a bucket's
    stretch lies in one part or is cut at the border of two, so every part is on its own.
    The counts are read once and dealt and sorted once by part; no row is copied k times.
    """
    size = max(k, part or 1440)
    n, first, last = F.col("n").cast("bigint"), F.col("b") - F.lit(k - 1), F.col("b")
    of = lambda start: F.floor(start / F.lit(size)).cast("bigint")

    def steps(lo, hi):
        p = of(lo)
        return F.struct(p.alias("p"), lo.alias("at"), n.alias("step")), F.struct(p.alias("p"), (hi + 1).alias("at"), (-n).alias("step"))

    border = of(last) * F.lit(size)
    whole = F.array(*steps(first, last))
    cut = F.array(*steps(first, border - 1), *steps(border, last))
    moves = per_bucket.select("adid", F.inline(F.when(of(first) == of(last), whole).otherwise(cut)))
    by_part = Window.partitionBy("adid", "p").orderBy("at")
    runs = moves.select(
        "adid", F.col("at").alias("lo"), (F.lead("at").over(by_part) - 1).alias("hi"),
        F.sum("step").over(by_part.rowsBetween(Window.unboundedPreceding, 0)).alias("click_count")).where("lo <= hi and click_count > 0")
    return runs.select("adid", F.explode(F.sequence("lo", "hi")).alias("b"), F.col("click_count").cast("bigint").alias("click_count"))


def sliding_window_counts(log: DataFrame, window_minutes: int = 60, slide_minutes: int = 1) -> DataFrame:
    """T4: clicks per ad in every ``window_minutes`` window sliding by ``slide_minutes``.

    Clicks are counted per (slide bucket, ad) first; the windows come from
    those counts (``window_counts_from_buckets``), so nothing is copied once
    per window.  Windows are aligned to the epoch, as Spark's ``window()``
    aligns them.
    """
    if window_minutes % slide_minutes:
        raise ValueError("window length must be a multiple of the slide")
    k = window_minutes // slide_minutes
    slide_s = slide_minutes * 60
    out = window_counts_from_buckets(bucket_counts(log, slide_minutes), k)
    start = F.timestamp_seconds(F.col("b") * F.lit(slide_s))
    end = F.timestamp_seconds((F.col("b") + F.lit(k)) * F.lit(slide_s))
    return out.select(start.alias("window_start"), end.alias("window_end"), "adid", "click_count")
