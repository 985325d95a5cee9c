"""Q1: share of sessions per visit-length and step-count bucket.

scan (date range) -> per-session aggregate (A1) -> join users (J1) ->
optional-parameter filter (F5) -> one global aggregate that counts every
bucket at once (A2) -> ratios (A3).

``filtered_sessions`` builds full session rows (with the distinct keyword
and category lists) for the session queries; the ratio job uses
``filtered_session_lengths``, which selects the same sessions with
``bool_or`` flags instead of lists.  Both aggregates have a map-side partial step, so a session
holding a large share of the rows ships one partial row per map task.  The
bucket counters are conditional counts in a single global aggregate (one
row per map task, then one final row), unpivoted into the 15 bucket rows, so
every bucket appears, zero or not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shopflow.functions.dates import TIME_FORMAT, parse_time
from shopflow.functions.misc import round_half_up
from shopflow.functions.strings import is_not_empty
from shopflow.operators.aggregates import with_task_id
from shopflow.operators.filters import (
    any_of_filter, apply_session_filter, between_filter, conjunction, date_range, equal_filter, sentinel_to_null,
)
from shopflow.operators.joins import broadcast_if_small
from shopflow.params import TaskParams

# Bucket names of the session job (visit length in seconds,
# step count).  The reference names the buckets; the bounds are ours
VISIT_BUCKETS = (
    ("1s_3s", 1, 3), ("4s_6s", 4, 6), ("7s_9s", 7, 9), ("10s_30s", 10, 30),
    ("30s_60s", 31, 60), ("1m_3m", 61, 180), ("3m_10m", 181, 600),
    ("10m_30m", 601, 1800), ("30m", 1801, None),
)
STEP_BUCKETS = (
    ("1_3", 1, 3), ("4_6", 4, 6), ("7_9", 7, 9), ("10_30", 10, 30),
    ("30_60", 31, 60), ("60", 61, None),
)
SESSION_COUNT = "session_count"


def session_agg(actions: DataFrame, start: str, end: str) -> DataFrame:
    """A1: one row per session: user, first/last action, steps, distinct
    keywords and clicked categories, visit length in whole seconds."""
    t = parse_time("action_time")
    kw = F.when(is_not_empty("search_keyword"), F.col("search_keyword"))
    agg = date_range(actions, start, end).groupBy("session_id").agg(
        F.min("user_id").alias("user_id"),
        F.min(t).alias("start_ts"),
        F.max(t).alias("end_ts"),
        F.count(F.lit(1)).alias("step_length"),
        F.array_sort(F.collect_set(kw)).alias("search_keywords"),
        F.array_sort(F.collect_set(sentinel_to_null("click_category_id"))).alias("click_category_ids"),
    )
    return agg.withColumn("visit_length", F.unix_timestamp("end_ts") - F.unix_timestamp("start_ts"))


def session_user_join(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Sessions with the user's age, profession, city and sex (inner:
    sessions of unknown users drop out)."""
    u = users.select("user_id", "age", "professional", "city", "sex")
    return sessions.join(broadcast_if_small(u), "user_id")


def filtered_sessions(actions: DataFrame, users: DataFrame, params: TaskParams) -> DataFrame:
    """A1 -> J1 -> F5."""
    s = session_agg(actions, params.start_date, params.end_date)
    return apply_session_filter(session_user_join(s, users), params)


def user_filter(params: TaskParams) -> Column:
    """The part of F5 that looks at the user only (age, profession, city, sex)."""
    return conjunction([
        between_filter("age", params.start_age, params.end_age),
        any_of_filter("professional", params.professionals),
        any_of_filter("city", params.cities),
        equal_filter("sex", params.sex),
    ])


def filtered_session_lengths(actions: DataFrame, users: DataFrame, params: TaskParams) -> DataFrame:
    """A1 -> J1 -> F5 reduced to what the bucket counts need.

    Same sessions as ``filtered_sessions``, cheaper: the keyword and category
    tests become ``bool_or`` flags (the distinct lists are never built, so the
    aggregate stays a code-generated hash aggregate), and the sessions are
    semi-joined with the users that pass the user-only conditions.  The user
    of a session is tested after its aggregation, as in ``filtered_sessions``,
    whatever the size of either table.
    """
    t = parse_time("action_time")
    aggs = [
        F.min("user_id").alias("user_id"),
        (F.unix_timestamp(F.max(t)) - F.unix_timestamp(F.min(t))).alias("visit_length"),
        F.count(F.lit(1)).alias("step_length"),
    ]
    conds = []
    if params.keywords:
        aggs.append(F.bool_or(F.coalesce(F.col("search_keyword").isin(*params.keywords), F.lit(False))).alias("kw_hit"))
        conds.append(F.col("kw_hit"))
    if params.category_ids:
        cat = F.col("click_category_id")
        hit = (cat != F.lit(-1)) & cat.cast("string").isin(*params.category_ids)
        aggs.append(F.bool_or(F.coalesce(hit, F.lit(False))).alias("cat_hit"))
        conds.append(F.col("cat_hit"))
    acts = date_range(actions, params.start_date, params.end_date)
    sessions = acts.groupBy("session_id").agg(*aggs).where(conjunction(conds))
    passing = users.where(user_filter(params)).select("user_id")
    return sessions.join(broadcast_if_small(passing), "user_id", "left_semi").select(
        "session_id", "visit_length", "step_length")


def _in_bucket(c: Column, lo: int, hi: int | None) -> Column:
    return (c >= F.lit(lo)) if hi is None else c.between(F.lit(lo), F.lit(hi))


def bucket_rows(sessions: DataFrame) -> DataFrame:
    """A2: (kind, bucket, pos, sessions, total) for all 15 buckets.

    One global aggregate with a conditional count per bucket, then an
    unpivot; a visit of 0 s is in no visit bucket but in the total.
    """
    specs = _bucket_specs()
    one = sessions.agg(*_counters(specs))
    cells = [
        F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("bucket"), F.lit(i).alias("pos"),
                 F.col(f"b{i}").alias("sessions"))
        for i, (kind, name, _, _, _) in enumerate(specs)
    ]
    return one.select(F.col(SESSION_COUNT).alias("total"), F.inline(F.array(*cells)))


def _bucket_specs() -> list[tuple]:
    """(kind, bucket name, low, high, length column) of all 15 buckets."""
    specs = [("visit_length", n, lo, hi, F.col("visit_length")) for n, lo, hi in VISIT_BUCKETS]
    return specs + [("step_length", n, lo, hi, F.col("step_length")) for n, lo, hi in STEP_BUCKETS]


def _counters(specs: list[tuple]) -> list[Column]:
    """The session count and a conditional count for each bucket."""
    return [F.count(F.lit(1)).alias(SESSION_COUNT)] + [
        F.count_if(_in_bucket(c, lo, hi)).alias(f"b{i}") for i, (_, _, lo, hi, c) in enumerate(specs)]


def write_counted_sessions(sessions: DataFrame, path: str) -> list[tuple[str, str, int, int]]:
    """U4/A2: write the sessions and count them on the way; returns (kind, bucket, sessions, total).

    The counts are observed metrics of the very job that writes, not an accumulator that user
    code adds to: a task's part is taken once, when its attempt that counts has succeeded, so a
    retried or a speculative task adds nothing.  They must be observed in the writing stage itself, as
    here, with no shuffle after it.
    """
    specs, seen = _bucket_specs(), Observation("session counts")
    sessions.observe(seen, *_counters(specs)).write.mode("overwrite").parquet(path)
    got = seen.get
    return [(kind, name, got[f"b{i}"], got[SESSION_COUNT]) for i, (kind, name, _, _, _) in enumerate(specs)]


def session_ratios(sessions: DataFrame) -> DataFrame:
    """A3: share of each bucket, HALF_UP to 2 places; a total of 0 counts as 1."""
    b = bucket_rows(sessions)
    ratio = round_half_up(F.col("sessions") / F.greatest(F.col("total"), F.lit(1)), 2)
    return b.select("kind", "bucket", "sessions", F.col("total").alias("session_count"), ratio.alias("ratio"))


def session_ratio_job(actions: DataFrame, users: DataFrame, params: TaskParams,
                      task_id: str | None = None) -> DataFrame:
    """Q1 end to end."""
    return with_task_id(session_ratios(filtered_session_lengths(actions, users, params)), task_id)


def session_output(sessions: DataFrame) -> DataFrame:
    """Flat, text-only form of session rows (lists joined by commas)."""
    cols = [
        "session_id", "user_id",
        F.date_format("start_ts", TIME_FORMAT).alias("start_time"),
        F.date_format("end_ts", TIME_FORMAT).alias("end_time"),
        "step_length", "visit_length",
        F.array_join("search_keywords", ",").alias("search_keywords"),
        F.array_join("click_category_ids", ",").alias("click_category_ids"),
    ]
    extra = [c for c in ("age", "professional", "city", "sex") if c in sessions.columns]
    return sessions.select(*cols, *extra)
