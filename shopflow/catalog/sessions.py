"""Q1 session ratios and its operators."""

from __future__ import annotations

from shopflow.catalog.registry import DATES, P, S1_END, S1_START, register
from shopflow.oracle import with_views
from shopflow.plans import sessions as sess
from shopflow.sources import views

# ------------------------------------------------------------ Q1 sessions --


_SESS_AGG = f"""
select session_id, min(user_id) as user_id, min(t) as s, max(t) as e, count(*) as step_length,
  coalesce(array_to_string(list_sort(list_distinct(list(case when search_keyword <> '' then search_keyword end))), ','), '')
    as search_keywords,
  coalesce(array_to_string(list_sort(list_distinct(list(case when click_category_id <> -1 then click_category_id end))), ','), '')
    as click_category_ids
from (select *, strptime(action_time, '%Y-%m-%d %H:%M:%S') as t from user_visit_action where {DATES}) a
group by session_id
"""
_SESS_COLS = ("session_id, user_id, strftime(s, '%Y-%m-%d %H:%M:%S') as start_time, "
              "strftime(e, '%Y-%m-%d %H:%M:%S') as end_time, step_length, date_diff('second', s, e) as visit_length, "
              "search_keywords, click_category_ids")
_SESS_JOIN = (f"select {_SESS_COLS}, u.age, u.professional, u.city, u.sex "
              "from sess join user_info u using (user_id)")
_PROFS = ", ".join(f"'{p}'" for p in P.professionals)
_SESS_FILTER = f"select * from joined where age between {P.start_age} and {P.end_age} and professional in ({_PROFS})"
_SESS_CTES = [("sess", _SESS_AGG), ("joined", _SESS_JOIN), ("filtered", _SESS_FILTER)]


def _bucket_values() -> str:
    rows = [("visit_length", n, lo, hi) for n, lo, hi in sess.VISIT_BUCKETS]
    rows += [("step_length", n, lo, hi) for n, lo, hi in sess.STEP_BUCKETS]
    return ", ".join(f"('{k}', '{n}', {lo}, {hi if hi is not None else 'NULL'})" for k, n, lo, hi in rows)


_BUCKET_CTES = _SESS_CTES + [
    ("b(kind, bucket, lo, hi)", f"VALUES {_bucket_values()}"),
    ("tot", "select count(*) as total from filtered"),
    ("cnt", "select b.kind, b.bucket, count(f.session_id) as sessions from b left join filtered f on "
            "(case when b.kind = 'visit_length' then f.visit_length else f.step_length end) >= b.lo and "
            "(b.hi is null or (case when b.kind = 'visit_length' then f.visit_length else f.step_length end) <= b.hi) "
            "group by b.kind, b.bucket"),
]


def _sessions(spark, sf_dir):
    return sess.session_agg(views.user_visit_action(spark, sf_dir, P.start_date, P.end_date), P.start_date, P.end_date)


def _joined(spark, sf_dir):
    return sess.session_user_join(_sessions(spark, sf_dir), views.user_info(spark, sf_dir))


@register("session_agg", with_views("user_visit_action", extra=_SESS_CTES[:1]) + f"select {_SESS_COLS} from sess")
def q_session_agg(spark, sf_dir):
    """A1: per-session user, first/last time, steps, visit seconds, keyword and category lists."""
    return sess.session_output(_sessions(spark, sf_dir))


@register("session_user_join", with_views("user_visit_action", "user_info", extra=_SESS_CTES[:2]) + "select * from joined")
def q_session_user_join(spark, sf_dir):
    """Sessions joined with their user's attributes (inner)."""
    return sess.session_output(_joined(spark, sf_dir))


@register("session_filter", with_views("user_visit_action", "user_info", extra=_SESS_CTES) + "select * from filtered")
def q_session_filter(spark, sf_dir):
    """sessions passing the optional-parameter filter (age 20-50, two professions)."""
    return sess.session_output(
        sess.filtered_sessions(views.user_visit_action(spark, sf_dir, P.start_date, P.end_date), views.user_info(spark, sf_dir), P))


@register("session_buckets", with_views("user_visit_action", "user_info", extra=_BUCKET_CTES) +
          "select cnt.kind, cnt.bucket, cnt.sessions, tot.total from cnt, tot")
def q_session_buckets(spark, sf_dir):
    """A2: filtered sessions per visit-length and step-count bucket, with the total."""
    f = sess.filtered_session_lengths(views.user_visit_action(spark, sf_dir, P.start_date, P.end_date), views.user_info(spark, sf_dir), P)
    return sess.bucket_rows(f).select("kind", "bucket", "sessions", "total")


@register("session_ratio", with_views("user_visit_action", "user_info", extra=_BUCKET_CTES) +
          "select cnt.kind, cnt.bucket, cnt.sessions, tot.total as session_count, "
          "floor(cnt.sessions * 100.0 / greatest(tot.total, 1) + 0.5) / 100 as ratio from cnt, tot")
def q_session_ratio(spark, sf_dir):
    """Q1/A3: share of filtered sessions per bucket, rounded HALF_UP to 2 places."""
    return sess.session_ratio_job(views.user_visit_action(spark, sf_dir, P.start_date, P.end_date), views.user_info(spark, sf_dir), P)


_JOINED_CTES = _SESS_CTES[:2]


@register("filter_between", with_views("user_visit_action", "user_info", extra=_JOINED_CTES) +
          f"select * from joined where age between {P.start_age} and {P.end_age}")
def q_filter_between(spark, sf_dir):
    """inclusive numeric range on the user's age (both bounds set)."""
    from shopflow.operators.filters import between_filter
    return sess.session_output(_joined(spark, sf_dir).where(between_filter("age", P.start_age, P.end_age)))


@register("filter_any_of", with_views("user_visit_action", "user_info", extra=_JOINED_CTES) +
          "select * from joined where list_has_any(string_split(search_keywords, ','), ['kw1', 'kw3']) "
          "and professional in ('BUILDING', 'MACHINERY', 'HOUSEHOLD')")
def q_filter_any_of(spark, sf_dir):
    """any-of on a list column (keywords) and on a scalar column (profession)."""
    from shopflow.operators.filters import any_of_filter, conjunction
    cond = conjunction([
        any_of_filter("search_keywords", ["kw1", "kw3"], is_array=True),
        any_of_filter("professional", ["BUILDING", "MACHINERY", "HOUSEHOLD"]),
    ])
    return sess.session_output(_joined(spark, sf_dir).where(cond))


@register("filter_equal", with_views("user_visit_action", "user_info", extra=_JOINED_CTES) +
          "select * from joined where sex = 'female'")
def q_filter_equal(spark, sf_dir):
    """equality on the user's sex."""
    from shopflow.operators.filters import equal_filter
    return sess.session_output(_joined(spark, sf_dir).where(equal_filter("sex", "female")))


_UVA_COLS = ("action_id, date, user_id, session_id, page_id, action_time, search_keyword, click_category_id, "
             "click_product_id, order_category_ids, order_product_ids, pay_category_ids, pay_product_ids, city_id")


@register("scan_date_range", with_views("user_visit_action") +
          f"select {_UVA_COLS} from user_visit_action where date between '{S1_START}' and '{S1_END}'")
def q_scan_date_range(spark, sf_dir):
    """Actions of an inclusive date range, all columns."""
    from shopflow.operators.filters import date_range
    return date_range(views.user_visit_action(spark, sf_dir, S1_START, S1_END), S1_START, S1_END)
