"""Q2 page conversion and its operators."""

from __future__ import annotations

from shopflow.catalog.registry import DATES, P, register
from shopflow.functions.strings import flow_pairs
from shopflow.oracle import with_views
from shopflow.plans import funnel
from shopflow.sources import views

# ---------------------------------------------------------- Q2 funnel -----


_FLOW = P.target_page_flow
_STEPS_VALUES = ", ".join(f"({i + 1}, '{p}')" for i, p in flow_pairs(_FLOW))
_TARGETS = ", ".join(f"'{p}'" for _, p in flow_pairs(_FLOW))
_PAIR_CTES = [
    ("acts", f"select session_id, strptime(action_time, '%Y-%m-%d %H:%M:%S') as t, action_id, page_id "
             f"from user_visit_action where {DATES}"),
    ("pairs", "select session_id, page_id as from_page, lead(page_id) over "
              "(partition by session_id order by t nulls first, action_id) as to_page from acts"),
    ("cnt", "select cast(from_page as varchar) || '_' || cast(to_page as varchar) as page_pair, count(*) as n "
            "from pairs where to_page is not null group by 1"),
    ("st", f"select count(*) as c0 from acts where page_id = {_FLOW[0]}"),
    ("steps(step, page_pair)", f"VALUES {_STEPS_VALUES}"),
    ("conv", "select s.step, s.page_pair, coalesce(c.n, 0) as pair_count, "
             "coalesce(lag(coalesce(c.n, 0)) over (order by s.step), (select c0 from st)) as prev_count "
             "from steps s left join cnt c on s.page_pair = c.page_pair"),
]


def _actions(spark, sf_dir):
    return views.user_visit_action(spark, sf_dir, P.start_date, P.end_date)


@register("page_pairs", with_views("user_visit_action", extra=_PAIR_CTES[:2]) +
          "select session_id, from_page, to_page from pairs where to_page is not null")
def q_page_pairs(spark, sf_dir):
    """Consecutive page pairs of every session in time order (skew-safe)."""
    return funnel.page_pairs(_actions(spark, sf_dir), P.start_date, P.end_date)


@register("page_pair_counts", with_views("user_visit_action", extra=_PAIR_CTES[:3]) +
          f"select page_pair, n as pair_count from cnt where page_pair in ({_TARGETS})")
def q_page_pair_counts(spark, sf_dir):
    """F8 + A6: occurrences of each target page pair."""
    return funnel.page_pair_counts(_actions(spark, sf_dir), P)


@register("start_page_count", with_views("user_visit_action", extra=_PAIR_CTES[:1]) +
          f"select count(*) as start_page_count from acts where page_id = {_FLOW[0]}")
def q_start_page_count(spark, sf_dir):
    """Views of the flow's start page."""
    return funnel.start_page_count(_actions(spark, sf_dir), P)


@register("page_conversion", with_views("user_visit_action", extra=_PAIR_CTES) +
          "select step, page_pair, pair_count, prev_count, "
          "case when prev_count = 0 then null else pair_count / prev_count end as convert_rate from conv")
def q_page_conversion(spark, sf_dir):
    """Per step of the flow: pair count, previous count, conversion rate."""
    return funnel.page_conversion(_actions(spark, sf_dir), P)


@register("page_conversion_string", with_views("user_visit_action", extra=_PAIR_CTES) +
          "select string_agg(page_pair || '=' || coalesce(cast(case when prev_count = 0 then null "
          "else pair_count / prev_count end as varchar), 'NULL'), '|' order by step) as convert_rate from conv")
def q_page_conversion_string(spark, sf_dir):
    """The conversion rates as one ``1_2=r|2_3=r|...`` text in flow order."""
    return funnel.page_conversion_string(_actions(spark, sf_dir), P)
