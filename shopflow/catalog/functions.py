"""Scalar functions and the distinct concat as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shopflow.catalog.registry import register
from shopflow.functions import dates as fd
from shopflow.functions import misc as fm
from shopflow.functions import strings as fs
from shopflow.operators.aggregates import group_concat_distinct
from shopflow.oracle import with_views
from shopflow.sources import tables, views

@register("group_concat_distinct", with_views("user_visit_action") +
          "select user_id, coalesce(string_agg(distinct search_keyword, ',' order by search_keyword), '') "
          "as keywords from user_visit_action group by user_id")
def q_group_concat_distinct(spark, sf_dir):
    """A5: sorted distinct search keywords of each user, comma-joined."""
    uva = views.user_visit_action(spark, sf_dir)
    return uva.groupBy("user_id").agg(group_concat_distinct("search_keyword").alias("keywords"))


@register("concat_long_string", "select c_custkey, cast(c_custkey as varchar) || ';' || c_name as city_info "
          "from customer")
def q_concat_long_string(spark, sf_dir):
    """Number, separator and text joined."""
    c = tables.read_table(spark, sf_dir, "customer")
    return c.select("c_custkey", fs.concat_long_string("c_custkey", "c_name", ";").alias("city_info"))


@register("json_status", with_views("product_info") +
          "select product_id, extend_info::json->>'$.product_status' as status_field, "
          "case when extend_info::json->>'$.product_status' = '0' then 'self' else 'Third Party' end "
          "as product_status from product_info")
def q_json_status(spark, sf_dir):
    """X2 + X3: JSON field of the product info and the ownership label."""
    p = views.product_info(spark, sf_dir)
    return p.select("product_id", fm.json_field("extend_info", "product_status").alias("status_field"),
                    fm.product_status("extend_info").alias("product_status"))


@register("round_half_up", "select event_id, "
          "cast(round(cast(cast(value / 3 as varchar) as decimal(38, 12)), 2) as double) as r3, "
          "cast(round(cast(cast(value * 0.5 as varchar) as decimal(38, 12)), 2) as double) as r_half "
          "from events")
def q_round_half_up(spark, sf_dir):
    """X11: HALF_UP rounding on the decimal text of a double."""
    e = tables.read_table(spark, sf_dir, "events")
    return e.select("event_id", fm.round_half_up(F.col("value") / 3, 2).alias("r3"),
                    fm.round_half_up(F.col("value") * 0.5, 2).alias("r_half"))


_T = "strptime(action_time, '%Y-%m-%d %H:%M:%S')"


@register("date_functions", with_views("user_visit_action") + f"""
select action_id,
  {_T} < timestamp '2024-01-15 00:15:00' as before_ref,
  {_T} > timestamp '2024-01-15 00:15:00' as after_ref,
  date_diff('second', strptime(date || ' 0:00:00', '%Y-%m-%d %H:%M:%S'), {_T}) as secs_into_day,
  strftime({_T}, '%Y-%m-%d_%H') as date_hour,
  strftime({_T}, '%Y-%m-%d') as fmt_date,
  strftime({_T}, '%Y-%m-%d %H:%M:%S') as fmt_time,
  strftime({_T}, '%Y%m%d') as date_key,
  strftime({_T}, '%Y%m%d%H%M') as minute_key,
  strftime(cast(strptime(strftime({_T}, '%Y%m%d'), '%Y%m%d') as date), '%Y-%m-%d') as parsed_date_key
from user_visit_action""")
def q_date_functions(spark, sf_dir):
    """before/after, seconds between, date-hour, the four formats, date-key parse."""
    u = views.user_visit_action(spark, sf_dir)
    ref = F.lit("2024-01-15 0:15:00")
    t = fd.parse_time("action_time")
    return u.select(
        "action_id",
        fd.time_before("action_time", ref).alias("before_ref"),
        fd.time_after("action_time", ref).alias("after_ref"),
        fd.seconds_between("action_time", F.concat("date", F.lit(" 0:00:00"))).alias("secs_into_day"),
        fd.date_hour("action_time").alias("date_hour"),
        fd.format_date(t).alias("fmt_date"),
        fd.format_time(t).alias("fmt_time"),
        fd.format_date_key(t).alias("date_key"),
        fd.format_time_minute(t).alias("minute_key"),
        F.date_format(fd.parse_date_key(fd.format_date_key(t)), fd.DATE_FORMAT).alias("parsed_date_key"),
    )


_PACKED = ("'sessionid=' || session_id || '|searchKeywords=' || coalesce(search_keyword, '') "
           "|| '|stepLength=' || cast(page_id as varchar)")


@register("string_functions", with_views("user_visit_action") + f"""
select action_id,
  coalesce(search_keyword, '') = '' as kw_empty,
  trim(',' || coalesce(order_category_ids, '') || ',', ',') as trimmed,
  lpad(cast(page_id as varchar), 2, '0') as page_padded,
  nullif(regexp_extract({_PACKED}, '(^|[|])searchKeywords=([^|]*)', 2), '') as kw_field,
  'searchKeywords=' || coalesce(search_keyword, '') || '|sessionid=' || session_id || '|stepLength=0' as packed_set
from user_visit_action""")
def q_string_functions(spark, sf_dir):
    """Empty test, comma trim, two-digit pad, get and set a field of ``k=v|k=v`` text."""
    u = views.user_visit_action(spark, sf_dir)
    packed = F.concat(F.lit("sessionid="), F.col("session_id"), F.lit("|searchKeywords="),
                      F.coalesce(F.col("search_keyword"), F.lit("")), F.lit("|stepLength="),
                      F.col("page_id").cast("string"))
    return u.select(
        "action_id",
        fs.is_empty("search_keyword").alias("kw_empty"),
        fs.trim_comma(F.concat(F.lit(","), F.coalesce(F.col("order_category_ids"), F.lit("")), F.lit(","))).alias(
            "trimmed"),
        fs.pad_two(F.col("page_id").cast("string")).alias("page_padded"),
        fs.kv_get(packed, "searchKeywords").alias("kw_field"),
        fs.kv_set(packed, "stepLength", "0").alias("packed_set"),
    )
