"""Q3 area top-3, its stages (S2, J2, J3, A4, A5, X4) and its SQL form."""

from __future__ import annotations

from shopflow.catalog.registry import DATES, ORACLES, P, register
from shopflow.functions import misc as fm
from shopflow.functions.sql import AREA_TOP3_SQL, register_sql_functions
from shopflow.oracle import AREA_LEVEL_CASE, with_views
from shopflow.plans import area
from shopflow.sources import tables, views

# ---------------------------------------------------------------- Q3 area --

AREA_CTES = [
    ("clicks", f"select city_id, click_product_id as pid from user_visit_action "
               f"where {DATES} and click_product_id != -1"),
    ("basic", "select c.city_id, a.city_name, a.area, c.pid from clicks c join city_area a on c.city_id = a.city_id"),
    ("cnt", "select area, pid, count(*) as click_count, "
            "string_agg(distinct cast(city_id as varchar) || ';' || city_name, ',' "
            "order by cast(city_id as varchar) || ';' || city_name) as city_infos "
            "from basic group by area, pid"),
    ("info", "select cnt.*, p.product_name, case when p.extend_info::json->>'$.product_status' = '0' "
             "then 'self' else 'Third Party' end as product_status "
             "from cnt join product_info p on cnt.pid = p.product_id"),
]


@register("area_top3", with_views("user_visit_action", "product_info", "city_area", extra=AREA_CTES) + f"""
select area, {AREA_LEVEL_CASE} as area_level, pid as product_id, city_infos, click_count, product_name, product_status
from (select *, row_number() over (partition by area order by click_count desc, pid) as rn from info) r
where rn <= 3
""")
def q_area_top3(spark, sf_dir):
    """Q3: three most clicked products per area with cities, name, ownership, level."""
    return area.area_top3(
        views.user_visit_action(spark, sf_dir, P.start_date, P.end_date), views.product_info(spark, sf_dir),
        tables.city_area(spark), P.start_date, P.end_date,
    )


@register("scan_city_product", with_views("user_visit_action", extra=AREA_CTES[:1]) + "select * from clicks")
def q_scan_city_product(spark, sf_dir):
    """(city_id, pid) of the clicks in the date range."""
    return _clicks(spark, sf_dir)


def _clicks(spark, sf_dir):
    return area.city_product_clicks(views.user_visit_action(spark, sf_dir, P.start_date, P.end_date), P.start_date, P.end_date)


def _counts(spark, sf_dir):
    return area.area_click_count(_clicks(spark, sf_dir), tables.city_area(spark))


@register("area_basic_info", with_views("user_visit_action", "city_area", extra=AREA_CTES[:2]) +
          "select * from basic")
def q_area_basic_info(spark, sf_dir):
    """Clicks joined with the literal city dimension (broadcast)."""
    return area.area_basic_info(_clicks(spark, sf_dir), tables.city_area(spark))


@register("area_click_count", with_views("user_visit_action", "city_area", extra=AREA_CTES[:3]) +
          "select * from cnt")
def q_area_click_count(spark, sf_dir):
    """A4 + A5: clicks and distinct ``id;name`` city list per (area, product)."""
    return _counts(spark, sf_dir)


@register("area_product_info", with_views("user_visit_action", "product_info", "city_area", extra=AREA_CTES) +
          "select area, pid, click_count, city_infos, product_name, product_status from info")
def q_area_product_info(spark, sf_dir):
    """J3 + X2 + X3: per-(area, product) counts with product name and ownership."""
    counts = _counts(spark, sf_dir)
    return area.area_product_info(counts, views.product_info(spark, sf_dir)).select(
        "area", "pid", "click_count", "city_infos", "product_name", "product_status")


@register("area_level", with_views("user_visit_action", "city_area", extra=AREA_CTES[:3]) +
          f"select area, pid, click_count, {AREA_LEVEL_CASE} as area_level from cnt")
def q_area_level(spark, sf_dir):
    """Area level of every (area, product) count row."""
    counts = _counts(spark, sf_dir)
    return counts.select("area", "pid", "click_count", fm.area_level("area").alias("area_level"))


# -------------------------------------------------------------- SQL users --



@register("area_top3_sql", ORACLES["area_top3"])
def q_area_top3_sql(spark, sf_dir):
    """Q3 in Spark SQL with the reference's function names (SQL-bodied
    functions, listagg for the distinct concat) over temp views."""
    register_sql_functions(spark)
    views.user_visit_action(spark, sf_dir, P.start_date, P.end_date).createOrReplaceTempView("user_visit_action")
    views.product_info(spark, sf_dir).createOrReplaceTempView("product_info")
    tables.city_area(spark).createOrReplaceTempView("city_area")
    return spark.sql(AREA_TOP3_SQL, args={"start_date": P.start_date, "end_date": P.end_date, "n": 3})
