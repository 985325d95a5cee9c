"""Q3: the three most clicked products per area.

One logical plan from the action scan to the result:
scan (date range, clicks only, 2 columns) -> count per (city, product) ->
join with the city dimension (broadcast if small) -> sum and distinct city
list per (area, product) -> join with products -> top-3 per area -> area level.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.functions.misc import area_level, product_status
from shopflow.functions.strings import concat_long_string
from shopflow.operators.aggregates import group_concat_distinct, with_task_id
from shopflow.operators.filters import date_range
from shopflow.operators.joins import broadcast_if_small
from shopflow.operators.topk import top_n


def city_product_clicks(actions: DataFrame, start: str, end: str) -> DataFrame:
    """(city_id, pid) of the clicks in the date range."""
    return (
        date_range(actions, start, end)
        .where(F.col("click_product_id") != F.lit(-1))
        .select("city_id", F.col("click_product_id").alias("pid"))
    )


def area_basic_info(clicks: DataFrame, city_area: DataFrame) -> DataFrame:
    """Clicks joined with the city dimension (inner)."""
    return clicks.join(broadcast_if_small(city_area), "city_id").select("city_id", "city_name", "area", "pid")


def area_click_count(clicks: DataFrame, city_area: DataFrame) -> DataFrame:
    """A4 + A5: clicks and the distinct ``id;name`` city list per (area, pid).

    Clicks are counted per (city, product) first, a plain hash aggregate over all
    rows; the city join and the set of cities see one row per city and product.
    """
    per_city = clicks.groupBy("city_id", "pid").agg(F.count(F.lit(1)).alias("n"))
    basic = per_city.join(broadcast_if_small(city_area), "city_id")
    return basic.groupBy("area", "pid").agg(
        F.sum("n").alias("click_count"),
        group_concat_distinct(concat_long_string("city_id", "city_name", ";")).alias("city_infos"),
    )


def area_product_info(counts: DataFrame, products: DataFrame) -> DataFrame:
    """J3 + X2 + X3: attach product name and ownership label (inner join)."""
    prod = products.select(
        F.col("product_id").alias("pid"),
        "product_name",
        product_status("extend_info").alias("product_status"),
    )
    return counts.join(broadcast_if_small(prod), "pid")


def area_top3(
    actions: DataFrame,
    products: DataFrame,
    city_area: DataFrame,
    start: str,
    end: str,
    n: int = 3,
    task_id: str | None = None,
) -> DataFrame:
    """Q3 end to end: W1 top-n per area by clicks (ties: smaller pid), X4 level."""
    clicks = city_product_clicks(actions, start, end)
    counts = area_click_count(clicks, city_area)
    info = area_product_info(counts, products)
    top = top_n(info, ["area"], [F.desc("click_count"), F.asc("pid")], n)
    return with_task_id(top.select(
        "area",
        area_level("area").alias("area_level"),
        F.col("pid").alias("product_id"),
        "city_infos",
        "click_count",
        "product_name",
        "product_status",
    ), task_id)
