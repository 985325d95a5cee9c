"""Readers for the parquet tables and the literal city dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table; Catalyst prunes columns and pushes filters into the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# The city -> area dimension of the area job (city id, city
# name, area), ten literal rows in the reference.
CITY_AREA_ROWS = [
    (0, "北京", "华北"), (1, "上海", "华东"), (2, "南京", "华东"),
    (3, "广州", "华南"), (4, "三亚", "华南"), (5, "武汉", "华中"),
    (6, "长沙", "华中"), (7, "西安", "西北"), (8, "成都", "西南"),
    (9, "哈尔滨", "东北"),
]

def city_area(spark: SparkSession) -> DataFrame:
    """S3: the literal city dimension, as a VALUES relation whose size the optimizer knows exactly."""
    rows = ", ".join(f"({i}L, '{city}', '{area}')" for i, city, area in CITY_AREA_ROWS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(city_id, city_name, area)")
