"""The reference's UDF names for SQL users, as SQL-bodied functions.

``CREATE TEMPORARY FUNCTION ... RETURN <expr>`` functions are expanded into
their expression by the analyzer, so they stay inside whole-stage codegen;
nothing runs in Python.  The distinct concatenation (a UDAF in the
reference) needs no function: ``listagg(DISTINCT x, ',') WITHIN GROUP
(ORDER BY x)`` is built into Spark SQL.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from shopflow.functions.misc import AREA_LEVELS, DEFAULT_AREA_LEVEL

SQL_FUNCTIONS = {
    # Id, separator, name -> "<id><sep><name>"
    "concat_long_string":
        "(v BIGINT, s STRING, sep STRING) RETURNS STRING RETURN concat(cast(v AS STRING), sep, s)",
    # A top-level field of JSON text
    "get_json_field":
        "(json STRING, field STRING) RETURNS STRING RETURN get_json_object(json, concat('$.', field))",
}


def _area_level_body() -> str:
    whens = " ".join(
        "WHEN area IN ({}) THEN '{}'".format(", ".join(f"'{a}'" for a in names), level)
        for level, names in AREA_LEVELS
    )
    return f"(area STRING) RETURNS STRING RETURN CASE {whens} ELSE '{DEFAULT_AREA_LEVEL}' END"


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Register the functions in the session; returns their names."""
    bodies = dict(SQL_FUNCTIONS)
    bodies["area_level"] = _area_level_body()
    for name, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return sorted(bodies)


# Q3 written in SQL with those functions over temp views ``user_visit_action``,
# ``product_info`` and ``city_area`` (the evident query of the reference).
AREA_TOP3_SQL = """
WITH clicks AS (
  SELECT city_id, click_product_id AS pid FROM user_visit_action
  WHERE date >= :start_date AND date <= :end_date AND click_product_id != -1
), per_city AS (
  SELECT city_id, pid, count(*) AS n FROM clicks GROUP BY city_id, pid
), basic AS (
  SELECT c.n, a.area, c.pid, concat_long_string(c.city_id, a.city_name, ';') AS city_info
  FROM per_city c JOIN city_area a ON c.city_id = a.city_id
), cnt AS (
  SELECT area, pid, sum(n) AS click_count,
         listagg(DISTINCT city_info, ',') WITHIN GROUP (ORDER BY city_info) AS city_infos
  FROM basic GROUP BY area, pid
), info AS (
  SELECT cnt.*, p.product_name,
         IF(get_json_field(p.extend_info, 'product_status') = '0', 'self', 'Third Party') AS product_status
  FROM cnt JOIN product_info p ON cnt.pid = p.product_id
)
SELECT area, area_level(area) AS area_level, pid AS product_id, city_infos, click_count, product_name,
       product_status
FROM (SELECT *, row_number() OVER (PARTITION BY area ORDER BY click_count DESC, pid) AS rn FROM info)
WHERE rn <= :n
"""
