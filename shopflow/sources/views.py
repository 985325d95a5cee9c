"""Input views in the schemas the jobs expect, derived from the test tables.

The jobs read ``user_visit_action``, ``user_info``, ``product_info`` and ad-log
lines.  These builders only give rows in those schemas (the mapping is fixed
in FIXTURES.md); they do none of the jobs' work, and the jobs rely on nothing
about how the rows were made.

Each view is one SQL text with ``{events}``-style placeholders; Spark fills
them with DataFrames (``spark.sql(text, events=df)``), the DuckDB oracle with
the registered table names, so both sides read the very same definition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.sources.tables import read_table

USER_VISIT_ACTION_SQL = """
select event_id as action_id,
 cast(cast(ts as date) as string) as date,
 user_id,
 concat(cast(user_id as string),'_',cast(cast(ts as date) as string)) as session_id,
 k % 10 as page_id,
 concat(cast(cast(ts as date) as string),' 0:',
        lpad(cast(cast(floor(cs/60) as bigint) as string),2,'0'),':',
        lpad(cast(cs % 60 as string),2,'0')) as action_time,
 case when event_type='view' then concat('kw',cast(k % 10 as string)) end as search_keyword,
 case when event_type='click' then k else -1 end as click_category_id,
 case when event_type='click' then (event_id + user_id) % 100 else -1 end as click_product_id,
 case when event_type='purchase' then cast(k as string) end as order_category_ids,
 case when event_type='purchase' then cast(event_id % 100 as string) end as order_product_ids,
 case when event_type='signup' then cast(k as string) end as pay_category_ids,
 case when event_type='signup' then cast(event_id % 100 as string) end as pay_product_ids,
 event_id % 10 as city_id
from (select *, try_cast(regexp_extract(props,'([0-9]+)',1) as bigint) as k,
        cast(floor((hour(ts)*3600+minute(ts)*60+second(ts))/48) as bigint) as cs
      from {events}) e
"""

USER_INFO_SQL = """
select c_custkey as user_id, concat('user',cast(c_custkey as string)) as username, c_name as name,
 cast(c_custkey % 60 as int) as age, c_mktsegment as professional,
 concat('city',cast(c_nationkey as string)) as city,
 case when c_custkey % 2 = 0 then 'male' else 'female' end as sex
from {customer}
"""

PRODUCT_INFO_SQL = """
select p_partkey as product_id, p_name as product_name,
 concat('{{"product_status": ',cast(p_partkey % 2 as string),'}}') as extend_info
from {part}
"""

# Ad log lines "<epoch ms> <province> <city> <userid> <adid>"; province = city
# as in the reference.  Spark truncates to milliseconds; DuckDB's epoch_ms
# rounds, so its text goes through microseconds.
AD_LOG_SQL_SPARK = """
select concat_ws(' ', unix_millis(cast(ts as timestamp)), event_id % 10, event_id % 10,
                 user_id, (event_id + user_id) % 20) as value
from {events}
"""

# The same lines with the source event time, to replay them in time order.
AD_LOG_WITH_TIME_SQL_SPARK = """
select concat_ws(' ', unix_millis(cast(ts as timestamp)), event_id % 10, event_id % 10,
                 user_id, (event_id + user_id) % 20) as value, ts
from {events}
"""

AD_LOG_SQL_DUCKDB = """
select concat_ws(' ', epoch_us(ts) // 1000, event_id % 10, event_id % 10,
                 user_id, (event_id + user_id) % 20) as value
from {events}
"""

# Lines of the documents: the word-count input.  A text with n newline
# characters gives n + 1 lines (a final newline gives a final empty line).
DOC_LINES_SQL = """
select doc_id, posexplode(split(text, '\\n', -1)) as (line_no, line)
from {documents}
"""

DOC_LINES_SQL_DUCKDB = """
select doc_id, line_no, line
from (select doc_id, unnest(string_split(text, chr(10))) as line,
             unnest(range(len(string_split(text, chr(10))))) as line_no
      from {documents})
"""


def user_visit_action(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """The action view; with ``start`` and ``end`` (inclusive dates) only events of those days.

    The bounds are put on the stored ``ts``, where the scan can use them to skip
    row groups; the job's own filter on the derived ``date`` cannot reach it.
    """
    events = read_table(spark, sf_dir, "events")
    if start is not None and end is not None:
        kind = events.schema["ts"].dataType
        after = F.date_add(F.lit(end).cast("date"), 1)
        events = events.where((F.col("ts") >= F.lit(start).cast(kind)) & (F.col("ts") < after.cast(kind)))
    return spark.sql(USER_VISIT_ACTION_SQL, events=events)


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(USER_INFO_SQL, customer=read_table(spark, sf_dir, "customer"))


def product_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(PRODUCT_INFO_SQL, part=read_table(spark, sf_dir, "part"))


def ad_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single ``value`` string column, like a Kafka value or a text line."""
    return spark.sql(AD_LOG_SQL_SPARK, events=read_table(spark, sf_dir, "events"))


def ad_log_lines_with_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value`` plus the source event time ``ts``, to replay lines in time order."""
    return spark.sql(AD_LOG_WITH_TIME_SQL_SPARK, events=read_table(spark, sf_dir, "events"))


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(DOC_LINES_SQL, documents=read_table(spark, sf_dir, "documents"))


def duckdb_views() -> dict[str, str]:
    """View texts for the DuckDB oracle, named as in the jobs."""
    return {
        "user_visit_action": USER_VISIT_ACTION_SQL.format(events="events"),
        "user_info": USER_INFO_SQL.format(customer="customer"),
        "product_info": PRODUCT_INFO_SQL.format(part="part"),
        "ad_log": AD_LOG_SQL_DUCKDB.format(events="events"),
        "doc_lines": DOC_LINES_SQL_DUCKDB.format(documents="documents"),
    }
