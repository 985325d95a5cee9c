"""Q8 top-1 per key, Q9 word count and delimited rows."""

from __future__ import annotations

from shopflow.catalog.registry import register
from shopflow.oracle import with_views
from shopflow.plans import words
from shopflow.sources import tables, views

JAVA_TOKENS = ("case when line = '' then [''] when rtrim(line, ' ') = '' then []::varchar[] "
                "else string_split(rtrim(line, ' '), ' ') end")


@register("word_count", with_views("doc_lines") +
          f"select word, count(*) as count from (select unnest({JAVA_TOKENS}) as word from doc_lines) "
          "group by word")
def q_word_count(spark, sf_dir):
    """Word frequencies over every line of every document (empty tokens kept)."""
    return words.word_count(views.document_lines(spark, sf_dir))


_TECH_LINES = ("select concat_ws(',', cast(c_nationkey as string), c_name, cast(c_custkey % 60 as string)) "
               "as value from {customer}")


def _tech_rows(spark, sf_dir):
    lines = spark.sql(_TECH_LINES, customer=tables.read_table(spark, sf_dir, "customer"))
    return words.delimited_rows(lines, "id STRING, name STRING, age INT")


_TECH_ORACLE = ("select cast(c_nationkey as varchar) as id, c_name as name, cast(c_custkey % 60 as int) as age "
                "from customer")


@register("delimited_rows", _TECH_ORACLE)
def q_delimited_rows(spark, sf_dir):
    """Rows parsed from comma-delimited text with an explicit schema."""
    return _tech_rows(spark, sf_dir)


@register("top1_per_key", f"select id, name, age from (select *, row_number() over "
          f"(partition by id order by age desc, name) as rn from ({_TECH_ORACLE})) where rn = 1")
def q_top1_per_key(spark, sf_dir):
    """Highest age per id (ties: smaller name), over the parsed rows."""
    return words.top1_per_key(_tech_rows(spark, sf_dir))
