"""Sinks as queries (K2, K3): write, then read back."""

from __future__ import annotations

import uuid

from shopflow.catalog.ads import STAT_CTE, ad_with, parsed_log
from shopflow.catalog.registry import ORACLES, register
from shopflow.config import fresh_dir
from shopflow.plans import ads, words
from shopflow.sources import views
from shopflow.sources.store import read_csv, replace_table, write_csv

# ------------------------------------------------------------------ sinks --




@register("replace_table", ad_with(STAT_CTE) + "select * from stat")
def q_replace_table(spark, sf_dir):
    """K2: a catalog table (files in the shared folder) replaced by the ad
    statistics, even though its earlier content had another schema; read back."""
    name = f"shopflow_ad_stat_{uuid.uuid4().hex[:12]}"
    path = fresh_dir(spark, "catalog")
    replace_table(words.word_count(views.document_lines(spark, sf_dir)), name, path)
    replace_table(ads.ad_stat(parsed_log(spark, sf_dir)), name, path)
    return spark.table(name)


@register("csv_single_file", ad_with(STAT_CTE) + "select * from stat")
def q_csv_single_file(spark, sf_dir):
    """K3: the ad statistics written as one CSV file, read back."""
    path = fresh_dir(spark, "csv")
    stat = ads.ad_stat(parsed_log(spark, sf_dir))
    write_csv(stat, path)
    return read_csv(spark, path, stat.schema)


@register("csv_word_count", ORACLES["word_count"])
def q_csv_word_count(spark, sf_dir):
    """K3: the word counts of all documents written as CSV by all tasks, read back unchanged."""
    path = fresh_dir(spark, "csv")
    counts = words.word_count(views.document_lines(spark, sf_dir))
    write_csv(counts, path, single_file=False)
    return read_csv(spark, path, counts.schema)


@register("text_file_word_count", ORACLES["word_count"])
def q_text_file_word_count(spark, sf_dir):
    """The documents' lines as text files, read as text and counted."""
    path = fresh_dir(spark, "text")
    views.document_lines(spark, sf_dir).select("line").write.option("lineSep", "\n").text(path)
    return words.word_count(words.text_file_lines(spark, path))
