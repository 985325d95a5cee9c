"""Stored tables that a batch need not move or read whole: bitmaps, buckets, date partitions, observed counts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from shopflow.catalog.ads import _SPLIT, Q_THRESHOLD, parsed_log
from shopflow.catalog.registry import ORACLES, P, S1_END, S1_START, register
from shopflow.config import fresh_dir
from shopflow.operators import bitmaps, bucketed
from shopflow.operators.aggregates import count_by
from shopflow.operators.filters import date_range
from shopflow.oracle import with_views
from shopflow.plans import ads
from shopflow.plans import sessions as sess
from shopflow.sources import partitioned, views
from shopflow.sources.store import replace_table

#: Buckets of the stored tables of these queries; a production table has as many as its size asks for.
BUCKETS = 16


def _name(kind: str) -> str:
    return f"shopflow_{kind}_{uuid.uuid4().hex[:12]}"


@register("blacklist_filter_bitmap", ORACLES["blacklist_filter"])
def q_blacklist_filter_bitmap(spark, sf_dir):
    """Clicks of users not on the blacklist, tested by bitmaps; the log is not shuffled."""
    log = parsed_log(spark, sf_dir)
    black = ads.users_over_threshold(ads.user_click_counts(log), Q_THRESHOLD)
    return bitmaps.exclude_ids(log, black, "userid").drop("ts")


@register("upsert_bucketed", ORACLES["upsert_add"])
def q_upsert_bucketed(spark, sf_dir):
    """K6: stored per-(user, ad) counts in a bucketed table plus a newer batch's; the new table is bucketed again."""
    keys = ["userid", "adid"]
    log = parsed_log(spark, sf_dir)
    stored = bucketed.write_bucketed(count_by(log.where(F.col("date") <= _SPLIT), keys), _name("counts"), keys, BUCKETS, fresh_dir(spark, "catalog"))
    delta = count_by(log.where(F.col("date") > _SPLIT), keys)
    new = bucketed.upsert_add_bucketed(stored, delta, keys, ["click_count"])
    return bucketed.write_bucketed(new, _name("counts"), keys, BUCKETS, fresh_dir(spark, "catalog"))


@register("upsert_replace_bucketed", ORACLES["upsert_replace"])
def q_upsert_replace_bucketed(spark, sf_dir):
    """K7: stored per-(province, city, ad) counts in a bucketed table, overwritten by a newer batch's."""
    keys = ["province", "city", "adid"]
    log = parsed_log(spark, sf_dir)
    stored = bucketed.write_bucketed(count_by(log.where(F.col("date") <= "2024-01-20"), keys), _name("stat"), keys, BUCKETS, fresh_dir(spark, "catalog"))
    return bucketed.upsert_replace_bucketed(stored, count_by(log.where(F.col("date") >= "2024-01-11"), keys), keys)


@register("lookup_bucketed", ORACLES["stored_count_lookup"])
def q_lookup_bucketed(spark, sf_dir):
    """A batch's keys looked up in a bucketed table of stored counts."""
    log = parsed_log(spark, sf_dir)
    counts = ads.user_click_counts(log.where(F.col("date") <= "2024-01-20"))
    stored = bucketed.write_bucketed(counts, _name("user_counts"), ads.USER_KEYS, BUCKETS, fresh_dir(spark, "catalog"))
    batch = log.where(F.col("date") >= "2024-01-15").select(*ads.USER_KEYS).distinct()
    return bucketed.lookup_bucketed(batch, stored, ads.USER_KEYS, "click_count")


@register("replace_groups_partitioned", ORACLES["replace_groups"])
def q_replace_groups_partitioned(spark, sf_dir):
    """K8: a top-3 table partitioned by date; a batch of later days replaces its (date, province) groups and rewrites its dates only."""
    from shopflow.catalog.ads import _RG_THRESHOLD

    log, path = parsed_log(spark, sf_dir), fresh_dir(spark, "top3")

    def top3(rows):
        return ads.province_top3(count_by(rows, ads.PROVINCE_KEYS))

    stored = top3(log)
    stored.write.partitionBy("date").parquet(path)
    black = ads.users_over_threshold(ads.user_click_counts(log), _RG_THRESHOLD)
    batch = top3(ads.without_blacklisted(log.where(F.col("date") >= "2024-01-15"), black))
    partitioned.replace_groups_partitioned(path, batch, ["date", "province"], fresh_dir(spark, "staging"))
    return spark.read.schema(stored.schema).parquet(path).select(*stored.columns)


@register("session_counts_observed", ORACLES["session_buckets"])
def q_session_counts_observed(spark, sf_dir):
    """A2/U4: one pass writes the filtered sessions and yields the 15 counters beside them."""
    kept = sess.filtered_session_lengths(views.user_visit_action(spark, sf_dir, P.start_date, P.end_date), views.user_info(spark, sf_dir), P)
    counts = sess.write_counted_sessions(kept, fresh_dir(spark, "sessions"))
    return spark.createDataFrame(counts, "kind string, bucket string, sessions long, total long")


def _action_table(spark, sf_dir):
    """The actions as a catalog table partitioned by date."""
    name = _name("user_visit_action")
    replace_table(views.user_visit_action(spark, sf_dir), name, fresh_dir(spark, "catalog"), ["date"])
    return spark.table(name)


@register("scan_date_partitioned", ORACLES["scan_date_range"])
def q_scan_date_partitioned(spark, sf_dir):
    """Actions of an inclusive date range from a table partitioned by date; other dates' files are not opened."""
    return date_range(_action_table(spark, sf_dir), S1_START, S1_END)


@register("scan_dates_dynamic", with_views("user_visit_action") +
          "select city_id, click_product_id, a.date from user_visit_action a where click_product_id <> -1 and a.date in "
          "(select date from user_visit_action group by 1 having count(*) filter (where click_product_id <> -1) > "
          "count(*) filter (where search_keyword is not null))")
def q_scan_dates_dynamic(spark, sf_dir):
    """Clicks of the days with more clicks than views; which partitions to open is found while the query runs."""
    table = _action_table(spark, sf_dir)
    days = table.groupBy("date").agg(F.count_if(F.col("click_product_id") != -1).alias("clicks"),
                                     F.count_if(F.col("search_keyword").isNotNull()).alias("views")).where("clicks > views")
    clicks = table.where(F.col("click_product_id") != -1).select("city_id", "click_product_id", "date")
    return partitioned.rows_of_dates(clicks, days)
