"""Page conversion, consecutive pairs under skew, area top-3 ties, distinct concat."""

import random

from pyspark.sql import functions as F

from shopflow.operators.aggregates import group_concat_distinct
from shopflow.operators.pairs import consecutive_pairs
from shopflow.params import TaskParams
from shopflow.plans import area, funnel
from shopflow.sources.tables import city_area
from tests.test_sessions import COLS, action


def brute_pairs(rows):
    by = {}
    for g, t, i, v in rows:
        by.setdefault(g, []).append((t, i, v))
    out = []
    for g, lst in by.items():
        lst.sort()
        out += [(g, a[2], b[2]) for a, b in zip(lst, lst[1:])]
    return sorted(out)


def test_consecutive_pairs_hot_group_matches_brute_force(spark):
    rnd = random.Random(7)
    rows = [("hot", rnd.randint(0, 50), i, rnd.randint(0, 9)) for i in range(3000)]
    rows += [(f"g{rnd.randint(0, 40)}", rnd.randint(0, 50), 10_000 + i, rnd.randint(0, 9)) for i in range(1500)]
    df = spark.createDataFrame(rows, "g string, t long, i long, v long")
    for width in (1, 4, 1000):  # the slices' width never changes the result
        got = consecutive_pairs(df, "g", F.floor(F.col("t") / width), ["t", "i"], "v")
        assert sorted((r.g, r.from_value, r.to_value) for r in got.collect()) == brute_pairs(rows)
    # the hot group really is spread over tasks
    spread = df.repartition(16, "g", F.floor(F.col("t") / 4)).withColumn("r", F.spark_partition_id())
    assert spread.where("g = 'hot'").select("r").distinct().count() > 3


def test_single_action_session_has_no_pair(spark):
    df = spark.createDataFrame([("a", 1, 1, 5)], "g string, t long, i long, v long")
    assert consecutive_pairs(df, "g", F.col("t"), ["t", "i"], "v").count() == 0


def test_conversion_missing_step_and_zero_denominator(spark):
    # flow 1,2,3,4: 1->2 twice, 2->3 never, 3->4 once
    rows = [action(1, "s1", 1, "0:00:01", page=1), action(2, "s1", 1, "0:00:02", page=2),
            action(3, "s2", 1, "0:00:01", page=1), action(4, "s2", 1, "0:00:05", page=2),
            action(5, "s2", 1, "0:00:09", page=3), action(6, "s2", 1, "0:00:03", page=4),
            action(7, "s3", 1, "0:00:01", page=3), action(8, "s3", 1, "0:00:02", page=4)]
    df = spark.createDataFrame(rows, COLS)
    p = TaskParams("2024-01-01", "2024-01-31", target_page_flow=(1, 2, 3, 4))
    got = {r.page_pair: (r.pair_count, r.prev_count, r.convert_rate) for r in funnel.page_conversion(df, p).collect()}
    # s2 in time order: 1,4,2,3 -> pairs 1_4, 4_2, 2_3
    assert got["1_2"] == (1, 2, 0.5)
    assert got["2_3"] == (1, 1, 1.0)
    assert got["3_4"] == (1, 1, 1.0)
    p2 = TaskParams("2024-01-01", "2024-01-31", target_page_flow=(1, 9, 2))
    got2 = [(r.page_pair, r.pair_count, r.convert_rate) for r in funnel.page_conversion(df, p2).orderBy("step").collect()]
    assert got2 == [("1_9", 0, 0.0), ("9_2", 0, None)]
    text = funnel.page_conversion_string(df, p2).collect()[0].convert_rate
    assert text == "1_9=0.0|9_2=NULL"


def test_area_top3_ties_and_city_list(spark):
    # area of city 1 and 2 is the same; products 7, 8, 9, 5 each clicked twice -> ties broken by pid
    rows = []
    i = 0
    for pid in (9, 8, 7, 5):
        for city in (1, 2):
            i += 1
            rows.append((i, "2024-01-05", 1, "s", 1, "2024-01-05 0:00:01", None, 1, pid, None, None, None, None, city))
    rows.append((99, "2024-01-05", 1, "s", 1, "2024-01-05 0:00:01", None, -1, -1, None, None, None, None, 1))
    df = spark.createDataFrame(rows, COLS)
    prods = spark.createDataFrame([(p, f"p{p}", '{"product_status": %d}' % (p % 2)) for p in (5, 7, 8, 9)],
                                  "product_id long, product_name string, extend_info string")
    got = area.area_top3(df, prods, city_area(spark), "2024-01-01", "2024-01-31").collect()
    assert sorted(r.product_id for r in got) == [5, 7, 8]
    r = [x for x in got if x.product_id == 8][0]
    assert r.city_infos == "1;上海,2;南京" and r.click_count == 2 and r.area_level == "A_Level"
    assert r.product_status == "self" and [x for x in got if x.product_id == 5][0].product_status == "Third Party"


def test_group_concat_distinct_substring_trap(spark):
    df = spark.createDataFrame([("g", "1;x"), ("g", "11;x"), ("g", "1;x"), ("g", None)], "k string, v string")
    assert df.groupBy("k").agg(group_concat_distinct("v").alias("c")).collect()[0].c == "11;x,1;x"  # both kept; binary order


def test_pairs_with_null_times_and_coalesced_partitions(spark):
    """NULL times sort first, in a slice of their own; AQE may merge shuffle partitions."""
    rnd = random.Random(11)
    rows = [("hot", rnd.choice([None, *range(80)]), i, rnd.randint(0, 9)) for i in range(2500)]
    rows += [(f"g{rnd.randint(0, 60)}", rnd.choice([None, *range(80)]), 20_000 + i, rnd.randint(0, 9)) for i in range(2500)]
    df = spark.createDataFrame(rows, "g string, t long, i long, v long")
    conf = {"spark.sql.shuffle.partitions": "50",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = consecutive_pairs(df, "g", F.floor(F.col("t") / 10), ["t", "i"], "v")
        want = brute_pairs([(g, -1 if t is None else t, i, v) for g, t, i, v in rows])
        assert sorted((r.g, r.from_value, r.to_value) for r in got.collect()) == want
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_pairs_single_session_holding_all_rows(spark):
    """Every action of the sf0.01 view in one session: the pairs still come
    out exact, from several ranges instead of one task."""
    from shopflow.functions.dates import parse_time
    from shopflow.sources.views import user_visit_action

    acts = user_visit_action(spark, "/root/testdata/sf0.01").select(
        F.lit("all").alias("session_id"), parse_time("action_time").alias("ts"), "action_id", "page_id")
    piece = F.floor(F.unix_timestamp("ts") / funnel.SLICE_SECONDS)
    got = consecutive_pairs(acts, "session_id", piece, ["ts", "action_id"], "page_id")
    rows = sorted((r.ts, r.action_id, r.page_id) for r in acts.collect())
    want = sorted(zip([r[2] for r in rows[:-1]], [r[2] for r in rows[1:]]))
    assert sorted((r.from_value, r.to_value) for r in got.collect()) == want
    assert acts.select(piece).distinct().count() > 8


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_conversion_reads_and_shuffles_the_actions_once(spark, tmp_dir):
    from shopflow.sources.views import user_visit_action

    user_visit_action(spark, "/root/testdata/sf0.001").write.parquet(f"{tmp_dir}/uva")
    p = TaskParams("2024-01-01", "2024-01-31", target_page_flow=(1, 2, 3))
    plan = _final_plan(funnel.page_conversion(spark.read.parquet(f"{tmp_dir}/uva"), p))
    scans = [x for x in plan.splitlines() if "FileScan" in x]
    full = [x for x in plan.splitlines() if "Exchange hashpartitioning(session_id" in x and "__slice" in x and "Reused" not in x]
    assert len(scans) == 1 and len(full) == 1 and "ReusedExchange" in plan and "SPARK_PARTITION_ID" not in plan


def test_area_counts_before_the_city_join(spark):
    from shopflow.catalog import QUERIES

    plan = _final_plan(QUERIES["area_click_count"](spark, "/root/testdata/sf0.001"))
    below = plan[plan.index("Join"):]
    assert "HashAggregate(keys=[city_id" in below and "ts,2024" in plan.replace(" ", "")
