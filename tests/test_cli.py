"""The command-line jobs on materialised input tables."""

import json
import os
import time

from shopflow import cli
from shopflow.params import DEFAULT_PARAMS
from shopflow.plans import sessions
from shopflow.sources import views
from tests.conftest import SF_SMALL


def test_cli_jobs_and_scan_pushdown(spark, tmp_dir):
    d = tmp_dir
    views.user_visit_action(spark, SF_SMALL).write.parquet(f"{d}/uva")
    views.user_info(spark, SF_SMALL).write.parquet(f"{d}/ui")
    views.product_info(spark, SF_SMALL).write.parquet(f"{d}/pi")
    with open(f"{d}/p.json", "w") as f:
        json.dump({"startDate": "2024-01-01", "endDate": "2024-01-31", "startAge": 20, "endAge": 50,
                   "professionals": "", "targetPageFlow": "1,2,3"}, f)
    with open(os.path.join(d, "hello.txt"), "w") as f:
        f.write("to be or\nnot to be\n")
    cli.main(["session-ratio", "--actions", f"{d}/uva", "--users", f"{d}/ui", "--params", f"{d}/p.json",
              "--out", f"{d}/o1"])
    cli.main(["page-convert", "--actions", f"{d}/uva", "--params", f"{d}/p.json", "--out", f"{d}/o2"])
    cli.main(["area-top3", "--actions", f"{d}/uva", "--products", f"{d}/pi", "--params", f"{d}/p.json",
              "--out", f"{d}/o3", "--task-id", "t-1"])
    cli.main(["word-count", "--input", f"{d}/hello.txt", "--out", f"{d}/o4"])
    assert spark.read.parquet(f"{d}/o1").count() == 15
    conv = spark.read.parquet(f"{d}/o2").collect()
    assert len(conv) == 1 and conv[0].convert_rate.startswith("1_2=") and "|2_3=" in conv[0].convert_rate
    o3 = spark.read.parquet(f"{d}/o3")
    assert o3.columns[0] == "taskid" and o3.count() > 0 and {r.taskid for r in o3.collect()} == {"t-1"}
    got = {r.word: int(r["count"]) for r in spark.read.option("header", True).csv(f"{d}/o4").collect()}
    assert got == {"to": 2, "be": 2, "or": 1, "not": 1}

    # on a stored action table the date range and column pruning reach the parquet scan
    plan = sessions.session_ratio_job(spark.read.parquet(f"{d}/uva"), spark.read.parquet(f"{d}/ui"),
                                      DEFAULT_PARAMS)._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line and "uva" in line][0]
    assert f"GreaterThanOrEqual(date,{DEFAULT_PARAMS.start_date})" in scan
    assert f"LessThanOrEqual(date,{DEFAULT_PARAMS.end_date})" in scan
    assert "ReadSchema: struct<date:string,user_id:bigint,session_id:string,action_time:string>" in scan


def test_cli_stream_jobs_catch_up(spark, tmp_dir):
    from shopflow.sources.store import ResultTable
    from shopflow.streaming import ads as sa
    from shopflow.streaming import words as sw

    logs, texts = os.path.join(tmp_dir, "logs"), os.path.join(tmp_dir, "texts")
    os.makedirs(logs)
    os.makedirs(texts)
    day = 1704412800000
    with open(os.path.join(logs, "a.txt"), "w") as f:
        f.write("\n".join(f"{day + i} 1 1 {1 if i < 3 else 2} 5" for i in range(5)) + "\n")
    with open(os.path.join(texts, "a.txt"), "w") as f:
        f.write("a b a\n\nc\n")
    cli.main(["ad-stream", "--source", logs, "--tables", f"{tmp_dir}/ads", "--threshold", "2", "--available-now"])
    tabs = sa.AdTables(spark, f"{tmp_dir}/ads/tables")
    assert [r.userid for r in tabs.read_blacklist().collect()] == [1]
    assert tabs.read_ad_stat().collect()[0].click_count == 5
    cli.main(["sliding-hour", "--tables", f"{tmp_dir}/ads", "--out", f"{tmp_dir}/hour"])
    hour = spark.read.parquet(f"{tmp_dir}/hour").collect()
    assert len(hour) == 60 and {r.click_count for r in hour} == {5}
    cli.main(["stream-word-count", "--source", texts, "--tables", f"{tmp_dir}/wc", "--available-now"])
    wc = sw.read_word_count(ResultTable(spark, f"{tmp_dir}/wc/word_count", sw.WORD_COUNT_SCHEMA))
    assert {r.word: r["count"] for r in wc.collect()} == {"a": 2, "b": 1, "c": 1}


def test_cli_top1(spark, tmp_dir):
    # The seven literal rows of the reference's row-number demo.
    rows = ["1,hadoop,12", "5,spark,16", "8,storm,18", "8,flume,20", "8,hive,10", "8,sparkstream,26",
            "10,tensorflow,26"]
    with open(os.path.join(tmp_dir, "tech.txt"), "w") as f:
        f.write("\n".join(rows) + "\n")
    cli.main(["top1", "--input", os.path.join(tmp_dir, "tech.txt"), "--out", f"{tmp_dir}/top1"])
    got = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_dir}/top1").collect())
    assert got == [("1", "hadoop", 12), ("10", "tensorflow", 26), ("5", "spark", 16), ("8", "sparkstream", 26)]


def test_cli_state_jobs_catch_up_and_go_on(spark, tmp_dir):
    logs, day = os.path.join(tmp_dir, "logs"), 1704412800000
    os.makedirs(logs)

    def add(name, clicks):
        with open(os.path.join(logs, name), "w") as f:
            f.write("\n".join(f"{day + 60_000 * m} 1 1 {u} {a}" for m, u, a in clicks) + "\n")

    def said(kind):
        cli.main(["ad-state", "--kind", kind, "--source", logs, "--tables", f"{tmp_dir}/t", "--available-now"])
        cli.main(["read-state", "--kind", kind, "--tables", f"{tmp_dir}/t", "--out", f"{tmp_dir}/out-{kind}"])
        return spark.read.parquet(f"{tmp_dir}/out-{kind}").collect()

    add("a.txt", [(0, 1, 5), (0, 2, 5), (1, 1, 6)])
    assert sorted((r.adid, r.click_count) for r in said("stat")) == [(5, 2), (6, 1)]
    assert [r.adid for r in sorted(said("top3"), key=lambda r: -r.click_count)] == [5, 6]
    assert sorted((r.window_start, r.click_count) for r in said("sliding") if r.adid == 6)[-1] == ("2024-01-05 00:01:00", 1)
    time.sleep(1.1)
    add("b.txt", [(0, 1, 6), (0, 1, 6), (0, 3, 6)])
    assert sorted((r.adid, r.click_count) for r in said("stat")) == [(5, 2), (6, 4)]
    assert [r.adid for r in sorted(said("top3"), key=lambda r: -r.click_count)] == [6, 5]
    assert {r.click_count for r in said("sliding") if r.adid == 6} == {1, 3, 4}
    assert {(r.minute, r.adid): r.click_count for r in said("trend")} == {("00", 5): 2, ("01", 6): 1, ("00", 6): 3}
    assert {r.word: r["count"] for r in said("words")}["6"] == 4
