"""Bitmaps, bucketed tables, date partitions and observed counts."""

import glob
import os
import random
import re
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from shopflow.operators import bitmaps, bucketed, tables
from shopflow.operators.joins import exclude_keys
from shopflow.sources import partitioned
from shopflow.sources.store import replace_table
from tests.conftest import ROOT


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# ---- bitmaps ----

EDGES = [0, 1, -1, 7, 8, 63, 64, 65, 32_767, 32_768, 32_769, 65_536, -32_767, -32_768, -32_769, 2**40, -2**40, 2**62 + 5, 2**63 - 1, -2**63 + 1]


def test_every_bit_of_a_bucket(spark):
    """Each id alone has its own bit, and no other id of its neighbourhood shares it."""
    ids = spark.range(-40_000, 70_000).withColumnRenamed("id", "userid")
    for step in (2, 3):
        some = ids.where(F.pmod("userid", F.lit(step)) == 1)
        got = {r.userid for r in bitmaps.exclude_ids(ids, some, "userid").collect()}
        assert got == {i for i in range(-40_000, 70_000) if i % step != 1}


def test_each_edge_id_alone(spark):
    log = spark.createDataFrame([(i,) for i in EDGES] + [(None,)], "userid long")
    sets = bitmaps.id_bitmaps(log, "userid").collect()
    assert sum(bin(w & (2**64 - 1)).count("1") for r in sets for w in r.words) == len(EDGES)
    for i in EDGES:
        black = spark.createDataFrame([(i,), (None,)], "userid long")
        got = [r.userid for r in bitmaps.exclude_ids(log, black, "userid").collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, [x for x in EDGES if x != i] + [None]))


def test_bitmap_filter_equals_the_anti_join(spark):
    r = random.Random(1)
    log = spark.createDataFrame([(r.choice([None, r.randint(-50, 50), r.randint(-10**12, 10**12)]), "x", i) for i in range(500)],
                                "userid long, words string, n int")
    black = log.where("n % 3 = 0").select("userid").unionByName(spark.createDataFrame([(None,)], "userid long"))
    want = sorted(map(repr, exclude_keys(log, black, ["userid"]).collect()))
    assert sorted(map(repr, bitmaps.exclude_ids(log, black, "userid").collect())) == want
    assert sorted(map(repr, bitmaps.exclude_ids(log, black, "userid", max_bytes=0).collect())) == want  # the way beyond the bound
    assert bitmaps.exclude_ids(log, black.limit(0), "userid").count() == 500
    assert bitmaps.exclude_ids(log.limit(0), black, "userid").collect() == []


def test_bitmap_filter_does_not_move_the_log(spark, no_broadcast, tmp_dir):
    spark.range(10_000).select(F.col("id").alias("userid"), F.lit("x").alias("v")).write.parquet(f"{tmp_dir}/log")
    log, black = spark.read.parquet(f"{tmp_dir}/log"), spark.range(0, 10_000, 2).withColumnRenamed("id", "userid")
    got = plan(bitmaps.exclude_ids(log, black, "userid"))
    assert re.sub("BroadcastExchange", "", got).count("Exchange") == 0 and "BroadcastHashJoin" in got
    assert "Exchange hashpartitioning" in plan(exclude_keys(log, black, ["userid"]))


# ---- bucketed tables ----

def bucket_tables(spark, tmp_dir, rows, name):
    df = spark.createDataFrame(rows, "a string, b long, v long")
    return bucketed.write_bucketed(df, f"{name}_{os.path.basename(tmp_dir).replace('-', '_')}", ["a", "b"], 4, f"{tmp_dir}/{name}")


def key_rows(r, n):
    keys = {(r.choice(["x", "y", "z", None]), r.choice([1, 2, 3, 4, 5, 6, None])) for _ in range(n)}
    return [(a, b, r.randint(1, 9)) for a, b in keys]


def test_bucketed_upserts_equal_the_plain_ones(spark, tmp_dir, no_broadcast):
    r = random.Random(2)
    for k in range(4):
        stored_rows, delta_rows = key_rows(r, 14), key_rows(r, 9)
        stored = bucket_tables(spark, tmp_dir, stored_rows, f"s{k}")
        delta = spark.createDataFrame(delta_rows, "a string, b long, v long")
        twice = delta.unionByName(delta)
        rows = lambda df: sorted(map(repr, map(tuple, df.select("a", "b", "v").collect())))
        plain = spark.createDataFrame(stored_rows, "a string, b long, v long")
        assert rows(bucketed.upsert_add_bucketed(stored, twice, ["a", "b"], ["v"])) == rows(tables.upsert_add(plain, twice, ["a", "b"], ["v"]))
        assert rows(bucketed.upsert_replace_bucketed(stored, delta, ["a", "b"])) == rows(tables.upsert_replace(plain, delta, ["a", "b"]))
        assert rows(bucketed.upsert_replace_bucketed(stored, delta.limit(0), ["a", "b"])) == rows(plain)


def test_the_stored_side_is_not_moved(spark, tmp_dir, no_broadcast):
    stored = bucket_tables(spark, tmp_dir, [("x", i, 1) for i in range(100)], "big")
    batch = spark.createDataFrame([("x", i, 5) for i in range(50, 150)], "a string, b long, v long")

    def above_scans(df):
        """The operators above each file scan."""
        found = []

        def walk(node, above):
            if "FileScan" in node.simpleString(200):
                found.append(above)
            for i in range(node.children().size()):
                walk(node.children().apply(i), [*above, node.nodeName()])

        p = df._jdf.queryExecution().executedPlan()
        walk(p.initialPlan() if "AdaptiveSparkPlan" in p.nodeName() else p, [])
        return found

    for df in (bucketed.lookup_bucketed(batch.select("a", "b"), stored, ["a", "b"], "v"),
               bucketed.upsert_add_bucketed(stored, batch, ["a", "b"], ["v"]), bucketed.upsert_replace_bucketed(stored, batch, ["a", "b"])):
        joined = [above for above in above_scans(df) if "SortMergeJoin" in above and "Union" not in above[above.index("SortMergeJoin"):]]
        whole = [above for above in joined if not any("Anti" in x for x in above)]
        assert whole and any("Exchange" not in above for above in whole)
    plain = spark.read.parquet(f"{tmp_dir}/big")  # the same files without their buckets
    assert all("Exchange" in above for above in above_scans(bucketed.lookup_bucketed(batch.select("a", "b"), plain, ["a", "b"], "v")))
    new = bucketed.write_bucketed(bucketed.upsert_add_bucketed(stored, batch, ["a", "b"], ["v"]), f"next_{os.path.basename(tmp_dir).replace('-', '_')}",
                                  ["a", "b"], 4, f"{tmp_dir}/next")
    assert new.count() == 150 and len(glob.glob(f"{tmp_dir}/next/part-*")) <= 4


# ---- date partitions ----

def top_rows(items):
    return [(d, p, a, n) for d, p, a, n in items]


TOP = "date string, province string, adid long, click_count long"


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/date=*/part-*")}


def test_only_touched_dates_are_rewritten(spark, tmp_dir):
    path = f"{tmp_dir}/top"
    stored = [(f"2024-01-0{d}", p, a, 10 * d + a) for d in range(1, 6) for p in ("x", "y") for a in range(3)] + [(None, "x", 1, 1)]
    spark.createDataFrame(stored, TOP).write.partitionBy("date").parquet(path)
    before = files(path)
    time.sleep(0.05)
    batch_rows = [("2024-01-02", "x", 9, 99), ("2024-01-07", "z", 1, 1), (None, "y", 2, 2)]
    batch = spark.createDataFrame(batch_rows, TOP)
    want = sorted(map(repr, [s for s in stored if s[:2] != ("2024-01-02", "x")] + batch_rows))
    read = lambda: sorted(repr(tuple(x)) for x in spark.read.schema(batch.schema).parquet(path).select(*batch.columns).collect())
    partitioned.replace_groups_partitioned(path, batch, ["date", "province"], f"{tmp_dir}/stage1")
    assert read() == want
    after = files(path)
    same = [f for f in before if "2024-01-02" not in f and "HIVE_DEFAULT" not in f]
    assert len(same) >= 4 and all(after[f] == before[f] for f in same)
    partitioned.replace_groups_partitioned(path, batch, ["date", "province"], f"{tmp_dir}/stage1")  # a repeat
    partitioned.replace_groups_partitioned(path, batch, ["date", "province"], f"{tmp_dir}/stage2")  # and as a new call
    assert read() == want
    partitioned.replace_groups_partitioned(path, batch.limit(0), ["date", "province"], f"{tmp_dir}/stage3")
    assert read() == want
    with pytest.raises(ValueError):
        partitioned.replace_groups_partitioned(path, batch, ["province"], f"{tmp_dir}/stage4")


def test_a_repeat_after_a_lost_overwrite(spark, tmp_dir):
    """The touched date is gone when the call is repeated: what was staged still has the untouched groups."""
    import shutil

    path = f"{tmp_dir}/top"
    spark.createDataFrame([("2024-01-01", "x", 1, 1), ("2024-01-01", "y", 1, 2)], TOP).write.partitionBy("date").parquet(path)
    batch = spark.createDataFrame([("2024-01-01", "x", 5, 7)], TOP)
    partitioned.replace_groups_partitioned(path, batch, ["date", "province"], f"{tmp_dir}/stage")
    shutil.rmtree(f"{path}/date=2024-01-01")
    partitioned.replace_groups_partitioned(path, batch, ["date", "province"], f"{tmp_dir}/stage")
    got = sorted(tuple(x) for x in spark.read.schema(batch.schema).parquet(path).select(*batch.columns).collect())
    assert got == [("2024-01-01", "x", 5, 7), ("2024-01-01", "y", 1, 2)]


def test_date_partitions_are_pruned(spark, tmp_dir):
    name = "actions_" + os.path.basename(tmp_dir).replace("-", "_")
    df = spark.range(1000).select("id", F.concat(F.lit("2024-01-0"), (F.col("id") % 9 + 1).cast("string")).alias("date"))
    replace_table(df, name, f"{tmp_dir}/t", ["date"])
    table = spark.table(name)
    one = table.where(F.col("date").between("2024-01-02", "2024-01-03"))
    assert re.search(r"PartitionFilters: \[[^\]]*date[^\]]*2024-01-02", plan(one))
    opened = one.select(F.input_file_name().alias("f")).distinct().collect()
    assert {re.search("date=([0-9-]+)", x.f)[1] for x in opened} == {"2024-01-02", "2024-01-03"}
    days = spark.createDataFrame([("2024-01-05",), ("2024-01-06",)], "date string").where("date > '2024-01-05'")
    got = partitioned.rows_of_dates(table, days)
    assert "dynamicpruning" in plan(got)
    assert {r.date for r in got.collect()} == {"2024-01-06"} and got.count() == 111
    replace_table(df.limit(0), name, f"{tmp_dir}/t2", ["date"])
    assert spark.table(name).count() == 0


# ---- observed counts ----

RETRIED = """
import sys
sys.path.insert(0, {root!r})
from pyspark import TaskContext
from pyspark.sql import functions as F
from shopflow.config import build_session
from shopflow.plans import sessions as sess
spark = build_session("local[2,4]", shuffle_partitions=3)
spark.sparkContext.setLogLevel("OFF")

def some_die(frames):
    for frame in frames:
        yield frame
    if TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() % 2 == 0:
        raise RuntimeError("lost")  # after its rows have been seen

rows = spark.range(0, 4000, 1, 4).select(F.col("id").cast("string").alias("session_id"), (F.col("id") % 2000).alias("visit_length"),
                                         (F.col("id") % 70).alias("step_length"))
rows = rows.mapInPandas(some_die, rows.schema)
got = sess.write_counted_sessions(rows, {out!r})
back = spark.read.parquet({out!r})
want = [(r.kind, r.bucket, r.sessions, r.total) for r in sess.bucket_rows(back).orderBy("pos").collect()]
assert back.count() == 4000 and got == want, (got, want)
print("SAME", got[0])
"""


def test_observed_counts_are_exact_when_tasks_are_retried(tmp_dir):
    script = RETRIED.format(root=ROOT, out=f"{tmp_dir}/sessions")
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=180)
    assert "SAME" in done.stdout, done.stderr[-2000:]


def test_observed_counts_of_no_sessions(spark, tmp_dir):
    from shopflow.plans import sessions as sess

    none = spark.createDataFrame([], "session_id string, visit_length long, step_length long")
    got = sess.write_counted_sessions(none, f"{tmp_dir}/none")
    assert len(got) == 15 and {x[2:] for x in got} == {(0, 0)}
