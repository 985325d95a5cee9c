"""Counts in the state store, sliding windows by rings, top-3 from changed counts, and online compaction."""

import glob
import os
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shopflow.plans import ads
from shopflow.sources.store import ResultTable, latest, latest_groups, summed
from shopflow.streaming import ads as sa
from shopflow.streaming import state
from shopflow.streaming.compaction import Compaction
from shopflow.streaming.sources import ad_log_stream
from tests.test_ads_streams import DAY, _write, clicks, lines

NOW = {"availableNow": True}


def test_state_is_shared_by_no_more_tasks_than_the_cores_can_use(spark, tmp_dir):
    """Each task has a store of its own to open and commit in every micro-batch, whatever the rows."""
    _write(tmp_dir + "/in", "a.txt", [f"{DAY} 1 1 {u} {u % 3}" for u in range(30)])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        job = state.StateJob(spark, "stat", tmp_dir + "/job")
        query = job.start(ad_log_stream(spark, tmp_dir + "/in"), NOW)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
        query.awaitTermination()
        stores = query.lastProgress["stateOperators"][0]["numStateStoreInstances"]
        assert stores == state.TASKS_PER_CORE * spark.sparkContext.defaultParallelism < 40
        assert {(x.adid, x.click_count) for x in job.read().collect()} == {(0, 10), (1, 10), (2, 10)}
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        assert state.state_tasks(spark) == 3
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


# ---- compaction ----

def counted(spark, root, merge=None):
    return ResultTable(spark, root, sa.AD_STAT_SCHEMA, ["date"], merge or (lambda rows: summed(rows, ads.STAT_KEYS)))


def stat_rows(spark, items):
    return spark.createDataFrame([(d, "1", "1", a, n) for d, a, n in items], sa.AD_STAT_SCHEMA)


@pytest.mark.parametrize("kind", ["sum", "latest", "groups"])
def test_compaction_changes_nothing_that_is_read(spark, tmp_dir, kind):
    merge = {"sum": lambda rows: summed(rows, ads.STAT_KEYS), "latest": lambda rows: latest(rows, ads.STAT_KEYS),
             "groups": lambda rows: latest_groups(rows, ["date"])}[kind]
    r = random.Random(kind)
    kept, plain = counted(spark, tmp_dir + "/a", merge), counted(spark, tmp_dir + "/b", merge)
    for batch in range(19):
        items = [(r.choice(["2024-01-01", "2024-01-02", None]), a, r.randint(1, 9)) for a in r.sample(range(4), r.randint(0, 3))]
        for t in (kept, plain):
            t.write(stat_rows(spark, items), batch)
        if batch % 2 == 0 and batch:
            kept.compact(batch - 1, every=2)
    assert sorted(map(repr, kept.read().collect())) == sorted(map(repr, plain.read().collect()))
    assert sorted(map(repr, kept.read(18).collect())) == sorted(map(repr, plain.read(18).collect()))
    assert kept.parts() == [(0, 15), (16, 17), (18, 18)] and plain.parts() == [(b, b) for b in range(19)]
    assert len(kept.batches()) <= 5  # two not folded, and those of the last call
    with pytest.raises(ValueError):
        kept.rows(9)
    one_date = {x.date for x in kept.rows(between=("2024-01-02", "2024-01-02")).collect()}
    assert one_date <= {"2024-01-02"}


def test_folders_stay_few(spark, tmp_dir):
    t = ResultTable(spark, tmp_dir + "/t", sa.BLACKLIST_SCHEMA, [], lambda rows: rows.select("userid").distinct())
    most = 0
    for batch in range(70):
        t.write(spark.range(batch, batch + 1).withColumnRenamed("id", "userid").coalesce(1), batch)
        if batch % 4 == 0 and batch:
            t.compact(batch - 1, every=4)
        most = max(most, len(glob.glob(f"{tmp_dir}/t/batch_id=*")) + len(glob.glob(f"{tmp_dir}/t/folded/*/batch_id=*")))
    assert t.read().count() == 70
    assert most <= 22  # grows with the logarithm of the number of batches: without removal it would be 92


def test_compaction_that_died(spark, tmp_dir):
    t = counted(spark, tmp_dir + "/t")
    for batch in range(4):
        t.write(stat_rows(spark, [("2024-01-01", 7, 1)]), batch)
    write = t._write

    def dies(df, path):
        write(df, path)
        os.unlink(path + "/_SUCCESS")  # as if the driver had died before the commit
        raise RuntimeError("driver lost")

    t._write = dies
    with pytest.raises(RuntimeError):
        t.compact(3, every=4)
    t._write = write
    assert t.folds() == [] and t.read().first().click_count == 4
    t.compact(3, every=4)
    assert t.parts() == [(0, 3)] and t.batches() == [0, 1, 2, 3]  # a reader of the old listing still finds its files
    t.compact(3, every=4)
    assert t.batches() == [] and t.read().first().click_count == 4


def test_background_compaction_reports_its_error(spark, tmp_dir):
    t = counted(spark, tmp_dir + "/t")
    c = Compaction(t, every=2)
    t.compact = lambda *a: 1 / 0
    c.after(2)
    with pytest.raises(ZeroDivisionError):
        c.after(4)


def test_live_job_with_and_without_compaction(spark, tmp_dir):
    r = random.Random(3)
    folded, plain = sa.AdTables(spark, tmp_dir + "/a"), sa.AdTables(spark, tmp_dir + "/b")
    jobs = [sa.AdStreamJob(folded, 2, every=2), sa.AdStreamJob(plain, 2, every=10**9)]
    for batch in range(7):
        items = [clicks(1, user=r.randint(1, 4), ad=r.randint(1, 3), t0=DAY + r.randint(0, 2) * 86_400_000 + r.randint(0, 10**6),
                        province=str(r.randint(1, 2)))[0] for _ in range(12)]
        for job in jobs:
            job.process_batch(lines(spark, items), batch)
            if batch == 3:  # a retry, after the fold of the batches before
                job.process_batch(lines(spark, items), batch)
    for c in jobs[0].compactions:
        c.wait()
    reads = ("read_user_counts", "read_blacklist", "read_ad_stat", "read_province_top3", "read_click_trend", "read_sliding_hour")
    for read in reads:
        assert sorted(getattr(folded, read)().collect()) == sorted(getattr(plain, read)().collect()), read
    assert all(t.folds() for t in folded.all()) and not any(t.folds() for t in plain.all())


# ---- running counts ----

def test_running_counts_restart_retry_and_late_clicks(spark, tmp_dir):
    src, ckpt = tmp_dir + "/in", tmp_dir + "/ckpt"
    table = ResultTable(spark, tmp_dir + "/stat", sa.AD_STAT_SCHEMA, ["date"], state.latest_by(ads.STAT_KEYS))
    sink = state.counts_sink(table)

    def run(sink=sink):
        state.start_update(state.running_ad_stat(ad_log_stream(spark, src)), sink, ckpt, NOW).awaitTermination()

    _write(src, "a.txt", clicks(3, ad=1) + clicks(2, ad=2))
    run()
    time.sleep(1.1)
    _write(src, "b.txt", clicks(4, ad=1, t0=DAY + 3_600_000))

    def dies(changed, batch_id):
        sink(changed, batch_id)
        raise RuntimeError("driver lost")  # after the write, before the commit

    with pytest.raises(Exception, match="driver lost"):
        run(dies)
    run()
    time.sleep(1.1)
    _write(src, "c.txt", clicks(5, ad=1, t0=DAY - 1) + clicks(1, ad=1, t0=DAY + 9))  # late
    run()
    got = {(x.date, x.adid): x.click_count for x in table.read().collect()}
    assert got == {("2024-01-05", 1): 12, ("2024-01-05", 2): 2, ("2024-01-04", 1): 1}
    # A batch writes what it changed, as totals, and no more: ad 2 stands in the first batch only.
    by_batch = {b: sorted((x.adid, x.click_count) for x in table.rows().where(F.col("batch_id") == b).collect()) for b in table.batches()}
    assert by_batch == {0: [(1, 3), (2, 2)], 1: [(1, 7)], 2: [(1, 1), (1, 12)]}
    assert glob.glob(f"{ckpt}/state/0/*/*.changelog")  # RocksDB with its changes in the checkpoint


def test_reranking_needs_changed_counts_only(spark):
    r = random.Random(5)
    totals, before = Counter(), spark.createDataFrame([], sa.PROVINCE_TOP3_SCHEMA)
    ranking = {}
    for _ in range(6):
        changed = {}
        for _ in range(r.randint(1, 8)):
            key = (r.choice(["d1", "d2"]), r.choice("xyz"), r.randint(1, 6))
            totals[key] += r.randint(1, 3)
            changed[key] = totals[key]
        rows = spark.createDataFrame([(*k, n) for k, n in changed.items()], sa.PROVINCE_TOP3_SCHEMA)
        got = [tuple(x) for x in state.reranked(before, rows).collect()]
        groups = {k[:2] for k in changed}
        assert {g[:2] for g in got} == groups  # the touched groups, whole
        for g in groups:
            ranking[g] = [x for x in got if x[:2] == g]
            want = sorted(((-n, k[2]) for k, n in totals.items() if k[:2] == g))[:3]
            assert sorted((-x[3], x[2]) for x in ranking[g]) == want
        before = spark.createDataFrame([x for rows in ranking.values() for x in rows], sa.PROVINCE_TOP3_SCHEMA)


def test_top3_batches_read_rankings_and_no_counts(spark, tmp_dir, monkeypatch):
    src = tmp_dir + "/in"
    top3 = ResultTable(spark, tmp_dir + "/top3", sa.PROVINCE_TOP3_SCHEMA, ["date"], lambda rows: latest_groups(rows, sa.GROUP_KEYS))
    plans, write = [], top3.write

    def noted(df, batch_id):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        write(df, batch_id)

    top3.write = noted
    all_lines = []
    for k in range(3):
        chunk = [c for ad in range(5) for c in clicks(1 + (ad * 7 + k * 3) % 5, ad=ad, t0=DAY + 86_400_000 * (k % 2))]
        _write(src, f"f{k}.txt", chunk)
        time.sleep(1.1)
        all_lines += chunk
    frame = state.running_province_counts(ad_log_stream(spark, src, max_files_per_trigger=1))
    state.start_update(frame, state.top3_state_sink(top3), tmp_dir + "/ckpt", NOW).awaitTermination()
    want = ads.province_top3(ads.province_ad_counts(ads.ad_stat(ads.parse_ad_log(lines(spark, all_lines)))))
    assert sorted(map(tuple, top3.read().collect())) == sorted(map(tuple, want.collect()))
    assert len(plans) == 3
    # What a batch scans of files is the ranking table alone, once.
    assert [p.count("] parquet") for p in plans] == [0, 1, 1]
    assert top3.rows().groupBy("batch_id", "date", "province").count().agg(F.max("count")).first()[0] <= 3


# ---- sliding windows ----

def brute_windows(minutes, width):
    out = Counter()
    for m, n in minutes.items():
        for s in range(m - width + 1, m + 1):
            out[s] += n
    return out


def open_windows(ring):
    out = Counter()
    if ring.last is not None:
        for m in range(ring.last - ring.width + 1, ring.last + 1):
            for s in range(ring.last - ring.width + 1, m + 1):
                out[s] += ring.counts[m % ring.width]
    return out


def test_ring_adds_up_in_any_order():
    r = random.Random(7)
    for _ in range(300):
        width = r.choice([1, 2, 5, 60])
        minutes, ring = Counter(), state.Ring(width)
        closed, expired, times = Counter(), Counter(), Counter()
        now = r.randint(-200, 200)
        for _ in range(r.randint(1, 60)):
            now += r.choice([0, 1, 1, 2, width, 3 * width])
            m, n = (now if r.random() < 0.7 else now - r.randint(0, 3 * width)), r.randint(1, 4)
            minutes[m] += n
            ring.add(m, n)
            if r.random() < 0.1:
                ring.expire()
            closed.update(ring.closed)
            expired.update(ring.expired)
            times.update(dict.fromkeys(ring.closed, 1))
            ring = state.Ring(width, ring.last, ring.counts if ring.last is not None else ())
        assert +(closed + open_windows(ring)) == brute_windows(minutes, width)
        kept = Counter() if ring.last is None else Counter({m: ring.counts[m % width] for m in range(ring.last - width + 1, ring.last + 1)})
        assert +(expired + kept) == minutes


def test_ring_puts_a_window_out_once_when_clicks_are_in_order():
    ring, out = state.Ring(60), Counter()
    for m in range(0, 500, 7):
        ring.closed.clear()
        ring.add(m, 1)
        out.update(dict.fromkeys(ring.closed, 1))
    assert set(out.values()) == {1}


def windows_of(tables):
    return sorted((x.adid, x.b, x.click_count) for x in tables.read_windows().collect())


def batch_windows(spark, items):
    log = ads.parse_ad_log(lines(spark, items))
    return sorted((x.adid, x.b, x.click_count) for x in ads.window_counts_from_buckets(ads.bucket_counts(log), 60).collect())


def test_sliding_stream_restart_retry_and_late_clicks(spark, tmp_dir):
    src, ckpt, r = tmp_dir + "/in", tmp_dir + "/ckpt", random.Random(8)
    tables = state.SlidingTables(spark, tmp_dir + "/t")
    sink, items = state.sliding_sink(tables), []
    for k in range(3):
        more = [f"{DAY + (k * 90 + r.randint(-200, 60)) * 60_000 + r.randint(0, 59_999)} 1 1 1 {r.randint(0, 3)}" for _ in range(60)]
        _write(src, f"f{k}.txt", more)
        items += more

        def dies(changes, batch_id):
            sink(changes, batch_id)
            raise RuntimeError("driver lost")

        def run(fn):
            state.start_update(state.sliding_changes(ad_log_stream(spark, src)), fn, ckpt, NOW).awaitTermination()

        if k == 1:
            with pytest.raises(Exception, match="driver lost"):
                run(dies)
        run(sink)
        assert windows_of(tables) == batch_windows(spark, items)
        time.sleep(1.1)
    minutes = sorted((x.adid, x.b, x.click_count) for x in tables.read_minutes().collect())
    want = ads.bucket_counts(ads.parse_ad_log(lines(spark, items)))
    assert minutes == sorted((x.adid, x.b, x.n) for x in want.collect())


def test_silent_ads_are_closed_by_a_timer_and_open_again(spark, tmp_dir):
    src = tmp_dir + "/in"
    tables = state.SlidingTables(spark, tmp_dir + "/t")
    items = clicks(3, ad=1) + clicks(2, ad=2, t0=DAY + 120_000)
    _write(src, "a.txt", items)
    q = state.start_update(state.sliding_changes(ad_log_stream(spark, src), silent_ms=1), state.sliding_sink(tables), tmp_dir + "/ckpt",
                           {"processingTime": "1 second"})

    def moved():  # by a timer, without any new click
        return tables.minutes.read().agg(F.sum("n")).first()[0] if tables.minutes.batches() else 0

    def wait_for(n):
        deadline = time.time() + 40
        while time.time() < deadline and moved() != n:
            time.sleep(1)
        assert moved() == n

    try:
        wait_for(5)
        assert windows_of(tables) == batch_windows(spark, items)
        more = clicks(4, ad=1, t0=DAY + 60_000)
        _write(src, "b.txt", more)
        wait_for(9)
    finally:
        q.stop()
    assert tables.rings.read().where(F.size("counts") > 0).count() == 0
    assert windows_of(tables) == batch_windows(spark, items + more)


def test_partial_counts_of_a_hot_ad():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"adid": [1] * 9000 + [2], "minute": [5] * 4000 + [6] * 5000 + [5], "n": [1] * 9001})
    got = [tuple(x.values()) for b in state._minutes_of(iter([batch])) for x in b.to_pylist()]
    assert sorted(got) == [(1, 5, 4000), (1, 6, 5000), (2, 5, 1)]
