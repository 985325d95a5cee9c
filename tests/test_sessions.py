"""Session job: bucket edges, unset parameters, sentinels (hand-made cases)."""

from pyspark.sql import functions as F

from shopflow.params import TaskParams
from shopflow.plans import sessions as S

COLS = ("action_id long, date string, user_id long, session_id string, page_id long, action_time string, "
        "search_keyword string, click_category_id long, click_product_id long, order_category_ids string, "
        "order_product_ids string, pay_category_ids string, pay_product_ids string, city_id long")


def action(i, sess, user, t, kw=None, cat=-1, date="2024-01-05", page=1):
    return (i, date, user, sess, page, f"{date} {t}", kw, cat, -1, None, None, None, None, 0)


def users(spark):
    return spark.sql(
        "select * from values (1L, 'u1', 'n1', 30, 'BUILDING', 'city1', 'male'), "
        "(2L, 'u2', 'n2', 55, 'MACHINERY', 'city2', 'female') "
        "as t(user_id, username, name, age, professional, city, sex)")


def test_session_agg_unpadded_hours_and_lists(spark):
    rows = [
        action(1, "s1", 1, "9:59:58", kw="b"),
        action(2, "s1", 1, "10:00:03", kw="a", cat=11),
        action(3, "s1", 1, "10:00:01", kw="b", cat=1),
        action(4, "s1", 1, "10:00:02", kw="", cat=-1),
    ]
    df = spark.createDataFrame(rows, COLS)
    r = S.session_agg(df, "2024-01-01", "2024-01-31").collect()[0]
    assert r.step_length == 4
    assert r.visit_length == 5  # 9:59:58 -> 10:00:03
    assert r.search_keywords == ["a", "b"]  # distinct, no empty, no leading space
    assert r.click_category_ids == [1, 11]  # "1" is not taken as present in "11"


def test_bucket_edges(spark):
    edges = [0, 3, 4, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801]
    sess = spark.createDataFrame([(f"s{v}", v, 1) for v in edges], "session_id string, visit_length long, step_length long")
    got = {(r.kind, r.bucket): r.sessions for r in S.bucket_rows(sess).collect()}
    assert got[("visit_length", "1s_3s")] == 1      # 3
    assert got[("visit_length", "4s_6s")] == 1      # 4
    assert got[("visit_length", "10s_30s")] == 1    # 30
    assert got[("visit_length", "30s_60s")] == 2    # 31, 60
    assert got[("visit_length", "1m_3m")] == 2      # 61, 180
    assert got[("visit_length", "3m_10m")] == 2     # 181, 600
    assert got[("visit_length", "10m_30m")] == 2    # 601, 1800
    assert got[("visit_length", "30m")] == 1        # 1801
    assert sum(v for (k, _), v in got.items() if k == "visit_length") == 12  # 0 s in no bucket
    steps = spark.createDataFrame([(f"t{v}", 5, v) for v in (3, 4, 30, 31, 60, 61)],
                                  "session_id string, visit_length long, step_length long")
    got = {(r.kind, r.bucket): r.sessions for r in S.bucket_rows(steps).collect()}
    assert [got[("step_length", b)] for b in ("1_3", "4_6", "7_9", "10_30", "30_60", "60")] == [1, 1, 0, 1, 2, 1]


def test_ratio_rounding_and_empty_total(spark):
    sess = spark.createDataFrame([("a", 2, 1), ("b", 2, 1), ("c", 2, 1), ("d", 5, 1), ("e", 5, 1), ("f", 5, 1),
                                  ("g", 5, 1)], "session_id string, visit_length long, step_length long")
    got = {r.bucket: r.ratio for r in S.session_ratios(sess).collect()}
    assert got["1s_3s"] == 0.43 and got["4s_6s"] == 0.57 and got["1_3"] == 1.0
    empty = sess.where(F.lit(False))
    rows = S.session_ratios(empty).collect()
    assert len(rows) == 15 and all(r.ratio == 0.0 and r.session_count == 0 for r in rows)


def test_filters_unset_and_missing(spark):
    rows = [action(1, "s1", 1, "0:00:01", kw="kw1", cat=5), action(2, "s2", 2, "0:00:01"),
            action(3, "s3", 3, "0:00:01", kw="kw1")]  # user 3 is unknown: dropped by the inner join
    df = spark.createDataFrame(rows, COLS)
    base = dict(start_date="2024-01-01", end_date="2024-01-31")
    ids = lambda p: sorted(r.session_id for r in S.filtered_sessions(df, users(spark), p).collect())
    assert ids(TaskParams(**base)) == ["s1", "s2"]
    assert ids(TaskParams(**base, start_age=20)) == ["s1", "s2"]  # one bound only: no age filter
    assert ids(TaskParams(**base, start_age=20, end_age=50)) == ["s1"]
    assert ids(TaskParams(**base, category_ids=("5",))) == ["s1"]  # s2 has no category: fails
    assert ids(TaskParams(**base, keywords=("kw1", "kw9"))) == ["s1"]
    assert ids(TaskParams(**base, sex="female")) == ["s2"]
    assert ids(TaskParams(**base, professionals=("MACHINERY",), cities=("city2",))) == ["s2"]
    p = TaskParams.from_mapping({"startDate": "2024-01-01", "endDate": "2024-01-31", "startAge": "",
                                 "endAge": "", "professionals": "", "sex": "", "categoryIds": "5"})
    assert p.start_age is None and p.sex is None and p.category_ids == ("5",)
    assert ids(p) == ["s1"]


def test_flag_path_selects_same_sessions(spark):
    """Also sessions with several users, without a user, and users of NULL actions, at any broadcast threshold."""
    rows = []
    for s in range(40):
        for k in range(1 + s % 5):
            user = None if s % 11 == 0 or (s % 7 == 0 and k == 1) else 1 + (s + (k if s % 3 == 0 else 0)) % 2
            rows.append(action(s * 10 + k, f"s{s}", user, f"0:00:{10 + k:02d}",
                               kw=f"kw{(s + k) % 4}" if k % 2 else None, cat=(s * k) % 7 if k % 3 else -1))
    df = spark.createDataFrame(rows, COLS)
    base = dict(start_date="2024-01-01", end_date="2024-01-31")
    cases = [TaskParams(**base), TaskParams(**base, keywords=("kw1",)), TaskParams(**base, category_ids=("3", "5")),
             TaskParams(**base, keywords=("kw0", "kw2"), category_ids=("0",), sex="male"),
             TaskParams(**base, start_age=20, end_age=40, professionals=("BUILDING",))]
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    try:
        for threshold in ("-1", "10MB"):
            spark.conf.set(key, threshold)
            for p in cases:
                full = S.filtered_sessions(df, users(spark), p).select("session_id", "visit_length", "step_length")
                assert sorted(full.collect()) == sorted(S.filtered_session_lengths(df, users(spark), p).collect())
    finally:
        spark.conf.set(key, old)
