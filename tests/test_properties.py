"""Property tests: operators against plain-Python models on random inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopflow.operators.pairs import consecutive_pairs
from shopflow.operators.tables import insert_new, replace_groups, upsert_add, upsert_replace
from shopflow.operators.topk import top_n
from tests.test_funnel_area import brute_pairs

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

rows_st = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", "hot"]), st.integers(0, 5), st.integers(0, 10_000), st.integers(0, 3)),
    min_size=0, max_size=120, unique_by=lambda r: r[2])


@SETTINGS
@given(rows=rows_st, ranges=st.integers(1, 9))
def test_pairs_equal_brute_force(spark, rows, ranges):
    df = spark.createDataFrame(rows, "g string, t long, i long, v long")
    got = sorted((r.g, r.from_value, r.to_value) for r in consecutive_pairs(df, "g", F.floor(F.col("t") / ranges), ["t", "i"], "v").collect())
    assert got == brute_pairs(rows)


kv_st = st.dictionaries(st.tuples(st.sampled_from("xyz"), st.integers(0, 3)), st.integers(0, 50), max_size=10)


def _df(spark, d):
    return spark.createDataFrame([(g, k, v) for (g, k), v in d.items()], "g string, k long, v long")


def _as_dict(df):
    return {(r.g, r.k): r.v for r in df.collect()}


@SETTINGS
@given(stored=kv_st, delta=kv_st)
def test_table_ops_equal_model(spark, stored, delta):
    s, d = _df(spark, stored), _df(spark, delta)
    add = {k: stored.get(k, 0) + delta.get(k, 0) for k in set(stored) | set(delta)}
    assert _as_dict(upsert_add(s, d, ["g", "k"], ["v"])) == add
    assert _as_dict(upsert_replace(s, d, ["g", "k"])) == {**stored, **delta}
    groups = {g for g, _ in delta}
    assert _as_dict(replace_groups(s, d, ["g"])) == {**{k: v for k, v in stored.items() if k[0] not in groups}, **delta}
    assert sorted(tuple(r) for r in insert_new(s, d, ["g", "k"]).collect()) == sorted(
        [(g, k, v) for (g, k), v in stored.items()] + [(g, k, v) for (g, k), v in delta.items() if (g, k) not in stored])


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from("pq"), st.integers(0, 4), st.integers(0, 1000)), max_size=60,
                     unique_by=lambda r: r[2]), n=st.integers(1, 4))
def test_top_n_equal_model(spark, rows, n):
    df = spark.createDataFrame(rows, "g string, c long, id long")
    got = sorted(tuple(r) for r in top_n(df, ["g"], [F.desc("c"), F.asc("id")], n).collect())
    want = []
    for g in "pq":
        grp = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))
        want += grp[:n]
    assert got == sorted(want)
