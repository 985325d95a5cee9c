"""Join helpers and size checks."""

from pyspark.sql import functions as F

from shopflow.operators.joins import broadcast_if_small, estimated_bytes, exclude_keys, fits_broadcast, lookup_with_default
from tests.conftest import SF_SMALL


def _broadcasts(df):
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange")


def test_size_checks(spark):
    parquet = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    assert estimated_bytes(parquet) is not None and fits_broadcast(parquet)
    assert not fits_broadcast(parquet, max_bytes=1)
    # an RDD-backed frame has no real estimate: never treated as small
    rdd_backed = spark.createDataFrame([(1,)], "k long")
    assert not fits_broadcast(rdd_backed)
    assert broadcast_if_small(rdd_backed) is rdd_backed


def test_exclude_and_lookup(spark):
    big = spark.range(0, 1000).select(F.col("id").alias("userid"), (F.col("id") % 7).alias("v"))
    black = spark.sql("select * from values (3L), (5L), (5L), (2000L) as t(userid)")
    kept = exclude_keys(big, black, ["userid"])
    assert kept.count() == 998 and kept.where("userid in (3, 5)").count() == 0
    assert _broadcasts(kept) == 1  # the small, size-checked blacklist is broadcast
    stored = spark.sql("select * from values (1L, 10L), (2L, 20L) as t(userid, n)")
    batch = spark.sql("select * from values (1L), (3L) as t(userid)")
    got = sorted(tuple(r) for r in lookup_with_default(batch, stored, ["userid"], "n").collect())
    assert got == [(1, 10), (3, 0)]


def test_hot_key_anti_join_is_split_by_aqe(spark):
    """One user holds a third of the log and the blacklist is not broadcast:
    AQE splits the hot partition of the sort-merge anti join."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        log = spark.range(0, 30000).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500).alias("userid"), "id")
        black = spark.range(100, 110).select(F.col("id").alias("userid"))
        out = exclude_keys(log, black, ["userid"], max_broadcast=0)
        assert len(out.collect()) == 30000 - 400
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_top_n_limits_before_the_shuffle(spark):
    from shopflow.operators.topk import top_n
    df = spark.range(0, 10000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    out = top_n(df, ["g"], [F.desc("v")], 3)
    assert sorted(tuple(r) for r in out.collect()) == sorted(
        (g, v) for g in range(3) for v in sorted((x for x in range(10000) if x % 3 == g), reverse=True)[:3])
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    # a partial WindowGroupLimit under the exchange and a final one above it
    assert final.count("WindowGroupLimit") == 2
    assert final.index("WindowGroupLimit") < final.index("Exchange")
