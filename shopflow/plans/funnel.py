"""Q2: page conversion along a target page flow.

Views of the start page, then for each step ``a -> b`` of the flow the number
of times a session went directly from ``a`` to ``b`` (consecutive actions in
time order), divided by the count of the previous step.

Plan: date-range scan -> one shuffle by (session, time slice), which gives the
consecutive pairs and the start-page views (skew-safe, see operators/pairs.py)
-> keep target pairs (a literal IN list) -> one global aggregate holding one
conditional count per step -> the chained ratios are column expressions on
that single row, unpivoted into one row per step.  Nothing is collected to
the driver and no window runs over the step rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.functions.dates import parse_time
from shopflow.functions.strings import flow_pairs
from shopflow.operators.aggregates import with_task_id
from shopflow.operators.filters import date_range
from shopflow.operators.pairs import sliced_rows, stitched_edges
from shopflow.params import TaskParams

# Width of a time slice of a session; it decides how far a hot session is split, not the result.
SLICE_SECONDS = 300


def _rows(actions: DataFrame, start: str, end: str, slice_seconds: int) -> DataFrame:
    """Actions in the date range, per session and time slice, each with the page that follows."""
    acts = date_range(actions, start, end).select(
        "session_id", parse_time("action_time").alias("ts"), "action_id", "page_id"
    )
    piece = F.floor(F.unix_timestamp("ts") / F.lit(slice_seconds))
    return sliced_rows(acts, "session_id", piece, ["ts", "action_id"], "page_id")


def page_pairs(actions: DataFrame, start: str, end: str, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """W4 + O1: (session_id, from_page, to_page) for consecutive actions,
    ordered by parsed action time, then action id."""
    rows = _rows(actions, start, end, slice_seconds)
    pairs = rows.where(F.col("next").isNotNull()).select("session_id", "value", "next").unionByName(
        stitched_edges(rows, "session_id"))
    return pairs.select("session_id", F.col("value").alias("from_page"), F.col("next").alias("to_page"))


def pair_key(from_col: str = "from_page", to_col: str = "to_page"):
    return F.concat_ws("_", F.col(from_col).cast("string"), F.col(to_col).cast("string"))


def target_pairs(pairs: DataFrame, flow: tuple[int, ...]) -> DataFrame:
    """F8: keep only pairs of the target flow; adds ``page_pair`` text."""
    targets = [p for _, p in flow_pairs(flow)]
    keyed = pairs.withColumn("page_pair", pair_key())
    return keyed.where(F.col("page_pair").isin(*targets))


def page_pair_counts(actions: DataFrame, params: TaskParams) -> DataFrame:
    """Occurrences per target page pair."""
    pairs = page_pairs(actions, params.start_date, params.end_date)
    return target_pairs(pairs, params.target_page_flow).groupBy("page_pair").agg(
        F.count(F.lit(1)).alias("pair_count"))


def start_page_count(actions: DataFrame, params: TaskParams) -> DataFrame:
    """Views of the first page of the flow in the date range (one row)."""
    start = params.target_page_flow[0]
    acts = date_range(actions, params.start_date, params.end_date)
    return acts.agg(F.count_if(F.col("page_id") == F.lit(start)).alias("start_page_count"))


def _step_counts(actions: DataFrame, params: TaskParams) -> tuple[DataFrame, list[tuple[int, str]]]:
    """One row: the start-page count ``c0`` and one count ``c<i+1>`` per step.

    Start-page views are counted on the same rows as the pairs, so the actions
    are read and shuffled once.
    """
    flow = params.target_page_flow
    steps = flow_pairs(flow)
    rows = _rows(actions, params.start_date, params.end_date, SLICE_SECONDS)
    inner = rows.select(pair_key("value", "next").alias("page_pair"), F.col("next").isNotNull().alias("is_pair"),
                        (F.col("value") == F.lit(flow[0])).alias("is_start"))
    edges = stitched_edges(rows, "session_id").select(
        pair_key("value", "next").alias("page_pair"), F.lit(True).alias("is_pair"), F.lit(False).alias("is_start"))
    aggs = [F.count_if("is_start").alias("c0")]
    aggs += [F.count_if(F.col("is_pair") & (F.col("page_pair") == F.lit(p))).alias(f"c{i + 1}") for i, p in steps]
    return inner.unionByName(edges).agg(*aggs), steps


def page_conversion(actions: DataFrame, params: TaskParams, task_id: str | None = None) -> DataFrame:
    """Per step: pair, its count, the previous count and the ratio.

    A step that never occurs counts 0 (ratio 0.0); a zero previous count
    gives a NULL ratio.
    """
    one, steps = _step_counts(actions, params)
    cells = [
        F.struct(
            F.lit(i + 1).alias("step"),
            F.lit(p).alias("page_pair"),
            F.col(f"c{i + 1}").alias("pair_count"),
            F.col(f"c{i}").alias("prev_count"),
            F.try_divide(F.col(f"c{i + 1}").cast("double"), F.col(f"c{i}").cast("double")).alias("convert_rate"),
        )
        for i, p in steps
    ]
    return with_task_id(one.select(F.inline(F.array(*cells))), task_id)


def page_conversion_string(actions: DataFrame, params: TaskParams, task_id: str | None = None) -> DataFrame:
    """The ratios as one text ``1_2=r|2_3=r|...`` in flow order."""
    one, steps = _step_counts(actions, params)
    parts = []
    for i, p in steps:
        r = F.try_divide(F.col(f"c{i + 1}").cast("double"), F.col(f"c{i}").cast("double"))
        parts.append(F.concat(F.lit(f"{p}="), F.coalesce(r.cast("string"), F.lit("NULL"))))
    return with_task_id(one.select(F.concat_ws("|", *parts).alias("convert_rate")), task_id)
