"""Stream queries whose counts live in Spark's state store.

Like ``streams.py``: a replay of the test tables, run to the end, and what the result
table then says; the oracle is the batch SQL.  ``*_unordered`` replays so that most clicks
arrive late.
"""

from __future__ import annotations

from shopflow.catalog.registry import ORACLES, register
from shopflow.catalog.streams import AVAILABLE_NOW, _ad_lines, document_line_stream
from shopflow.config import fresh_dir
from shopflow.streaming.state import StateJob


def _after(spark, kind, lines):
    job = StateJob(spark, kind, fresh_dir(spark, "state-job"))
    job.start(lines, AVAILABLE_NOW).awaitTermination()
    return job.read()


@register("stream_state_ad_stat", ORACLES["stream_ad_stat"])
def q_stream_state_ad_stat(spark, sf_dir):
    """Running clicks per date, province, city, ad, kept in the state store."""
    return _after(spark, "stat", _ad_lines(spark, sf_dir))


@register("stream_state_ad_stat_unordered", ORACLES["stream_ad_stat"])
def q_stream_state_ad_stat_unordered(spark, sf_dir):
    """T3 in the state store with clicks that arrive in any order."""
    return _after(spark, "stat", _ad_lines(spark, sf_dir, ordered=False))


@register("stream_state_ad_trend", ORACLES["ad_minute_trend"])
def q_stream_state_ad_trend(spark, sf_dir):
    """T5: running clicks per minute and ad, kept in the state store."""
    return _after(spark, "trend", _ad_lines(spark, sf_dir, ordered=False))


@register("stream_state_word_count", ORACLES["stream_word_count"])
def q_stream_state_word_count(spark, sf_dir):
    """Running word counts, kept in the state store."""
    return _after(spark, "words", document_line_stream(spark, sf_dir))


@register("stream_state_top3", ORACLES["province_top3_ads"])
def q_stream_state_top3(spark, sf_dir):
    """The top-3 per date and province from changed counts and the ranking before."""
    return _after(spark, "top3", _ad_lines(spark, sf_dir))


@register("stream_state_top3_unordered", ORACLES["province_top3_ads"])
def q_stream_state_top3_unordered(spark, sf_dir):
    """T7 from changed counts with clicks that arrive in any order."""
    return _after(spark, "top3", _ad_lines(spark, sf_dir, ordered=False))


@register("stream_state_sliding", ORACLES["sliding_hour_clicks"])
def q_stream_state_sliding(spark, sf_dir):
    """T4: 60-minute windows sliding by a minute, from a ring of minutes per ad in the state store."""
    return _after(spark, "sliding", _ad_lines(spark, sf_dir))


@register("stream_state_sliding_unordered", ORACLES["sliding_hour_clicks"])
def q_stream_state_sliding_unordered(spark, sf_dir):
    """T4 in the state store with clicks that arrive in any order."""
    return _after(spark, "sliding", _ad_lines(spark, sf_dir, ordered=False))
