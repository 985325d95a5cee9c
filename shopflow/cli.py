"""Command-line entry: run a job the way the reference's ``main`` programs ran.

    python -m shopflow.cli session-ratio  --actions A --users U --params p.json --out O
    python -m shopflow.cli page-convert   --actions A --params p.json --out O
    python -m shopflow.cli area-top3      --actions A --products P --params p.json --out O
    python -m shopflow.cli word-count     --input TEXT --out O.csv
    python -m shopflow.cli top1           --input CSV_LINES --out O
    python -m shopflow.cli ad-stream      --source DIR | --kafka-servers H --topic T [--kafka-option K=V]
                                          --tables DIR
    python -m shopflow.cli sliding-hour   --tables DIR --out O   (60-minute windows of the ad stream's counts)
    python -m shopflow.cli stream-word-count --source DIR | --host H --port N  --tables DIR
    python -m shopflow.cli ad-state       --kind stat|trend|top3|sliding|words --source DIR | --kafka-servers H --topic T
                                          --tables DIR   (counts in the state store; words: lines of text)
    python -m shopflow.cli read-state     --kind K --tables DIR --out O   (what an ad-state job says, also while it runs)
    (stream jobs: --available-now processes what has arrived and stops)

Inputs are parquet paths or catalog table names (``table:<name>``); the
parameter file holds the reference's JSON task fields (startDate, endDate,
startAge, ..., targetPageFlow).  Results are written as parquet, or through
JDBC with ``--jdbc-url`` / ``--jdbc-table``.  Stream state, checkpoints and
result tables go below ``--tables`` (a shared folder on a cluster).
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession

from shopflow.config import build_session, ensure_utc
from shopflow.params import TaskParams
from shopflow.plans import area, funnel, sessions, words
from shopflow.sources.store import write_csv, write_jdbc
from shopflow.sources.tables import city_area


def _read(spark: SparkSession, src: str) -> DataFrame:
    return spark.table(src[len("table:"):]) if src.startswith("table:") else spark.read.parquet(src)


def _params(path: str) -> TaskParams:
    with open(path) as f:
        return TaskParams.from_mapping(json.load(f))


def _write(df: DataFrame, args) -> None:
    if args.jdbc_url:
        password = None
        if args.jdbc_password_file:
            with open(args.jdbc_password_file) as f:
                password = f.read().strip()
        write_jdbc(df, args.jdbc_url, args.jdbc_table, args.jdbc_user, password)
    else:
        df.write.mode("overwrite").parquet(args.out)


def _kafka(args) -> dict[str, str] | None:
    if not args.kafka_servers:
        return None
    return {"kafka.bootstrap.servers": args.kafka_servers, "subscribe": args.topic} | dict(opt.split("=", 1) for opt in args.kafka_option)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="shopflow")
    ap.add_argument("job", choices=["session-ratio", "page-convert", "area-top3", "word-count", "top1",
                                    "ad-stream", "sliding-hour", "stream-word-count", "ad-state", "read-state"])
    for opt in ("actions", "users", "products", "params", "input", "out", "source", "tables", "kafka-servers",
                "topic", "host", "jdbc-url", "jdbc-table", "jdbc-user", "jdbc-password-file", "master", "task-id"):
        ap.add_argument(f"--{opt}")
    ap.add_argument("--port", type=int)
    ap.add_argument("--kind", choices=["stat", "trend", "top3", "sliding", "words"], default="stat")
    ap.add_argument("--hive", action="store_true", help="use the Hive catalog for table:<name> inputs")
    ap.add_argument("--many-files", action="store_true", help="word-count: write the CSV with all tasks instead of as one file")
    ap.add_argument("--threshold", type=int, default=100)
    ap.add_argument("--kafka-option", action="append", default=[], metavar="KEY=VALUE",
                    help="extra Kafka source option, e.g. startingOffsets=earliest (repeatable)")
    ap.add_argument("--available-now", action="store_true",
                    help="stream jobs: process what has arrived, then stop (catch-up run)")
    args = ap.parse_args(argv)

    spark = build_session(args.master, app_name=f"shopflow-{args.job}", hive=args.hive)
    ensure_utc(spark)
    trigger = {"availableNow": True} if args.available_now else None

    if args.job == "session-ratio":
        _write(sessions.session_ratio_job(_read(spark, args.actions), _read(spark, args.users), _params(args.params),
                                          args.task_id), args)
    elif args.job == "page-convert":
        _write(funnel.page_conversion_string(_read(spark, args.actions), _params(args.params), args.task_id), args)
    elif args.job == "area-top3":
        p = _params(args.params)
        _write(area.area_top3(_read(spark, args.actions), _read(spark, args.products), city_area(spark),
                              p.start_date, p.end_date, task_id=args.task_id), args)
    elif args.job == "word-count":
        write_csv(words.word_count(words.text_file_lines(spark, args.input)), args.out, single_file=not args.many_files)
    elif args.job == "top1":
        rows = words.delimited_rows(spark.read.text(args.input), "id STRING, name STRING, age INT")
        _write(words.top1_per_key(rows), args)
    elif args.job == "ad-stream":
        from shopflow.streaming import ads as sa
        from shopflow.streaming.sources import ad_log_stream

        job = sa.AdStreamJob(sa.AdTables(spark, f"{args.tables}/tables"), args.threshold)
        job.start(ad_log_stream(spark, args.source, _kafka(args)), f"{args.tables}/checkpoint", trigger).awaitTermination()
    elif args.job in ("ad-state", "read-state"):
        from shopflow.streaming.sources import ad_log_stream
        from shopflow.streaming.state import StateJob

        job = StateJob(spark, args.kind, f"{args.tables}/{args.kind}")
        if args.job == "read-state":
            _write(job.read(), args)
        else:
            lines = ad_log_stream(spark, args.source, _kafka(args))
            job.start(lines.withColumnRenamed("value", "line") if args.kind == "words" else lines, trigger).awaitTermination()
    elif args.job == "sliding-hour":
        from shopflow.streaming import ads as sa

        _write(sa.AdTables(spark, f"{args.tables}/tables").read_sliding_hour(), args)
    elif args.job == "stream-word-count":
        from shopflow.sources.store import ResultTable
        from shopflow.streaming import words as sw
        from shopflow.streaming.sources import socket_text_stream, text_line_stream

        lines = (socket_text_stream(spark, args.host, args.port) if args.host
                 else text_line_stream(spark, args.source))
        table = ResultTable(spark, f"{args.tables}/word_count", sw.WORD_COUNT_SCHEMA)
        sw.start_word_count(lines, table, f"{args.tables}/checkpoint", trigger).awaitTermination()


if __name__ == "__main__":
    main()
