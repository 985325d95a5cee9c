"""Times of many small micro-batches, to see whether a batch's cost follows the stream's history.

Usage: python tools/stream_times.py live|state [batches].  ``live`` runs the live ad job,
``state`` the running city counts; each batch holds 200 clicks on one of 30 days.  Prints the median
seconds of blocks of batches and the number of folders of the largest table.
"""

from __future__ import annotations

import os
import random
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shopflow.config import build_session  # noqa: E402
from shopflow.sources.store import ResultTable  # noqa: E402
from shopflow.streaming import ads as sa  # noqa: E402
from shopflow.streaming import state  # noqa: E402
from shopflow.streaming.sources import ad_log_stream  # noqa: E402

DAY = 1_704_412_800_000


def batch_lines(r: random.Random) -> list[str]:
    return [f"{DAY + r.randrange(30) * 86_400_000 + r.randrange(86_400_000)} {r.randrange(9)} {r.randrange(30)} {r.randrange(5000)} {r.randrange(100)}"
            for _ in range(200)]


def main() -> None:
    kind, n = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 200
    spark, root, r = build_session("local[8]", shuffle_partitions=4), tempfile.mkdtemp(prefix="stream-times-"), random.Random(1)
    spark.sparkContext.setLogLevel("ERROR")
    times: list[float] = []
    if kind == "live":
        tables = sa.AdTables(spark, root)
        job, table = sa.AdStreamJob(tables), tables.ad_stat
        for b in range(n):
            rows = spark.createDataFrame([(x,) for x in batch_lines(r)], "value string")
            began = time.time()
            job.process_batch(rows, b)
            times.append(time.time() - began)
    else:
        table = ResultTable(spark, f"{root}/stat", sa.AD_STAT_SCHEMA, ["date"], state.latest_by(["date", "province", "city", "adid"]))
        os.makedirs(f"{root}/in")
        for b in range(n):
            with open(f"{root}/in/{b:06d}.txt", "w") as f:
                f.write("\n".join(batch_lines(r)) + "\n")
            os.utime(f"{root}/in/{b:06d}.txt", (time.time() - 10 * (n - b),) * 2)
        sink, ends = state.counts_sink(table), [time.time()]

        def timed(changed, batch_id):
            sink(changed, batch_id)
            ends.append(time.time())

        lines = ad_log_stream(spark, f"{root}/in", max_files_per_trigger=1)
        state.start_update(state.running_ad_stat(lines), timed, f"{root}/ckpt", {"availableNow": True}).awaitTermination()
        times = [b - a for a, b in zip(ends, ends[1:])]
    step = max(1, n // 10)
    for at in range(0, n, step):
        print(f"batches {at}-{min(n, at + step) - 1}: median {statistics.median(times[at:at + step]):.2f} s, longest {max(times[at:at + step]):.2f} s")
    print("batch folders:", len(table.batches()), "folded parts:", len(table.folds()))
    spark.stop()


if __name__ == "__main__":
    main()
