"""Summarise a Spark event log per job description (bench.py sets one per query).

Usage: python tools/stage_times.py <event log file or dir>
Prints, per description: jobs, stages, tasks, summed task time, shuffle
read/write bytes, spilled bytes.
"""

from __future__ import annotations

import collections
import io
import json
import os
import sys

import zstandard


def main() -> None:
    path = sys.argv[1]
    files = [path]
    if os.path.isdir(path):
        files = sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs
                       if f.startswith(("events_", "local-", "app-")) and not f.endswith(".crc"))
    stage_desc: dict[int, str] = {}
    agg = collections.defaultdict(lambda: collections.Counter())
    stage_name: dict[int, str] = {}
    stage_ms: collections.Counter = collections.Counter()
    for f in files:
        raw = open(f, "rb")
        fh = (io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
              if f.endswith(".zstd") else io.TextIOWrapper(raw, encoding="utf-8"))
        with fh:
            for line in fh:
                e = json.loads(line)
                ev = e.get("Event")
                if ev == "SparkListenerJobStart":
                    desc = " ".join((e.get("Properties") or {}).get("spark.job.description", "-").split())
                    agg[desc]["jobs"] += 1
                    for sid in e.get("Stage IDs", []):
                        stage_desc[sid] = desc
                elif ev == "SparkListenerStageCompleted":
                    info = e["Stage Info"]
                    desc = stage_desc.get(info["Stage ID"], "-")
                    agg[desc]["stages"] += 1
                    agg[desc]["tasks"] += info.get("Number of Tasks", 0)
                    stage_name[info["Stage ID"]] = info.get("Stage Name", "")
                elif ev == "SparkListenerTaskEnd":
                    desc = stage_desc.get(e.get("Stage ID"), "-")
                    m = e.get("Task Metrics") or {}
                    agg[desc]["task_ms"] += m.get("Executor Run Time", 0)
                    stage_ms[e.get("Stage ID")] += m.get("Executor Run Time", 0)
                    agg[desc]["shuffle_read"] += (m.get("Shuffle Read Metrics") or {}).get("Remote Bytes Read", 0) + \
                        (m.get("Shuffle Read Metrics") or {}).get("Local Bytes Read", 0)
                    agg[desc]["shuffle_write"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    agg[desc]["spill"] += m.get("Disk Bytes Spilled", 0)
    print(f"{'query':28s} {'jobs':>5s} {'stages':>6s} {'tasks':>6s} {'task_s':>8s} {'shuf_rd_MB':>10s} "
          f"{'shuf_wr_MB':>10s} {'spill_MB':>8s}")
    for desc, c in sorted(agg.items()):
        if desc.startswith("id = "):  # a streaming micro-batch: keep the batch number
            desc = "stream batch " + desc.rsplit("batch = ", 1)[-1]
        print(f"{desc[:28]:28s} {c['jobs']:5d} {c['stages']:6d} {c['tasks']:6d} {c['task_ms'] / 1000:8.2f} "
              f"{c['shuffle_read'] / 1e6:10.2f} {c['shuffle_write'] / 1e6:10.2f} {c['spill'] / 1e6:8.2f}")


    if "--stages" in sys.argv:
        print("\nslowest stages (summed task time):")
        for sid, ms in stage_ms.most_common(15):
            print(f"  stage {sid:4d} {ms / 1000:8.2f}s  {stage_desc.get(sid, '-')[:30]:30s} {stage_name.get(sid, '')[:70]}")


if __name__ == "__main__":
    main()
