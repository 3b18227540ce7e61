"""Stage timeline of one registered query from Spark's event log.

usage: python tools/stage_profile.py sf_dir query [runs]

Runs the query ``runs`` times (default 2) into the noop sink with the event log
written to a fresh scratch folder, then reports for the last run: wall time,
jobs, stages, summed stage time, time with at least one stage running, and the
longest stages. No UI or REST endpoint is used.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from settlebook.queries import queries  # noqa: E402
from settlebook.session import build_session  # noqa: E402


def _events(folder: str):
    import zstandard
    for f in sorted(glob.glob(f"{folder}/*/*")):
        if f.endswith(".zstd"):
            stream = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(open(f, "rb")), encoding="utf-8")
        elif os.path.basename(f).startswith("events_"):
            stream = open(f, encoding="utf-8")
        else:
            continue
        for line in stream:
            yield json.loads(line)


def main() -> None:
    sf_dir, name = sys.argv[1], sys.argv[2]
    runs = int(sys.argv[3]) if len(sys.argv) > 3 else 2
    folder = tempfile.mkdtemp(prefix="settlebook-evlog-")
    spark = build_session("local[8]", 16, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": folder})
    for _ in range(runs):
        t0 = time.time()
        queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        print(f"run {time.time() - t0:.2f}s")
    spark.stop()

    stages, execs = {}, {}
    for e in _events(folder):
        ev = e["Event"]
        if ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (si["Submission Time"], si["Completion Time"], si["Number of Tasks"])
        elif ev.endswith("SQLExecutionStart"):
            execs[e["executionId"]] = [e["time"], None]
        elif ev.endswith("SQLExecutionEnd"):
            execs[e["executionId"]][1] = e["time"]
    t0, t1 = execs[max(execs)]
    last = sorted(v for v in stages.values() if v[0] >= t0 and v[1] <= t1 + 1)
    busy, end = 0, t0
    for a, b, _ in last:
        busy += max(0, b - max(a, end))
        end = max(end, b)
    print(json.dumps({"query": name, "wall_ms": t1 - t0, "stages": len(last),
                      "stage_ms_sum": sum(b - a for a, b, _ in last), "busy_ms": busy,
                      "longest": [(b - a, n) for a, b, n in sorted(last, key=lambda s: s[0] - s[1])[:8]],
                      "event_log": folder}))


if __name__ == "__main__":
    main()
