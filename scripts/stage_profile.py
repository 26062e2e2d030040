"""Per-stage time of registered queries, read from Spark's event log (no UI, no server).

Usage: python scripts/stage_profile.py <sf_dir> <query> [<query> ...]
Runs each query once to warm up, then once measured with the event log written to a fresh
scratch folder, and prints one markdown table per query: every stage submitted during the
measured run (streaming micro-batches included) with its task count, wall time, summed
task time and shuffle write / read bytes.
"""

from __future__ import annotations

import glob
import json
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from domus.plans.queries import QUERIES  # noqa: E402
from domus.session import get_session  # noqa: E402


def stages(log_file: str, t0_ms: int, t1_ms: int) -> list[dict]:
    """Stages submitted within [t0_ms, t1_ms] (one measured run, streaming batches included)."""
    out: dict[int, dict] = {}
    task_ms: dict[int, int] = {}
    with open(log_file) as f:
        for line in f:
            e = json.loads(line)
            kind = e.get("Event")
            if kind == "SparkListenerTaskEnd":
                info = e.get("Task Info", {})
                sid = e.get("Stage ID")
                task_ms[sid] = task_ms.get(sid, 0) + info.get("Finish Time", 0) - info.get("Launch Time", 0)
            elif kind == "SparkListenerStageCompleted":
                st = e["Stage Info"]
                if not t0_ms <= st.get("Submission Time", 0) <= t1_ms:
                    continue
                acc = {a.get("Name"): a.get("Value") for a in st.get("Accumulables", [])}
                write = int(acc.get("internal.metrics.shuffle.write.bytesWritten") or 0)
                read = (int(acc.get("internal.metrics.shuffle.read.remoteBytesRead") or 0)
                        + int(acc.get("internal.metrics.shuffle.read.localBytesRead") or 0))
                name = st.get("Stage Name", "").split(" at ")[0]
                if name.startswith("$anonfun"):  # submitted by adaptive execution
                    name = "shuffle map" if write else "adaptive stage"
                out[st["Stage ID"]] = {"stage": st["Stage ID"], "name": name, "tasks": st.get("Number of Tasks"),
                                       "wall_ms": st.get("Completion Time", 0) - st.get("Submission Time", 0),
                                       "shuffle_write": write, "shuffle_read": read}
    return [dict(out[s], task_ms=task_ms.get(s, 0)) for s in sorted(out)]


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    logs = tempfile.mkdtemp(prefix="domus-eventlog-")
    spark = get_session("local[8]", app="domus-stage-profile",
                        **{"spark.sql.shuffle.partitions": "16", "spark.eventLog.enabled": "true",
                           "spark.eventLog.dir": logs, "spark.eventLog.rolling.enabled": "false",
                           "spark.eventLog.compress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    windows = {}
    for name in names:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        time.sleep(1)
        t0 = int(time.time() * 1000)
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        windows[name] = (t0, int(time.time() * 1000))
        time.sleep(1)
    spark.stop()
    (log_file,) = glob.glob(f"{logs}/*")
    for name in names:
        t0, t1 = windows[name]
        rows = stages(log_file, t0, t1)
        print(f"\n### {name} ({(t1 - t0) / 1000:.2f} s)\n")
        print("| stage | operation | tasks | wall ms | task ms | shuffle write | shuffle read |")
        print("|---|---|---|---|---|---|---|")
        for r in rows:
            print(f"| {r['stage']} | {r['name']} | {r['tasks']} | {r['wall_ms']} | {r['task_ms']} | "
                  f"{r['shuffle_write'] / 1e6:.1f} MB | {r['shuffle_read'] / 1e6:.1f} MB |")


if __name__ == "__main__":
    main()
