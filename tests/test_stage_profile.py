"""The event-log reader behind scripts/stage_profile.py, on a hand-written log."""

import json
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "scripts"))

import stage_profile  # noqa: E402


def test_stages_in_window_with_shuffle_bytes_and_task_time(tmp_path):
    def stage(sid, name, sub, done, write=0, read=0):
        acc = [{"Name": "internal.metrics.shuffle.write.bytesWritten", "Value": write},
               {"Name": "internal.metrics.shuffle.read.localBytesRead", "Value": read}]
        return {"Event": "SparkListenerStageCompleted",
                "Stage Info": {"Stage ID": sid, "Stage Name": name, "Number of Tasks": 4,
                               "Submission Time": sub, "Completion Time": done, "Accumulables": acc}}

    def task(sid, start, end):
        return {"Event": "SparkListenerTaskEnd", "Stage ID": sid,
                "Task Info": {"Launch Time": start, "Finish Time": end}}

    events = [task(1, 100, 150), task(1, 100, 130), stage(1, "$anonfun$x at A.scala:1", 90, 160, write=2_000_000),
              task(2, 200, 260), stage(2, "save at B.scala:2", 190, 270, read=2_000_000),
              stage(3, "count at C.scala:3", 5000, 5100)]
    log = tmp_path / "log"
    log.write_text("\n".join(json.dumps(e) for e in events) + "\n")
    rows = stage_profile.stages(str(log), 0, 1000)
    assert [(r["stage"], r["name"], r["task_ms"], r["wall_ms"]) for r in rows] == [
        (1, "shuffle map", 80, 70), (2, "save", 60, 80)]
    assert rows[0]["shuffle_write"] == 2_000_000 and rows[1]["shuffle_read"] == 2_000_000
