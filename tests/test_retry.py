"""Task loss: results of paging and message jobs survive tasks that fail and rerun."""

import json
import subprocess
import sys
from pathlib import Path


def test_results_survive_task_reruns():
    script = Path(__file__).with_name("retry_job.py")
    proc = subprocess.run([sys.executable, str(script), "/root/testdata/sf0.001"], capture_output=True,
                          text=True, timeout=600)
    assert proc.returncode == 0, proc.stderr[-3000:]
    result = json.loads([line for line in proc.stdout.splitlines() if line.startswith("{")][-1])
    assert result["paging_ok"]
    assert result["messages"] == result["lineitem_rows"] and result["repeated"] == 0
