import json
import subprocess
import sys
from pathlib import Path


def test_jobs_recompute_identically_after_task_failures(tmp_path):
    script = Path(__file__).with_name("retry_job.py")
    out = subprocess.run(
        [sys.executable, str(script), str(tmp_path / "ckpt")], capture_output=True, text=True, timeout=600
    )
    last = [line for line in out.stdout.splitlines() if line.startswith("{")]
    assert last, out.stderr[-2000:]
    res = json.loads(last[-1])
    assert res == {"same_report": True, "rows": res["rows"], "dense_ids": True, "same_id_ranges": True}
    assert res["rows"] > 0
