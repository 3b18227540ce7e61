"""The close CLI writes every stage (run as a separate process)."""

import json
import os
import subprocess
import sys
import tempfile

from settlebook.plans.closing import STAGES

from conftest import SF_SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_close_cli_writes_all_stages():
    out = tempfile.mkdtemp(prefix="settlebook-cli-")
    r = subprocess.run([sys.executable, "-m", "settlebook.close", "--driver-tables", SF_SMALL, "--out", out,
                        "--stages", "all", "--master", "local[2]"],
                       cwd=ROOT, capture_output=True, text=True, timeout=600)
    assert r.returncode == 0, r.stderr[-2000:]
    written = sorted(os.listdir(out))
    assert written == sorted(STAGES)
    now = json.load(open(os.path.join(out, "balance", "_current.json")))
    assert any(f.endswith(".parquet") for f in os.listdir(os.path.join(out, "balance", now["version"])))
    assert len(now["run"]) == 64 and set(now["after"]) == set(STAGES) - {"balance"}
