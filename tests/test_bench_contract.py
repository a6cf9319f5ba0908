"""bench.py prints exactly one JSON line with the fields the driver records."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_SMOKE


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMOKE, BENCH_CPUS="2")
    proc = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "silver_crm_prd_info", "dq_nulls"],
                          capture_output=True, text=True, env=env, timeout=600, cwd=ROOT)
    assert proc.returncode == 0, proc.stderr[-2000:]
    lines = [line for line in proc.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    out = json.loads(lines[0])
    assert out["unit"] == "sec" and out["sf"] == 0.001
    assert set(out["queries"]) == {"silver_crm_prd_info", "dq_nulls"}
    assert abs(out["value"] - sum(out["queries"].values())) < 0.01
