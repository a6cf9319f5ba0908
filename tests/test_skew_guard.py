"""Regression guard for skew handling: per-task shuffle records from Spark's event log.

Runs ``tools/skew_report.py`` (its own session, event log in a fresh scratch folder) on sf0.01
orders where one customer holds a third of the rows.
"""

from __future__ import annotations

import os
import re
import subprocess
import sys

from conftest import ROOT, SF_SMALL


def test_skew_aware_operators_stay_balanced():
    proc = subprocess.run([sys.executable, os.path.join(ROOT, "tools", "skew_report.py"), SF_SMALL],
                          capture_output=True, text=True, timeout=900, cwd=ROOT)
    assert proc.returncode == 0, proc.stderr[-2000:]
    ratio = {}
    tasks = {}
    for line in proc.stdout.splitlines():
        m = re.match(r"^(.+?)\s+(\d+)\s+(\d+)\s+(\d+)\s+([0-9.]+)$", line)
        if m:
            ratio[m.group(1).strip()] = float(m.group(5))
            tasks[m.group(1).strip()] = int(m.group(2))
    # The plain forms show the skew (the test would catch a broken scenario) ...
    assert ratio["lead: plain window"] > 3 and ratio["join: plain shuffle join"] > 3
    assert tasks["key: global window"] == 1
    # ... the skew-aware forms stay close to the mean task.
    assert ratio["lead: range buckets"] < 2
    assert ratio["key: range buckets"] < 1.6 and tasks["key: range buckets"] > 1
    assert ratio["latest per key: window rn=1"] < 1.5
    assert ratio["join: salted shuffle join"] < 2.5
    assert ratio["not in: plain anti join"] > 3 and ratio["not in: exact, salted"] < 2.5
