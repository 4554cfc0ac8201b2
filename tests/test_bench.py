"""bench.py prints exactly one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF0001


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF0001, BENCH_CPUS="2", BENCH_REPEATS="1",
               BENCH_QUERIES="json_props,table_counts")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600, check=True)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and d["metric"] == "total_query_sec"
    assert set(d["queries"]) == {"json_props", "table_counts"}
    assert abs(d["value"] - sum(d["queries"].values())) < 0.01
