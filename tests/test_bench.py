import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=900)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert out.returncode == 0 and len(lines) == 1, out.stderr[-2000:]
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["value"] > 0 and rec["sf"] == 0.001
    assert {"mart_density", "mart_underserved", "dq_report", "scd2_apply"} <= set(rec["queries"])
