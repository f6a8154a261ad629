import json
import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_DRIVER_MEMORY="2g")
    env.pop("BENCH_EVENT_LOG_DIR", None)
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600, check=True).stdout
    lines = [line for line in out.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert result["metric"] == "total_query_time" and result["unit"] == "sec"
    assert result["sf"] == 0.001
    assert result["queries"] and all(t > 0 for t in result["queries"].values())
    assert abs(result["value"] - sum(result["queries"].values())) < 0.01
