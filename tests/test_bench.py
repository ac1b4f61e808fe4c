"""bench.py prints exactly one JSON line with the agreed fields."""

import json
import os
import subprocess
import sys
from pathlib import Path


def test_bench_prints_one_json_line():
    root = Path(__file__).resolve().parents[1]
    env = {**os.environ, "BENCH_SF_DIR": "/root/testdata/sf0.001", "BENCH_CPUS": "4",
           "BENCH_QUERIES": "gold_stats,dedup_report"}
    out = subprocess.run([sys.executable, str(root / "bench.py")], capture_output=True, text=True,
                         env=env, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(result)
    assert result["unit"] == "sec" and result["sf"] == 0.001
    assert set(result["queries"]) == {"gold_stats", "dedup_report"}
    assert abs(result["value"] - sum(result["queries"].values())) < 1e-6
    assert result["stages"]["rows"]["gold"] > 0
