"""bench.py prints exactly one JSON line with the driver's fields."""
import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600, cwd=ROOT)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1, lines
    doc = json.loads(lines[0])
    assert set(doc) == {"metric", "value", "unit", "queries", "sf"}
    assert doc["unit"] == "sec" and doc["sf"] == "0.001"
    assert "screener" in doc["queries"] and "processing_job" in doc["queries"]
    assert abs(doc["value"] - sum(doc["queries"].values())) < 0.01
