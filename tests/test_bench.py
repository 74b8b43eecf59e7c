"""bench.py prints exactly one JSON line with the agreed keys."""

import json
import os
import subprocess
import sys
from pathlib import Path

from tests.conftest import SF_SMALL


def test_bench_prints_one_json_line():
    root = Path(__file__).resolve().parents[1]
    env = {**os.environ, "BENCH_SF_DIR": SF_SMALL, "BENCH_CPUS": "2"}
    out = subprocess.run([sys.executable, str(root / "bench.py"), "gold_customer_sales", "rolling_quality"],
                         capture_output=True, text=True, env=env, timeout=600, cwd=root)
    lines = [l for l in out.stdout.splitlines() if l.strip()]
    assert out.returncode == 0 and len(lines) == 1, out.stderr[-2000:]
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["value"] > 0 and set(rec["queries"]) == {"gold_customer_sales", "rolling_quality"}
    assert rec["sf"] == 0.001
