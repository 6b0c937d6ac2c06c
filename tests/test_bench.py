"""bench.py prints one JSON line with the expected keys."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_QUERIES="top_n,prefix_filter")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, check=True)
    line = out.stdout.strip().splitlines()[-1]
    d = json.loads(line)
    assert d["unit"] == "sec" and d["sf"] == 0.001
    assert set(d["queries"]) == {"top_n", "prefix_filter"} and d["value"] > 0
