"""bench.py prints one JSON line with the keys the driver reads."""

import json
import os
import subprocess
import sys

from conftest import SF_SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_REPEAT="1",
               BENCH_QUERIES="session_rollup,label_counts", BENCH_DRIVER_MEMORY="2g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(d)
    assert d["unit"] == "sec" and d["sf"] == 0.001
    assert set(d["queries"]) == {"session_rollup", "label_counts"}


def test_the_whole_bench_runs():
    """Every query and the comparison runs, as the driver calls it."""
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="4", BENCH_REPEAT="1", BENCH_DRIVER_MEMORY="2g")
    env.pop("BENCH_QUERIES", None)
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=1200)
    assert out.returncode == 0, out.stderr[-2000:]
    d = json.loads(out.stdout.strip())
    from visitlens.plans.catalog import QUERIES
    assert set(d["queries"]) == set(QUERIES)
    assert d["application_shaped_flagship_sec"] > 0 and d["one_job_per_task_sec"] > 0
