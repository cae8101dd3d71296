"""The driver contract: bench.py prints one JSON line covering every
registered query; every oracle belongs to a registered query."""

import json
import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_CPUS="4")
    res = subprocess.run([sys.executable, os.path.join(REPO, "bench.py")], env=env, cwd=REPO,
                         capture_output=True, text=True, timeout=900)
    lines = [ln for ln in res.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1, res.stdout[-2000:] + res.stderr[-2000:]
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == "0.001" and isinstance(d["value"], float)
    sys.path.insert(0, REPO)
    import __spark_entry__ as entry
    assert set(d["queries"]) == set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
