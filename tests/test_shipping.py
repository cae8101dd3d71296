"""Python workers must import this package even when the driver runs from
another folder (as on a cluster): the Arrow paths ship it themselves."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from tessera.session import local_session
from tessera.operators.numeric import compensated_sum
from tessera.operators.quality import check_kv_lines
spark = local_session(2, 2)
df = spark.createDataFrame([("a", 1.0), ("a", 1e100), ("a", 1.0), ("a", -1e100)], "k string, x double")
assert compensated_sum(df, "x", ["k"]).collect()[0]["total"] == 2.0
lines = spark.createDataFrame([('"a"\\t{{"b": 1}}',), ("x\\t1",)], "value string")
assert [r.reason for r in check_kv_lines(lines).collect()] == ["bad_key"]
print("OK")
"""


def test_python_paths_work_outside_the_repo():
    cwd = tempfile.mkdtemp(prefix="tessera-elsewhere-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    res = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True,
                         text=True, timeout=300)
    assert "OK" in res.stdout, res.stderr[-2000:]
