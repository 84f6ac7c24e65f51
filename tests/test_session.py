"""Scratch-folder fallback, in a separate process whose Spark config has no
spark.checkpoint.dir."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from sigflow.session import build_session, new_scratch_dir, scratch_root
spark = build_session("local[1]")
assert spark.conf.get("spark.checkpoint.dir", None) is None
a, b = scratch_root(spark), scratch_root(spark)
assert a == b and new_scratch_dir(spark, "x").startswith(a)
print("ROOT", a)
spark.stop()
"""


def test_local_fallback_without_checkpoint_dir():
    conf_dir = tempfile.mkdtemp(prefix="run-conf-", dir="/tmp")
    env = dict(os.environ, SPARK_CONF_DIR=conf_dir)
    out = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(repo=REPO)], env=env, capture_output=True, text=True, timeout=300
    )
    assert out.returncode == 0, out.stderr[-2000:]
    root = [line for line in out.stdout.splitlines() if line.startswith("ROOT")][0].split(" ", 1)[1]
    assert "/tmp/run-" in root
