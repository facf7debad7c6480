from __future__ import annotations

import os
import subprocess
import sys


def test_a_batch_survives_lost_tasks():
    script = os.path.join(os.path.dirname(os.path.abspath(__file__)), "lost_tasks.py")
    env = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK_GATEWAY", "SPARK_"))}
    done = subprocess.run(
        [sys.executable, script, "/root/testdata/sf0.001"],
        env=env,
        capture_output=True,
        text=True,
        timeout=600,
    )
    assert done.returncode == 0, done.stderr[-3000:]
