"""Python workers get their functions with the task, wherever the driver was started."""

import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
JOB = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as entry
from signalpost import build_session
spark = build_session("away", "local[2]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": 2})
print("rows", len(entry.queries()["e16_dtw_distance"](spark, "/root/testdata/sf0.001").collect()))
"""


def test_started_in_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", JOB, REPO], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 36" in done.stdout, done.stderr[-2000:]


def test_without_the_text_operators(tmp_path):
    """The entry module and the other queries do not need the operators for training text or their pipeline."""
    shutil.copytree(REPO, tmp_path / "repo", ignore=shutil.ignore_patterns("llm", ".git", "corpus_pipeline.py", "__pycache__", "spark-warehouse"))
    code = "import __spark_entry__ as e; print(len(e.queries()), [n for n in e.queries() if n.startswith('op') or n == 'pipeline'])"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path / "repo", env=env, capture_output=True, text=True, timeout=120)
    assert done.stdout.strip().endswith("[]") and int(done.stdout.split()[0]) > 140, done.stderr[-2000:]
