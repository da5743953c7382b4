import os
import subprocess
import sys

CODE = """
import sys; sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from granary.operators.parse_failures import failed_lines
from granary.runtime import ship
rows = [(1, "f", "jsonl", 1, "{{")]
print("reasons", [r.reason for r in failed_lines(spark.createDataFrame(rows, "line_id long, file string, layout string, line_num long, line string")).collect()])
"""


def test_workers_get_the_package(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE.format(repo=repo)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert "reasons ['invalid_json']" in done.stdout, done.stderr[-2000:]
