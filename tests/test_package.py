"""The package works from any folder, and on clusters only with a shared folder."""

import os
import subprocess
import sys

import pytest

from vitalgrid import session

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import importlib.util, sys
spec = importlib.util.spec_from_file_location("entry", sys.argv[1] + "/__spark_entry__.py")
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", sys.argv[2]).getOrCreate()
print("ROWS", entry.queries()["knn_topk"](spark, sys.argv[3]).count())
"""


def test_workers_find_the_package_from_another_folder(tmp_path, folder):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, ROOT, str(tmp_path / "shared"), folder], cwd=tmp_path, env=env,
        capture_output=True, text=True, timeout=300,
    )
    assert "ROWS" in done.stdout, done.stderr[-2000:]


def test_a_cluster_without_a_shared_folder_is_refused():
    class Off:
        def isDefined(self):
            return False

    class Context:
        master = "spark://somewhere:7077"
        _jsc = type("J", (), {"sc": lambda self: type("S", (), {"getCheckpointDir": lambda self: Off()})()})()

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": lambda self, key, default: default})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())
