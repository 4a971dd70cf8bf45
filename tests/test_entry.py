import os
import shutil
import subprocess
import sys

import __spark_entry__

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_imports_without_the_training_data_folder(tmp_path):
    for name in ("siltstone", "__spark_entry__.py"):
        to = tmp_path / name
        if os.path.isdir(os.path.join(ROOT, name)):
            shutil.copytree(os.path.join(ROOT, name), to, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(os.path.join(ROOT, name), to)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'route_works' in q and not any(n.startswith('op') or n == 'pipeline' for n in q); assert e.oracle_sql()"
    for folder in (None, tmp_path / "siltstone" / "llm" / "__pycache__"):
        if folder:
            folder.mkdir(parents=True)
        env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
        done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
        assert done.returncode == 0, done.stderr


def test_executors_get_the_package(tmp_path):
    """Workers start elsewhere and without a path to the sources, and each query is the first of its session."""
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
import __spark_entry__ as e
few = ("latex_clean", "xml_crosswalk", "article_fingerprint", "fidelity_verdict", "missing_runs", "caption_matches")
for name in [n for n in e.queries() if n in few or n.startswith("op") or n == "pipeline"]:
    spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
    assert e.queries()[name](spark, "/root/testdata/sf0.001").count() > 0, name
    spark.stop()
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
