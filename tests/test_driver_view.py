"""What a driver sees: a session in another folder, no library files beside pyspark."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]


def run_elsewhere(folder: Path, code: str, repo: Path = REPO) -> str:
    """Run ``code`` in an empty folder; Python workers cannot import the package there."""
    head = f"import sys; sys.path.insert(0, {str(repo)!r})\n"
    env = {k: x for k, x in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", head + code], cwd=folder, env=env, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr[-3000:]
    return out.stdout


def test_sql_needs_no_session_and_no_library_files(tmp_path):
    code = """
import pyspark, __spark_entry__ as e
pyspark.__file__ = "/nowhere/__init__.py"
print(len(e.oracle_sql()) >= 114)
"""
    assert run_elsewhere(tmp_path, code).split() == ["True"]


def test_queries_run_from_an_empty_folder(tmp_path):
    code = """
import __spark_entry__ as e
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config(
    "spark.ui.enabled", "false").getOrCreate()
run = e.queries()
for name in ("pcy_bucket_counts", "pcy_frequent_buckets", "pcy_pair_counts_bucketed", "batch_embed",
             "scan_csv", "row_count", "tokenize", "split_holdout", "metric_accuracy"):
    run[name](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    print(name)
"""
    assert len(run_elsewhere(tmp_path, code).split()) == 9


def test_library_stands_without_the_training_data_operators(tmp_path):
    """With both folders of those operators gone the rest imports, is registered and runs."""
    repo, folder = tmp_path / "repo", tmp_path / "empty"
    folder.mkdir()
    for name in ("corpusmill", "tests"):
        shutil.copytree(REPO / name, repo / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        shutil.copy(REPO / name, repo / name)
    code = """
import __spark_entry__ as e
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config(
    "spark.ui.enabled", "false").getOrCreate()
run, sql = e.queries(), e.oracle_sql()
print(len(sql) >= 114, "pipeline" in run, any(k.startswith("op") for k in run), set(sql) <= set(run))
print(run["row_count"](spark, "/root/testdata/sf0.001").count())
"""
    assert run_elsewhere(folder, code, repo).split() == ["True", "False", "False", "True", "1"]
