"""Workers need no copy of the package: the operators run in a session started from another folder."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

CODE = """
import sys, tempfile
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", {folder!r}).getOrCreate())
spark.sparkContext.setLogLevel("OFF")
from tallyloom.llm.queries import QUERIES
for name in {names!r}:
    print(name, QUERIES[name](spark, "/root/testdata/sf0.001").count(), flush=True)
"""
NAMES = ["op3_toxicity", "op9_token_counts", "op10_substring_dedup", "op11_personal_data", "op12_ranked_search", "op13_token_alignment",
         "op2_ngram_join", "op5_decontamination", "op6_language_id", "op7_mixing"]


def test_queries_run_from_another_folder(tmp_path):
    if not os.path.exists("/root/testdata/sf0.001"):
        pytest.skip("the given tables are not here")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = CODE.format(repo=str(Path(__file__).resolve().parents[2]), folder=str(tmp_path), names=NAMES)
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    assert [line.split(" ")[0] for line in done.stdout.splitlines() if line.startswith("op")] == NAMES
