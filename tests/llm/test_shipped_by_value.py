"""Task functions reach executors that do not have the package: a driver in another folder puts it on its own path only."""

from __future__ import annotations

import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = (
    SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
    .config("spark.checkpoint.dir", {shared!r}).getOrCreate()
)
def found(rows):
    try:
        import merchant_features
        yield (True,)
    except ImportError:
        yield (False,)
assert not spark.range(1).rdd.mapPartitions(found).collect()[0][0], "the workers have the package"
from merchant_features.llm import queries
for name in {names!r}:
    print(name, queries.queries()[name](spark, {sf!r}).count(), flush=True)
"""

NAMES = [
    "op2_jaccard_join", "op3_license_scan", "op5_decontamination", "op7_suffix_dedup", "op8_token_counts", "op9_language_id",
    "op10_warc_zip", "op11_filter_audit", "op12_source_divergence", "op13_embedding_forest",
]


def test_functions_are_shipped_by_value(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    script = SCRIPT.format(repo=repo, shared=str(tmp_path / "shared"), names=NAMES, sf="/root/testdata/sf0.001")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    (tmp_path / "elsewhere").mkdir()
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path / "elsewhere", env=env, capture_output=True, text=True, timeout=900, check=False
    )
    assert done.returncode == 0, done.stderr[-3000:]
    assert [line.split()[0] for line in done.stdout.splitlines()] == NAMES
