"""A session started elsewhere, without the package on its path, can still post."""

import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from decimal import Decimal
from pyspark.sql import SparkSession
from regiobank.model import ACCOUNTS, REQUESTS
from regiobank.operators.ledger import post_ledger
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {scratch!r}).getOrCreate())
rows = [(1, 1, "A", "CHECKING", Decimal(1), "USD", "NA", "ACTIVE", None, None, "SHARD1")]
requests = [(1, "WITHDRAWAL", "A", None, Decimal(2), "x")]
posting = post_ledger(spark.createDataFrame(rows, ACCOUNTS), spark.createDataFrame(requests, REQUESTS), "2024-05-01 00:00:00")
print("ROUNDS", posting.rounds, [r.status for r in posting.requests.collect()])
"""


def test_workers_get_the_package(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    (tmp_path / "empty").mkdir()
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = SCRIPT.format(repo=repo, scratch=str(tmp_path / "scratch"))
    run = [sys.executable, "-c", script]
    done = subprocess.run(run, cwd=tmp_path / "empty", env=env, capture_output=True, text=True, timeout=300)
    assert "ROUNDS 1 ['REJECTED']" in done.stdout, done.stderr[-2000:]
