"""Python functions reach executors that do not have the package."""

import os
import subprocess
import sys

from conftest import SF

from catalog.common import table

PROGRAM = f"""
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from catalog import QUERIES
for name in ("token_murmur3", "split_failed_batch"):
    print(name, len(QUERIES[name](spark, {SF!r}).collect()))
"""


def test_functions_travel_with_the_tasks(spark, tmp_path):
    orders = table(spark, SF, "orders")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", PROGRAM], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120
    )
    refused = orders.where("o_orderpriority = '5-LOW'").count()
    want = [f"token_murmur3 {orders.count()}", f"split_failed_batch {refused}"]
    assert done.stdout.split("\n")[:2] == want, done.stderr[-2000:]
