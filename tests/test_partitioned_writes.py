"""Partitioned writes: no task sorts its rows by partition, and every row arrives in its partition."""

import json
import os
import subprocess
import sys

from pyspark.sql import functions as F

from ledgerloom.sinks import tables as K

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PUBLISH = """
import sys
from pyspark.sql import SparkSession, functions as F
from ledgerloom.plans.rule_jobs import publish_rules
conf = {"spark.ui.enabled": "false", "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{sys.argv[1]}/log",
        "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false", "spark.driver.host": "127.0.0.1"}
spark = SparkSession.builder.master("local[2]").config(map=conf).getOrCreate()
rules = spark.range(0, 200_000, 1, 1).select(
    "id", F.concat(F.lit("value "), "id").alias("v"), F.concat(F.lit("SET "), F.col("id") % 3).alias("mapping_rule_set_name"))
publish_rules(rules, f"{sys.argv[1]}/rules")
spark.stop()
"""


def test_memory_of_a_publishing_task_does_not_grow_with_its_rows(folder):
    os.mkdir(f"{folder}/log")
    environment = {**os.environ, "PYTHONPATH": f"{REPO}:{os.environ.get('PYTHONPATH', '')}"}
    subprocess.run([sys.executable, "-c", PUBLISH, folder], check=True, cwd=folder, env=environment, timeout=200)
    (log,) = os.listdir(f"{folder}/log")
    with open(f"{folder}/log/{log}") as lines:
        events = [json.loads(line) for line in lines]
    peaks = [e["Task Metrics"]["Peak Execution Memory"] for e in events if e["Event"] == "SparkListenerTaskEnd"]
    assert peaks and max(peaks) < 4_000_000  # sorted, the rows take 20 MB
    assert sorted(f for f in os.listdir(f"{folder}/rules") if "=" in f) == [f"part_mapping_rule_set_name=SET {i}" for i in range(3)]


def test_more_partitions_than_open_files(spark, folder):
    n = 3 * K.OPEN_FILES
    rows = spark.range(0, 5_000, 1, 2).select("id", F.when(F.col("id") % n > 0, F.col("id") % n).alias("p"))
    K.overwrite_partitions(rows, f"{folder}/t", ["p"])
    K.overwrite_partitions(rows.where("p = 5").limit(1), f"{folder}/t", ["p"])
    got = spark.read.parquet(f"{folder}/t")
    want = rows.where("p IS NULL OR p <> 5").unionAll(rows.where("p = 5").limit(1))
    assert sorted(got.select("id", F.col("p").cast("bigint")).collect(), key=str) == sorted(want.collect(), key=str)


def test_the_setting_is_the_callers_own(spark):
    name, former = "spark.sql.maxConcurrentOutputFileWriters", spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None)
    with K.files_at_once(spark, 3):
        assert spark.conf.get(name) == "3"
        with K.files_at_once(spark, 2):
            assert spark.conf.get(name) == "3"
        assert spark.conf.get(name) == "3"
    assert spark.conf.get(name, None) == former
