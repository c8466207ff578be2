"""Results stay whole when tasks are lost.

Run in a process of its own: the number of task attempts is a setting of the master.
"""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

from pyspark import TaskContext
from pyspark.sql import SparkSession

import tidemark as tm

ROOT = Path(__file__).resolve().parents[1]


def lose_first_attempts(batches):
    task = TaskContext.get()
    for batch in batches:
        if task.partitionId() == 0 and task.attemptNumber() == 0:
            raise RuntimeError("task lost")
        yield batch


def same_rows(a, b):
    return sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def run(folder: str) -> None:
    spark = (
        SparkSession.builder.master("local[4,4]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "3")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    sound = spark.range(0, 2_000, 1, 3).selectExpr(
        "id % 300 AS key", "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k", "id"
    )
    lossy = sound.mapInPandas(lose_first_attempts, sound.schema)
    past = sound.where("k > 5")
    load = tm.loader(spark).options(partitionColumn="k", offset="5", numPartitions=5)

    assert same_rows(load.load(lossy).df, past)
    assert same_rows(load.option("layout", "stride").load(lossy).df, past)
    assert load.load_into(f"{folder}/loaded", lossy) == "1999"
    assert same_rows(spark.read.parquet(f"{folder}/loaded"), past)
    assert same_rows(tm.dedup_latest(lossy, ["key"], "k"), tm.dedup_latest(sound, ["key"], "k"))
    assert same_rows(tm.stage(lossy, folder), sound)
    assert tm.key_check(lossy, ["id"]).first().is_key
    target = tm.MergeTarget(spark, f"{folder}/target", ["key"], "k")
    target.merge(sound.where("id < 900"))
    target.merge(lossy)
    assert same_rows(target.read(), tm.dedup_latest(sound, ["key"], "k"))
    late = load.load_late(["id"], f"{folder}/delivered", 3, lossy)
    assert same_rows(late.df, past) and late.confirm() == "1999"
    spark.stop()


def test_lost_tasks(tmp_path):
    # Spark's Python workers import this module as well.
    paths = {**os.environ, "PYTHONPATH": f"{ROOT}{os.pathsep}{ROOT / 'tests'}"}
    command = [sys.executable, "-c", f"import test_retries; test_retries.run({str(tmp_path)!r})"]
    done = subprocess.run(command, capture_output=True, text=True, timeout=600, env=paths)
    assert done.returncode == 0, done.stderr[-3000:]
