"""The life of staged folders: they go when they have expired and nobody holds them."""

from __future__ import annotations

import os
import subprocess
import sys
import time
from pathlib import Path

import pytest

import tidemark as tm
from tidemark.sinks import staging

ROOT = Path(__file__).resolve().parents[1]


@pytest.fixture
def hours(spark):
    def set_to(n):
        spark.conf.set(staging.KEEP_HOURS, str(n))

    yield set_to
    spark.conf.unset(staging.KEEP_HOURS)


def test_expired_folders_go_and_others_stay(spark, tmp_path, hours):
    tmp_path = tmp_path / "with a space"
    tmp_path.mkdir()
    folder = str(tmp_path)
    (tmp_path / "staged-owned-by-someone").mkdir()
    (tmp_path / "staged-1-").mkdir()
    (tmp_path / "staged-00000000000000000000000000000000").mkdir()
    (tmp_path / f"staged-1-{'0' * 32}").write_text("a file, not a folder")
    kept = tm.stage(spark.range(5), folder)
    hours(0)
    tm.stage(spark.range(7), folder)
    held = tm.stage(spark.range(9), folder)
    tm.hold_staged(held.where("id > 3"), 1)
    (tmp_path / f"staged-1-{'f' * 32}" / "_temporary").mkdir(parents=True)  # a killed run
    time.sleep(1.1)
    before = {p.name for p in tmp_path.iterdir()}
    removed = tm.sweep_staged(spark, folder)
    assert len(removed) == 2 and f"staged-1-{'f' * 32}" in removed
    assert {p.name for p in tmp_path.iterdir()} == before - set(removed)
    assert kept.count() == 5 and held.count() == 9
    assert tm.sweep_staged(spark, folder) == []


def test_a_hold_ends(spark, tmp_path, hours, monkeypatch):
    hours(0)
    held = tm.stage(spark.range(9), str(tmp_path))
    tm.hold_staged(held, 1)
    tm.hold_staged(held, 2)
    later = time.time() + 5400
    monkeypatch.setattr(staging.time, "time", lambda: later)
    assert tm.sweep_staged(spark, str(tmp_path)) == []
    monkeypatch.setattr(staging.time, "time", lambda: later + 3600)
    assert len(tm.sweep_staged(spark, str(tmp_path))) == 1


def test_folder_of_a_load_with_tempdir_can_be_held(spark, tmp_path, hours):
    hours(0)
    load = tm.loader(spark).options(partitionColumn="id", offset="3", tempdir=str(tmp_path))
    loaded = load.load(spark.range(9).toDF("id"))
    tm.hold_staged(loaded.df, 1)
    time.sleep(1.1)
    assert tm.sweep_staged(spark, str(tmp_path)) == []
    assert loaded.df.count() == 5


def killed(folder: str) -> None:
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
    spark.conf.set(staging.KEEP_HOURS, "0")
    tm.stage(spark.range(4), folder)
    os._exit(9)


def test_folders_of_a_killed_run_go(spark, tmp_path):
    paths = {**os.environ, "PYTHONPATH": f"{ROOT}{os.pathsep}{ROOT / 'tests'}"}
    command = [sys.executable, "-c", f"import test_staging; test_staging.killed({str(tmp_path)!r})"]
    assert subprocess.run(command, capture_output=True, timeout=120, env=paths).returncode == 9
    time.sleep(1.1)
    assert len(tm.sweep_staged(spark, str(tmp_path))) == 1
    assert not list(tmp_path.glob("staged-*"))


def test_wrong_arguments(spark, tmp_path, hours):
    with pytest.raises(tm.OptionError, match="no staged"):
        tm.hold_staged(spark.range(3), 1)
    for wrong in ("soon", -1, "nan"):
        hours(wrong)
        with pytest.raises(tm.OptionError, match="hours"):
            tm.stage(spark.range(1), str(tmp_path))
    hours(1)
    assert tm.sweep_staged(spark, str(tmp_path / "none")) == []
