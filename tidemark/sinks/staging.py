"""Staged reads: run a query once, keep its result as Parquet, read it from there."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import time
import uuid
from functools import cache
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.errors import OptionError
from tidemark.sinks.runs import read_if_there

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Setting of a session: for how many hours a staged folder is wanted.
KEEP_HOURS, DEFAULT_HOURS = "tidemark.staged.hours", "168"
STAGED = re.compile(r"staged-([0-9]+)-[0-9a-f]{32}")
HELD = "folder string, until bigint"


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for intermediate tables.

    Only a local session may fall back on a temporary folder of this machine, which goes when
    the process ends.  What is staged in a cluster's folder stays until :func:`sweep_staged` is called there.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    return _own_folder()


@cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="tidemark-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def fresh_path(spark: SparkSession, tempdir: str | None = None) -> str:
    """A path under the shared folder (or ``tempdir``) that nothing uses yet.

    Its name tells when it expires: after the hours of ``tidemark.staged.hours``, a week if that is unset.
    """
    expires = int(time.time() + 3600 * _hours(spark.conf.get(KEEP_HOURS, DEFAULT_HOURS)))
    return f"{(tempdir or shared_dir(spark)).rstrip('/')}/staged-{expires}-{uuid.uuid4().hex}"


def hold_staged(df: DataFrame, hours: float) -> None:
    """Keep the staged folders that a frame reads for ``hours`` more from now, at least.

    For a reader that outlives the run that staged them.  Holds lie in ``held`` beside the folders.
    """
    until = int(time.time() + 3600 * _hours(hours))
    held: dict[str, set[str]] = {}
    for file in df.inputFiles():
        parts = unquote(file).split("/")
        for at, name in enumerate(parts):
            if STAGED.fullmatch(name):
                held.setdefault("/".join(parts[:at]), set()).add(name)
    if not held:
        raise OptionError("the frame reads no staged folder")
    for parent, names in held.items():
        rows = df.sparkSession.createDataFrame([(n, until) for n in sorted(names)], HELD)
        rows.coalesce(1).write.mode("append").parquet(f"{parent}/held")


def sweep_staged(spark: SparkSession, tempdir: str | None = None) -> list[str]:
    """Remove the staged folders that have expired and that nobody holds; their names.

    Also those of runs that were killed, complete or not.  Folders of other names are left alone, as
    are those that an older version of this library made.  Call it where no
    run is older than its hours.
    """
    parent = (tempdir or shared_dir(spark)).rstrip("/")
    now = int(time.time())
    paths = spark._jvm.org.apache.hadoop.fs.Path
    store = paths(parent).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not store.exists(paths(parent)):
        return []
    names = [f.getPath().getName() for f in store.listStatus(paths(parent)) if f.isDirectory()]
    found = {n: STAGED.fullmatch(n) for n in names}
    expired = sorted(n for n, match in found.items() if match and int(match[1]) < now)
    holds = read_if_there(spark, f"{parent}/held", HELD).where(F.col("until") >= now)
    # a hold for each folder that outlives its run, so no more than there are folders
    kept = {r.folder for r in holds.select("folder").distinct().collect()} if expired else set()
    removed = [n for n in expired if n not in kept]
    for name in removed:
        store.delete(paths(f"{parent}/{name}"), True)
    return removed


def _hours(given: str | float) -> float:
    try:
        hours = float(given)
    except ValueError:
        hours = -1.0
    if not 0 <= hours < 10**6:
        raise OptionError(f"staged folders are kept for a number of hours, not {given!r}")
    return hours


def stage(df: DataFrame, tempdir: str | None = None) -> DataFrame:
    """Write a frame to a fresh Parquet folder and return a frame that reads it.

    Whatever is done with the result, the source runs once: its columns can be
    pruned and filtered in Parquet, and a lost executor re-reads files and not the
    source, which may have changed.  A folder that the cluster or the caller named stays.
    """
    spark = df.sparkSession
    path = fresh_path(spark, tempdir)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_query(spark: SparkSession, query: str, tempdir: str | None = None) -> DataFrame:
    """:func:`stage` of a SQL query."""
    return stage(spark.sql(query), tempdir)


def stage_table(spark: SparkSession, table: str, tempdir: str | None = None) -> DataFrame:
    """:func:`stage` of a catalog table or view."""
    return stage(spark.table(table), tempdir)
