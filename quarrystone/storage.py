"""Shared storage for intermediate tables, and shipping of this package to executors.

Intermediate tables go below ``spark.checkpoint.dir``, which every executor and
the driver can reach. A table that is written there survives the loss of the
executor that wrote it, and it cuts the lineage of what follows.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
_own: dict[str, str] = {}
_held: dict[str, list[DataFrame | str]] = {}  # by application: what is kept and written, in its order
#: Lets Spark drop the shuffle files of a query once it is done.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where it is unset (tests), one of our own."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not base:
        base = _own.setdefault(sc.applicationId, "")
        if not base:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            base = _own[sc.applicationId] = "file://" + tempfile.mkdtemp(prefix="quarrystone-")
    return f"{base.rstrip('/')}/{sc.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str, compact: bool = False) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back.

    compact: for results that are small beside what they are made from; they are
    rebalanced to files of a useful size instead of one for each task.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")  # nothing reads the shuffles of a table that is written
    try:
        (df.hint("rebalance") if compact else df).write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    _held.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def keep(df: DataFrame, now: bool = False) -> DataFrame:
    """Keep df on the executors' disks for the jobs that read it again.

    now: make it before anything reads it. Two stages of one job that read what
    isn't there yet would both make it, and all that it is made from.

    Lost blocks are made again from their lineage, so df must give the same rows
    in the same order whenever it is run: see replayable().
    """
    kept = df.persist(StorageLevel.DISK_ONLY)
    _held.setdefault(df.sparkSession.sparkContext.applicationId, []).append(kept)
    if now:
        kept.count()
    return kept


def _let_go(spark: SparkSession, held: list[DataFrame | str]) -> None:
    paths = spark._jvm.org.apache.hadoop.fs.Path
    for x in held:
        if isinstance(x, str):
            p = paths(x)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        else:
            x.unpersist()


def clear(spark: SparkSession) -> None:
    """Let go of all that was kept or written so far; nothing that reads it may be used any more."""
    _let_go(spark, _held.pop(spark.sparkContext.applicationId, []))


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Lets go of what is kept or written within, but for the last table that is written: the result."""
    held = _held.setdefault(spark.sparkContext.applicationId, [])
    mark = len(held)
    try:
        yield
    finally:
        last = next((x for x in reversed(held[mark:]) if isinstance(x, str)), None)
        gone = [x for x in held[mark:] if x is not last]
        held[mark:] = [] if last is None else [last]
        _let_go(spark, gone)


def replayable(df: DataFrame) -> DataFrame:
    """df if each of its partitions is read straight from storage; else a written table of it.

    After an exchange rows can come in another order when a task is run again;
    what numbers rows by their place needs an input that doesn't.
    """
    plan = df._jdf.queryExecution().executedPlan().toString()
    direct = re.search("Exchange|Sort|Aggregate|Join|Window|Limit|Sample|ExistingRDD|LocalTable|InMemoryTableScan", plan) is None
    return df if direct else materialize(df, "input")


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers (once per application)."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="quarrystone-zip-")
    target = os.path.join(folder, "quarrystone_pkg.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for top, dirs, names in os.walk(root):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(top, n)
                    z.write(full, os.path.join("quarrystone", os.path.relpath(full, root)))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
