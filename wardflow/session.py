"""Session settings and the shared work folder."""

from __future__ import annotations

import contextlib
import os
import uuid

from pyspark.sql import SparkSession

# Runtime settings only, so they also apply to a session that a cluster hands us.
_RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even when that costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Needed to read and write code page 1252.
    "spark.sql.legacy.javaCharsets": "true",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "wardflow", work_dir: str | None = None) -> SparkSession:
    """Single-machine session for tests and the bench; staged tables go to ``work_dir``."""
    builder = SparkSession.builder.config("spark.checkpoint.dir", work_dir) if work_dir else SparkSession.builder
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def tune(spark: SparkSession) -> SparkSession:
    for key, value in _RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def workers_import(spark: SparkSession) -> None:
    """Let Python workers on this machine import the library from where it lies; a cluster gets it with --py-files."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``.  Only where that is unset and Spark runs on
    one machine (tests) a folder below the warehouse is used.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:").rstrip("/") + "/_stage"


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


#: Paths written by ``materialise`` since the innermost ``staging`` block was entered.
_STAGED: list[list[str]] = [[]]


def materialise(spark: SparkSession, df, label: str):
    """Write ``df`` once to the shared folder and read it back.

    Used where a later step must see exactly the same row placement, or where an expensive
    frame feeds several branches.  The written copy survives lost executors; ``staging`` deletes it.
    """
    path = work_path(spark, label)
    # Nobody looks for the marker: the copy is read by the job that wrote it.
    df.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    _STAGED[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def in_place(spark: SparkSession, tasks: int | None = None):
    """Joins run inside the block send no rows again that are partitioned by some of the join's columns.

    For inputs whose partitions are known to be even; the block must run the job, not only plan it.  With ``tasks``, that is the
    number of partitions of every exchange, however small, so that the rows of a task are known.
    """
    held = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}
    if tasks:
        held |= {"spark.sql.shuffle.partitions": str(tasks), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@contextlib.contextmanager
def staging(spark: SparkSession):
    """Delete the copies that were staged inside the block, when it is left.

    A result is lazy and may still read its staged inputs, so write or count it inside the block.
    """
    _STAGED.append([])
    try:
        yield
    finally:
        fs = spark._jvm.org.apache.hadoop.fs
        for path in _STAGED.pop():
            target = fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
