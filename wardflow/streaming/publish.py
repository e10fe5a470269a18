"""Incremental output that is published by one record.

Every attempt of a run writes its rows to a folder of its own.  The run counts once its manifest, a single record with
the folder, the counts and the new watermark, has been appended; readers see only folders that a manifest names, and of several
attempts of a run only the last.  So a run that dies between writing and recording leaves nothing that is read, running it again
replaces what it wrote, and output, counts and watermark can't disagree.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.picks import first_per
from ..sources.files import any_match

MANIFEST = "process_id long, attempt long, folder string, task_group string, task_name string, status string, source_count long, target_count long, last_incremental timestamp_ntz"


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """The last manifest of every run, as audit steps."""
    if not any_match(spark, path, "manifests/part-*"):
        return spark.createDataFrame([], MANIFEST)
    rows = spark.read.schema(MANIFEST).json(f"{path}/manifests")
    return first_per(rows, ["process_id", "task_group", "task_name"], [F.col("attempt").desc(), F.col("folder").desc()])


def watermark(spark: SparkSession, path: str, task_group: str, task_name: str, before: int, first: dt.datetime) -> dt.datetime:
    """Watermark of the last published run before run ``before``; ``first`` where there is none."""
    row = (manifests(spark, path).where((F.col("task_group") == task_group) & (F.col("task_name") == task_name) & (F.col("process_id") < before))
           .orderBy(F.col("process_id").desc()).limit(1).collect())
    return row[0].last_incremental if row and row[0].last_incremental else first


def published(spark: SparkSession, path: str, schema, task_group: str, task_name: str) -> DataFrame:
    """All rows of a task that a manifest names."""
    folders = [r.folder for r in manifests(spark, path).where((F.col("task_group") == task_group) & (F.col("task_name") == task_name))
               .where("target_count > 0").select("folder").collect()]  # one for each run
    parts = [spark.read.schema(schema).parquet(f"{path}/{f}") for f in folders]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def run_published(spark: SparkSession, df: DataFrame, time: str, path: str, task_group: str, task_name: str, process_id: int,
                  first: dt.datetime, record=None) -> dict:
    """Write the rows of ``df`` later than the task's watermark and publish them as run ``process_id``.

    The watermark comes from the runs before this one, so a repeated run reads the same rows again.  ``record`` appends the
    manifest (tests let it fail).
    """
    mark = watermark(spark, path, task_group, task_name, process_id, first)
    earlier = manifests(spark, path).where((F.col("process_id") == process_id) & (F.col("task_group") == task_group) & (F.col("task_name") == task_name)).collect()
    attempt = earlier[0].attempt + 1 if earlier else 1
    folder = f"data/{task_group}/{task_name}/{process_id}-{attempt}-{uuid.uuid4().hex}"
    read, wrote = Observation("read"), Observation("wrote")
    new = df.observe(read, F.count(F.when(F.col(time) > F.lit(mark).cast("timestamp_ntz"), 1)).alias("rows"))
    new = new.where(F.col(time) > F.lit(mark).cast("timestamp_ntz"))
    new.observe(wrote, F.count(F.lit(1)).alias("rows"), F.max(time).alias("last")).write.parquet(f"{path}/{folder}")
    got, put = read.get, wrote.get
    if got["rows"] != put["rows"]:
        raise ValueError(f"{task_name}: read {got['rows']} rows, wrote {put['rows']}")
    row = (process_id, attempt, folder, task_group, task_name, "SUCCESSFUL", got["rows"], put["rows"], put["last"] or mark)
    manifest = spark.createDataFrame([row], MANIFEST).coalesce(1)
    (record or (lambda m: m.write.mode("append").json(f"{path}/manifests")))(manifest)
    return {"rows": put["rows"], "watermark": row[-1], "attempt": attempt}
