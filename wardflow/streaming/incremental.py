"""Watermarks, task configuration and run audit."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.picks import first_per

FIRST_DATE = dt.datetime(1900, 1, 1)
DEFAULT_BACK_DAYS = 3


def task_config(config: DataFrame, task_name: str) -> dict:
    """The active row of a task; none is an error."""
    rows = config.where((F.col("active") == 1) & (F.col("task_name") == task_name)).limit(1).collect()
    if not rows:
        raise ValueError(f"no active task named {task_name!r}")
    return rows[0].asDict()


def group_config(config: DataFrame, group: str | None = None) -> DataFrame:
    """Configuration rows of a group by priority, then id."""
    rows = config if group is None else config.where(F.col("task_group") == group)
    return rows.orderBy("priority", "task_id")


def runs(processes: DataFrame, status: str | None = None, group: str | None = None) -> DataFrame:
    """Group executions: all, running or failed."""
    out = processes
    if status:
        out = out.where(F.col("status") == status)
    if group:
        out = out.where(F.col("task_group") == group)
    return out


def run_steps(steps: DataFrame, process_id: int) -> DataFrame:
    return steps.where(F.col("process_id") == process_id)


def watermarks(processes: DataFrame, steps: DataFrame, tasks: DataFrame, run_date: dt.date) -> DataFrame:
    """Watermark per (task_group, task_name) of ``tasks``.

    It is the date saved by the task in the last successful run of its group; saved as NULL it means
    1900-01-01, and without such a step it is the run date less three days.
    """
    last_run = processes.where("status = 'SUCCESSFUL'").groupBy("task_group").agg(F.max("process_id").alias("process_id"))
    saved = last_run.join(steps, "process_id").select(
        "task_group", "task_name", F.coalesce("last_incremental", F.lit(FIRST_DATE).cast("timestamp_ntz")).alias("_saved"))
    saved = saved.groupBy("task_group", "task_name").agg(F.max("_saved").alias("_saved"))
    default = F.lit(dt.datetime.combine(run_date - dt.timedelta(days=DEFAULT_BACK_DAYS), dt.time())).cast("timestamp_ntz")
    return tasks.join(saved, ["task_group", "task_name"], "left").select(
        "task_group", "task_name", F.coalesce("_saved", default).alias("watermark"))


def newer_rows(df: DataFrame, time: str, task_keys: dict[str, str], marks: DataFrame) -> DataFrame:
    """Rows later than the watermark of their task; ``task_keys`` maps watermark column -> data column."""
    m = marks.select("watermark", *[F.col(k).alias(f"_m_{k}") for k in task_keys])
    on = [F.col(c) == F.col(f"_m_{k}") for k, c in task_keys.items()]
    return df.join(m, on).where(F.col(time) > F.col("watermark")).drop("watermark", *[f"_m_{k}" for k in task_keys])


def run_extract(spark: SparkSession, df: DataFrame, time: str, watermark: dt.datetime, write, audit_path: str,
                task_group: str, task_name: str, process_id: int) -> dict:
    """Write the rows after ``watermark`` and, only after that has succeeded, append the audit row with
    the counts and the new watermark, all taken from the writing job itself."""
    from pyspark.sql import Observation
    seen = Observation(task_name)
    new = df.where(F.col(time) > F.lit(watermark).cast("timestamp_ntz"))
    write(new.observe(seen, F.count(F.lit(1)).alias("rows"), F.max(time).alias("last")))
    metrics = seen.get
    row = (process_id, task_group, task_name, "SUCCESSFUL", metrics["rows"], metrics["rows"], metrics["last"] or watermark)
    audit = spark.createDataFrame(
        [row], "process_id long, task_group string, task_name string, status string, source_count long, "
               "target_count long, last_incremental timestamp_ntz")
    audit.write.mode("append").parquet(audit_path)
    return {"rows": metrics["rows"], "watermark": row[-1]}


def last_success(audit: DataFrame, task_group: str, task_name: str) -> DataFrame:
    return first_per(
        audit.where((F.col("task_group") == task_group) & (F.col("task_name") == task_name) & (F.col("status") == "SUCCESSFUL")),
        ["task_group", "task_name"], [F.col("process_id").desc()])


class Extracts:
    """Named extract queries: ``name -> fn(spark, params) -> DataFrame`` or ``(DataFrame, new watermark)``."""

    def __init__(self):
        self._by_name = {}

    def register(self, name: str):
        def add(fn):
            self._by_name[name] = fn
            return fn
        return add

    def run(self, spark: SparkSession, name: str, params: dict):
        if name not in self._by_name:
            raise KeyError(f"no extract named {name!r}")
        out = self._by_name[name](spark, params)
        return out if isinstance(out, tuple) else (out, None)
