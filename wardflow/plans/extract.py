"""Config-driven extract: a task row decides the query, the file name, the layout and the splitting."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import parse_split_setting, report_name, split_index_text, split_limit_bytes
from ..session import materialise
from ..sinks import codepage, delimited, named, packing, split
from ..streaming.incremental import Extracts, task_config, watermarks


def _resolved(spark: SparkSession, template: str, run_at: dt.datetime) -> str:
    """Name of a single output; it does not depend on rows."""
    return spark.range(1).select(report_name(template, F.lit(run_at).cast("timestamp_ntz"))).first()[0]


def file_lines(df: DataFrame, template: str, at, sep: str = ",", header: bool = True, quote_all: bool = False, encoding: str | None = None,
               split_setting: str | None = None, order: list[str] | None = None, file_name_part: str | None = None, date_part: str | None = None) -> DataFrame:
    """Rows as bytes with the exact name of their file: columns file_name, part, line_bytes, the order and the line.

    Names follow ``template``; with a split setting the index of the part fills its place, and parts restart for every name.
    """
    shown = [c for c in df.columns if c not in (file_name_part, date_part)]
    order = order or shown
    lines = codepage.with_lines(df, shown, sep, quote_all, encoding, "_line")
    where = [*[F.col(c).alias(f"_by{i}") for i, c in enumerate(order)], F.col("_line").alias("line")]
    stem = report_name(template, at, file_name_part, date_part, F.lit("{SPLITINDEX}")).alias("file_name")
    rows = lines.select(stem, *where)
    by = [f"_by{i}" for i in range(len(order))]
    if not split_setting:
        return rows.select(F.replace("file_name", F.lit("{SPLITINDEX}"), F.lit("")).alias("file_name"), F.lit(1).alias("part"),
                           codepage.line_size().cast("long").alias("line_bytes"), *by, "line")
    index_format, *_ = parse_split_setting(split_setting)
    top = len(codepage.header_bytes(shown, sep, quote_all, encoding)) if header else 0
    packed = packing.pack(rows, codepage.line_size(), by, max(split_limit_bytes(split_setting) - top, 1), "file_name")
    name = F.replace("file_name", F.lit("{SPLITINDEX}"), split_index_text(index_format, "part"))
    return packed.select(name.alias("file_name"), "part", "line_bytes", *by, "line")


def _write_files(spark, task, df, out_dir, sep, header, quote_all, run_at, params, param_keys, order):
    """(rows read, rows written, target) of a task whose outputs are files with exact names."""
    at = F.lit(run_at).cast("timestamp_ntz")
    template, setting, encoding = task["file_format"], task["split_setting"], task["file_encoding"]
    part = date = names = None
    staged = materialise(spark, df, "extract")
    source = staged
    if params is not None:
        part, date = (next((c for c in params.columns if w in c.lower()), None) for w in ("file_name_part", "date_part"))
        source = staged.join(params, param_keys).select(*df.columns, *[c for c in (part, date) if c])
        source = materialise(spark, source, "extract")
        names = None if setting else delimited.named_parameters(params, template, at)
    lines = file_lines(source, template, at, sep, header, quote_all, encoding, setting, order, part, date)
    top = codepage.header_bytes(df.columns, sep, quote_all, encoding) if header else None
    if params is None and not setting:  # one output, which exists without rows too
        names = spark.range(1).select(report_name(template, at).alias("file_name"))
    log = named.write_named(lines, out_dir, F.col("line"), [c for c in lines.columns if c.startswith("_by")], top, names)
    written = log.agg(F.coalesce(F.sum("rows"), F.lit(0).cast("long"))).first()[0]
    return source, written, template if params is not None or setting else names.first()[0]


def run_task(spark: SparkSession, task_name: str, config: DataFrame, processes: DataFrame, steps: DataFrame, extracts: Extracts,
             out_dir: str, audit_path: str, process_id: int, run_at: dt.datetime, params: DataFrame | None = None,
             param_keys: list[str] | None = None, layout: str = "folders", order: list[str] | None = None) -> dict:
    """Run one task and, after its output is complete, append its audit row.

    Task columns: task_name, task_group, active, task_code (name of the registered query), file_format (name
    template), delimiter, file_flags, split_setting, file_encoding.  ``params`` binds to the rows by
    ``param_keys`` and gives one output per parameter row, all in one write; counts cover all of them, and a
    parameter without rows does not stop the others.

    ``layout="folders"`` writes each output as a folder of that name, by the engine's writers.  ``layout="files"`` writes exactly the
    named files, in the task's encoding and in ``order`` (total; all columns by default), each parameter split for itself, and publishes
    them by one commit; with a split setting, a parameter without rows has no file.
    """
    if layout not in ("folders", "files"):
        raise ValueError(f"unknown layout {layout!r}")
    task = task_config(config, task_name)
    wanted = spark.createDataFrame([(task["task_group"], task_name)], "task_group string, task_name string")
    mark = watermarks(processes, steps, wanted, run_at.date()).first()["watermark"]
    df, new_mark = extracts.run(spark, task["task_code"], {"watermark": mark, "run_at": run_at})
    sep, flags = task["delimiter"] or ",", task["file_flags"]
    header, quote_all = delimited.parse_file_flags(flags)

    at = F.lit(run_at).cast("timestamp_ntz")
    if layout == "files":
        staged, rows, target = _write_files(spark, task, df, out_dir, sep, header, quote_all, run_at, params, param_keys, order or df.columns)
    elif params is not None:
        named = delimited.name_by_parameter(df, params, param_keys, task["file_format"], at).select("file_name", *df.columns)
        staged = materialise(spark, named, "extract")
        names = delimited.named_parameters(params, task["file_format"], at)
        rows = delimited.write_by_name(staged, out_dir, sep, flags, names)
        target = task["file_format"]
    elif task["split_setting"]:
        staged = materialise(spark, df, "extract")
        index_format, *_ = parse_split_setting(task["split_setting"])
        top = delimited.header_line(df.columns, sep, quote_all) if header else None
        text = delimited.line(df.columns, sep, quote_all)
        parts = split.split_by_size(staged, text, df.columns, split_limit_bytes(task["split_setting"]),
                                    len(top.encode()) + split.LINE_END if top else 0, index_format)
        target = _resolved(spark, task["file_format"], run_at)
        rows = delimited.write_counted(parts, lambda d: split.write_parts(d, text, top, f"{out_dir}/{target}"), task_name)
    else:
        staged = materialise(spark, df, "extract")
        target = _resolved(spark, task["file_format"], run_at)
        rows = delimited.write_delimited(staged, f"{out_dir}/{target}", sep, flags, task["file_encoding"] or "UTF-8")
    read = staged.count()
    delimited.reconcile(read, rows, task_name)

    result = {"process_id": process_id, "task_group": task["task_group"], "task_name": task_name, "status": "SUCCESSFUL",
              "source_count": read, "target_count": rows, "target_name": target, "notes": "" if rows else "no rows",
              "last_incremental": new_mark or mark}
    spark.createDataFrame([result], "process_id long, task_group string, task_name string, status string, source_count long, "
                                    "target_count long, target_name string, notes string, last_incremental timestamp_ntz"
                          ).write.mode("append").parquet(audit_path)
    return result
