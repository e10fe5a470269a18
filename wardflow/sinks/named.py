"""Files with exact names, published by one commit.

Tasks write to a staging folder of their job; only when all have succeeded does the commit move each file to its
name and, last, write the log of names, rows and bytes.  A task that is killed or run twice leaves nothing outside the
staging folder, and a job without its log is not complete.  A file is written in order by one task, which streams its lines
from the sorted exchange; give outputs of unbounded size a split setting.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..session import workers_import

FORMAT = "named_files"
STAGING, LOG = "_staging", "_log"
LOG_SCHEMA = "file_name string, rows long, bytes long"


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path within it; a path without a scheme is local."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = path.removeprefix("file:")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str, int, int]]  # name, staged path, rows, bytes


class NamedFileWriter(DataSourceArrowWriter):
    def __init__(self, path: str, job: str):
        self.path, self.job = path.rstrip("/"), job

    def _staging(self) -> tuple[pafs.FileSystem, str]:
        fs, root = file_system(self.path)
        return fs, f"{root}/{STAGING}/{self.job}"

    def write(self, iterator) -> Written:
        """Lines of a name stand together; a staged file is named by this attempt alone."""
        context = TaskContext.get()
        attempt = f"{context.partitionId()}-{context.taskAttemptId()}" if context else uuid.uuid4().hex
        fs, staging = self._staging()
        folder, files, out, name, rows, size = f"{staging}/{attempt}", [], None, None, 0, 0

        def close():
            if out is not None:
                out.close()
                files.append((name, f"{folder}/{len(files)}", rows, size))

        try:
            for batch in iterator:
                columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("file_name", "rows", "line")]
                for own, n, line in zip(*columns):
                    if out is None or own != name:
                        if not own or own in (".", "..") or "/" in own or "\\" in own or own in (STAGING, LOG):
                            raise ValueError(f"not a file name: {own!r}")
                        close()
                        if not files:
                            fs.create_dir(folder, recursive=True)
                        name, rows, size = own, 0, 0
                        out = fs.open_output_stream(f"{folder}/{len(files)}", compression=None)
                    if line:
                        out.write(line)
                        size += len(line)
                    rows += n or 0
            close()
        except BaseException:
            if out is not None and not out.closed:
                out.close()
            raise
        return Written(files)

    def commit(self, messages) -> None:
        fs, staging = self._staging()
        files = [f for m in messages if m is not None for f in m.files]
        names = [f[0] for f in files]
        if len(set(names)) < len(names):
            raise ValueError("a name was written by two tasks")
        root = staging.rsplit(f"/{STAGING}/", 1)[0]
        fs.create_dir(f"{root}/{LOG}", recursive=True)
        for name, staged, _, _ in files:
            fs.move(staged, f"{root}/{name}")
        fs.create_dir(staging, recursive=True)
        with fs.open_output_stream(f"{staging}/log", compression=None) as log:
            for name, _, rows, size in sorted(files):
                log.write((json.dumps({"file_name": name, "rows": rows, "bytes": size}) + "\n").encode())
        fs.move(f"{staging}/log", f"{root}/{LOG}/{self.job}.json")
        fs.delete_dir(staging)

    def abort(self, messages) -> None:
        fs, staging = self._staging()
        if fs.get_file_info(staging).type != pafs.FileType.NotFound:
            fs.delete_dir(staging)


class NamedFiles(DataSource):
    """``file_name string, rows int, line binary``; options ``path`` and ``job``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "file_name string, rows int, line binary"

    def writer(self, schema, overwrite) -> NamedFileWriter:
        return NamedFileWriter(self.options["path"], self.options["job"])


def read_log(spark: SparkSession, path: str, job: str = "*") -> DataFrame:
    """file_name, rows and bytes of every file that a job has published."""
    return spark.read.schema(LOG_SCHEMA).json(f"{path.rstrip('/')}/{LOG}/{job}.json")


def write_named(df: DataFrame, path: str, line: Column, order: list[str], header: bytes | None = None, names: DataFrame | None = None,
                job: str | None = None) -> DataFrame:
    """Write the ``line`` (binary, line end included) of every row to the file ``path``/``file_name``, in ``order`` (total within a
    name), each after ``header``; return the log.

    ``names`` lists files that must exist without rows too.
    """
    spark = df.sparkSession
    workers_import(spark)
    spark.dataSource.register(NamedFiles)
    job = job or uuid.uuid4().hex
    lines = df.select("file_name", F.lit(1).alias("rows"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], line.alias("line"))
    if header is not None or names is not None:
        listed = df.select("file_name") if names is None else names.select("file_name").unionByName(df.select("file_name"))
        first = listed.distinct().select("file_name", F.lit(0).alias("rows"), F.lit(bytearray(header or b"")).alias("line"))
        lines = lines.unionByName(first, allowMissingColumns=True)
    placed = lines.repartition("file_name").sortWithinPartitions("file_name", "rows", *[f"_o{i}" for i in range(len(order))])
    placed.select("file_name", "rows", "line").write.format(FORMAT).option("job", job).mode("append").save(path)
    return read_log(spark, path, job)
