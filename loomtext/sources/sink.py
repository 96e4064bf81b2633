"""JSON-lines output: Spark's own writer, or files of bounded size with the names readers of such extracts expect."""

from __future__ import annotations

import bz2
import contextlib
import os
import shutil
import sys
import uuid
from concurrent.futures import ThreadPoolExecutor
from typing import TextIO

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from ..operators import splitting
from ..operators.splitting import FILES_PER_FOLDER
from .scratch import removed, written

#: Bytes of files that one task of an ordered output writes.
TASK_BYTES = 256 << 20
#: Files that are moved to their names at a time.
MOVES = 16


def write_json(df: DataFrame, path: str, compress: bool = False) -> None:
    """One object a row; empty strings, empty arrays and nulls are written."""
    df.write.option("ignoreNullFields", False).option("compression", "bzip2" if compress else "none").json(path)


def file_name(n: int) -> str:
    """AA/wiki_00, AA/wiki_01, .. AA/wiki_99, AB/wiki_00, .. ZZ/wiki_99, BAA/wiki_00, .."""
    folder, letters = n // FILES_PER_FOLDER, ""
    while folder or len(letters) < 2:
        folder, letter = divmod(folder, 26)
        letters = chr(65 + letter) + letters
    return f"{letters}/wiki_{n % FILES_PER_FOLDER:02d}"


class SplitWriter(DataSourceWriter):
    """Each task fills files one after the other; a line that doesn't fit opens the next. A task writes to a folder of
    its attempt, which is moved to its place when all tasks are done, so a lost task leaves nothing behind."""

    def __init__(self, options: dict) -> None:
        self.path, self.most = options["path"], int(options.get("maxbytes", 1 << 20))
        self.compress = options.get("compress") == "true"
        self.work = os.path.join(self.path, "_temporary", options.get("job") or uuid.uuid4().hex)  # a parallel job has its own

    def write(self, rows):
        from pyspark import TaskContext

        context = TaskContext.get()
        task = f"task-{context.partitionId():05d}"
        place = os.path.join(self.work, f"{task}.{context.taskAttemptId()}")
        file, size, n = None, 0, 0
        for row in rows:
            line = (row[0] + "\n").encode()
            if file is None or size + len(line) > self.most:
                if file:
                    file.close()
                name = os.path.join(place, file_name(n)) + (".bz2" if self.compress else "")
                os.makedirs(os.path.dirname(name), exist_ok=True)
                file, size, n = (bz2.open if self.compress else open)(name, "wb"), 0, n + 1
            file.write(line)
            size += len(line)
        if file:
            file.close()
        message = WriterCommitMessage()
        message.place, message.task, message.files = place, task, n
        return message

    def commit(self, messages) -> None:
        """Files to their names, those of a task in its folder."""
        end = ".bz2" if self.compress else ""
        for m in (m for m in messages if m and m.files):
            for n in range(m.files):
                target = os.path.join(self.path, m.task, file_name(n) + end)
                os.makedirs(os.path.dirname(target), exist_ok=True)
                os.replace(os.path.join(m.place, file_name(n) + end), target)
        self.abort(messages)

    def abort(self, messages) -> None:
        shutil.rmtree(self.work, ignore_errors=True)
        with contextlib.suppress(OSError):  # other jobs are at work in it
            os.rmdir(os.path.dirname(self.work))


class SplitSource(DataSource):
    """format("splitjson"): a column of JSON lines to a folder on storage that all executors mount."""

    @classmethod
    def name(cls) -> str:
        return "splitjson"

    def writer(self, schema, overwrite):
        return SplitWriter(dict(self.options))


def write_split(spark: SparkSession, df: DataFrame, path: str, max_bytes: int = 1 << 20, compress: bool = False, order: str | list[str] | None = None) -> None:
    """df as JSON lines in files of at most max_bytes before compression (a longer line has a file of its own). With
    `order` the rows are in that order across the files, which have the plain names and are the files that a single writer
    would make; else each task fills files of its own, in a folder of its own, on storage that all executors mount."""
    order = [order] if isinstance(order, str) else order or []
    value = F.to_json(F.struct(*[c for c in df.columns if c not in order]), {"ignoreNullFields": "false"}).alias("value")
    if order:
        return write_ordered(df.select(F.struct(*order).alias("key"), value), path, max_bytes, compress)
    spark.dataSource.register(SplitSource)
    df.select(value).write.format("splitjson").option("path", path).option("maxbytes", max_bytes).option("compress", str(compress).lower()).option("job", uuid.uuid4().hex).mode("append").save()


def write_ordered(lines: DataFrame, path: str, max_bytes: int, compress: bool = False, block_bytes: int | None = None) -> None:
    """Lines (key, value) in the order of key, by Spark's own writer on any file system: a line's file is worked out from
    sizes alone, then all files are written at once and moved to their names. The lines are made once and written between."""
    held = written(lines.withColumn("n", F.monotonically_increasing_id()), "lines")
    numbers = splitting.file_numbers(held.select("key", "n", (F.octet_length("value") + 1).alias("size")), max_bytes, block_bytes)
    files = (numbers.agg(F.max("file")).first()[0] or 0) + 1
    named = held.join(numbers, "n").withColumns({"folder": splitting.folder_name("file"), "name": splitting.base_name("file")})
    dealt = named.repartition(max(1, -(-files * max_bytes // TASK_BYTES), min(files, held.sparkSession.sparkContext.defaultParallelism)), "file")
    staging = f"{path}/_temporary/{uuid.uuid4().hex}"
    out = dealt.sortWithinPartitions("folder", "name", "start").select("value", "folder", "name")
    out.write.partitionBy("folder", "name").option("maxRecordsPerFile", 0).option("compression", "bzip2" if compress else "none").text(staging)
    move_files(held.sparkSession, staging, path, ".bz2" if compress else "")
    removed(held, numbers)


def move_files(spark: SparkSession, staging: str, path: str, end: str) -> None:
    """The one file of each folder=../name=.. to path/folder/name; then staging goes, with the folder above it if that is
    empty. Files of the same name are replaced. Only names pass through the driver, as when Spark commits a job."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    system = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def move(named) -> None:
        for found in system.listStatus(named):
            if found.getPath().getName().startswith("part-"):
                target = hadoop.Path(f"{path}/{named.getParent().getName().partition('=')[2]}/{named.getName().partition('=')[2]}{end}")
                system.mkdirs(target.getParent())
                system.delete(target, False)
                if not system.rename(found.getPath(), target):
                    raise OSError(f"not moved: {found.getPath()} to {target}")

    with ThreadPoolExecutor(MOVES) as pool:
        for folder in system.listStatus(hadoop.Path(staging)):
            if folder.getPath().getName().startswith("folder="):
                list(pool.map(move, [f.getPath() for f in system.listStatus(folder.getPath())]))
    system.delete(hadoop.Path(staging), True)
    above = hadoop.Path(staging).getParent()
    if not len(system.listStatus(above)):
        system.delete(above, False)


def print_json(df: DataFrame, out: TextIO | None = None) -> int:
    """One object a line to a stream, a partition at a time; how many there were."""
    n = 0
    columns = [F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")]
    for n, row in enumerate(df.select(*columns).toLocalIterator(prefetchPartitions=True), 1):
        print(row["value"], file=out or sys.stdout)
    return n
