"""Many small text files, one for each name, written and read from the tasks.

Spark's own writer opens, checks and renames a folder for every value that it partitions
by, and on some file systems starts a process for each; that takes tens of milliseconds a
file. Here a task writes its files to folders of its own, staged and moved into place as a whole
once all tasks are done. A task that fails, or is lost and runs again, leaves nothing behind.

Spark's binary file source lists all files on the driver and takes most of a millisecond to
open one; ``read_folders`` hands out the folders, which the tasks list and read. A folder
holds ``FOLDER_FILES`` files, so that there are folders for many tasks.

The folder must be on a file system that Arrow reaches from the executors by its URI and
that can rename a folder.
"""

from __future__ import annotations

import sys
import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from packetloom.sources import folders

# Workers get the classes below with the plan and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "packetloom_small_files"
FOLDER_FILES = 1024
# What a batch of read files holds: so many of them, so many bytes and one more file.
BATCH_FILES, BATCH_BYTES = 1024, 4 << 20


@dataclass
class Folder(WriterCommitMessage):
    """The staged folder of a task, None where it had no rows."""

    staged: str | None
    part: int


def _place(path):
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


class SmallFilesWriter(DataSourceArrowWriter):
    """Rows (name, line); rows of a name stand next to each other."""

    def __init__(self, path, run):
        self.path, self.run = path, run

    def _staged(self, root):
        return f"{root}/.staged-{self.run}"

    def write(self, iterator):
        system, root = _place(self.path)
        task = TaskContext.get()
        folder = f"{self._staged(root)}/{task.partitionId()}-{task.taskAttemptId()}"
        name, out, made = None, None, 0
        try:
            for batch in iterator:
                for file, line in zip(*(column.to_pylist() for column in batch.columns)):
                    if file != name:
                        if out:
                            out.close()
                        inner = f"{folder}/{made // FOLDER_FILES}"
                        if made % FOLDER_FILES == 0:
                            system.create_dir(inner, recursive=True)
                        name, out, made = file, system.open_output_stream(f"{inner}/part-{file}.txt"), made + 1
                    out.write(line.encode() + b"\n")
        finally:
            if out:
                out.close()
        return Folder(folder if out else None, task.partitionId())

    def commit(self, messages):
        system, root = _place(self.path)
        system.create_dir(root, recursive=True)
        for message in messages:
            if message and message.staged:
                system.move(message.staged, f"{root}/{message.part}")
        self._clear(system, root)

    def abort(self, messages):
        self._clear(*_place(self.path))

    def _clear(self, system, root):
        if system.get_file_info(self._staged(root)).type == fs.FileType.Directory:
            system.delete_dir(self._staged(root))


class SmallFiles(DataSource):
    """For writing only; option: path."""

    @classmethod
    def name(cls):
        return FORMAT

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("the folder must be new")
        return SmallFilesWriter(self.options["path"], uuid.uuid4().hex)


def write_small_files(df: DataFrame, path: str, name: str, line: str) -> str:
    """Writes each name's lines to ``{path}/{task}/{k}/part-{name}.txt``; gives the glob of the folders.

    A name with rows in several tasks has a file of each; names must suit a file name.
    Neither column may be null.
    """
    spark = df.sparkSession
    spark.dataSource.register(SmallFiles)
    rows = df.select(F.col(name).cast("string").alias("name"), F.col(line).cast("string").alias("line"))
    rows.sortWithinPartitions("name").write.format(FORMAT).option("path", path).mode("append").save()
    return f"{path}/*/*"


def _read(limit, contents):
    """(uri, folder) -> the files of the folders, as Spark's binary file source has them."""

    def batch(rows):
        columns = list(zip(*rows))
        kinds = [pa.string(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["path", "length", "content"])

    def run(batches):
        held, size = [], 0
        for given in batches:
            for uri, folder in zip(*(column.to_pylist() for column in given.columns)):
                system, root = _place(uri)
                for file in system.get_file_info(fs.FileSelector(root)):
                    if file.type != fs.FileType.File or file.base_name[0] in "._" or not file.size:
                        continue
                    if limit is not None and file.size > limit:
                        continue
                    data = None
                    if contents:
                        with system.open_input_stream(file.path) as stream:
                            data = stream.read()
                        size += len(data)
                    held.append((f"{folder}/{file.base_name}", file.size, data))
                    if len(held) >= BATCH_FILES or size >= BATCH_BYTES:
                        yield batch(held)
                        held, size = [], 0
        if held:
            yield batch(held)

    return run


def read_folders(spark, path: str, tasks: int, limit: int | None = None, contents: bool = True) -> DataFrame:
    """The files of the folders that match a glob, as (path, length, content), read in ``tasks`` tasks.

    Empty files and those whose name begins with a dot or a line are left out, files over
    ``limit`` bytes are not opened; folders inside the folders are not looked into. Without
    ``contents`` no file is opened and ``content`` is null.
    """
    rows = spark.sparkContext.parallelize(folders.matching(spark, path), tasks)
    given = spark.createDataFrame(rows, "uri string, folder string")
    return given.mapInArrow(_read(limit, contents), "path string, length bigint, content binary")
