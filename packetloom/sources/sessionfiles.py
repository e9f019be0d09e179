"""One CSV file per session, with one header, at the session's path.

A Spark data source for writing: every task writes whole sessions, one after the other, to
files under a staging folder, and the driver moves them into place once all tasks are done.
A task that fails, or is lost and runs again, leaves nothing behind. A session that has a
file already gets its new lines behind the old ones, without a second header.

The folder must be on a file system that Arrow reaches from the executors by its URI.
"""

from __future__ import annotations

import csv
import io
import sys
import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

# Workers get the classes below with the plan and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "packetloom_sessions"
FILE = "session_file"
_PIECE = 1 << 20


@dataclass
class Written(WriterCommitMessage):
    """Staged files of a task and the session files that they become."""

    files: list


def _place(path):
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _line(values):
    out = io.StringIO()
    csv.writer(out).writerow(values)
    return out.getvalue().encode()


class SessionWriter(DataSourceArrowWriter):
    """Rows (session_file, the header's columns), each session whole in one task."""

    def __init__(self, path, header, run):
        self.path, self.header, self.run = path, header, run

    def _staged(self, root):
        return f"{root}/.staged-{self.run}"

    def write(self, iterator):
        system, root = _place(self.path)
        task = TaskContext.get()
        folder = f"{self._staged(root)}/{task.partitionId()}-{task.taskAttemptId()}"
        done, name, out = [], None, None
        try:
            for batch in iterator:
                names = batch.column(0).to_pylist()
                columns = [batch.column(k + 1).to_pylist() for k in range(len(self.header))]
                for file, *values in zip(names, *columns):
                    if file != name:
                        if out:
                            out.close()
                        name, staged = file, f"{folder}/{len(done)}"
                        done.append((staged, file))
                        out = self._begin(system, root, staged, file)
                    out.write(_line(["" if v is None else v for v in values]))
        finally:
            if out:
                out.close()
        return Written(done)

    def _begin(self, system, root, staged, file):
        """A staged file that begins with what the session's file holds, else with the header."""
        system.create_dir(staged.rpartition("/")[0], recursive=True)
        out = system.open_output_stream(staged)
        if system.get_file_info(f"{root}/{file}").type == fs.FileType.File:
            with system.open_input_stream(f"{root}/{file}") as old:
                while piece := old.read(_PIECE):
                    out.write(piece)
        else:
            out.write(_line(self.header))
        return out

    def commit(self, messages):
        system, root = _place(self.path)
        files = [f for m in messages if m for f in m.files]
        if len({name for _, name in files}) < len(files):
            self.abort(messages)
            raise ValueError("rows of one session came from several tasks")
        for staged, name in files:
            system.create_dir(f"{root}/{name}".rpartition("/")[0], recursive=True)
            system.move(staged, f"{root}/{name}")
        self._clear(system, root)

    def abort(self, messages):
        self._clear(*_place(self.path))

    def _clear(self, system, root):
        if system.get_file_info(self._staged(root)).type == fs.FileType.Directory:
            system.delete_dir(self._staged(root))


class SessionFiles(DataSource):
    """For writing only; options: path, header (names joined by commas)."""

    @classmethod
    def name(cls):
        return FORMAT

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("session files are appended to")
        return SessionWriter(self.options["path"], self.options["header"].split(","), uuid.uuid4().hex)


def write_session_files(df: DataFrame, path: str, header, order) -> None:
    """Writes ``df`` (with ``session_file``, see ``exports.session_columns``) under ``path``.

    Lines of a session are in the order of ``order``. Columns of ``header`` that ``df`` lacks
    stay empty, others are left out, as are rows without a session. A session is written by
    one task, line by line; an empty frame writes nothing.
    """
    spark = df.sparkSession
    spark.dataSource.register(SessionFiles)
    order = [order] if isinstance(order, str) else list(order)
    have = df.columns
    kept = {f"_o{k}": F.col(c) for k, c in enumerate(order)}
    kept |= {f"_h{k}": (F.col(c) if c in have else F.lit(None)).cast("string") for k, c in enumerate(header)}
    rows = df.where(F.col(FILE).isNotNull()).select(F.col(FILE), *(c.alias(n) for n, c in kept.items()))
    dealt = rows.repartition(FILE).sortWithinPartitions(FILE, *(f"_o{k}" for k in range(len(order))))
    out = dealt.select(FILE, *(f"_h{k}" for k in range(len(header))))
    out.write.format(FORMAT).option("path", path).option("header", ",".join(header)).mode("append").save()
