"""A stored log as a stream whose intake is limited in rows.

Spark's file stream takes whole files. This source reads the same folders of Parquet files
and admits ``rows`` rows to a micro-batch, cutting files where that many are reached: the
driver lists files and reads their footers, the executors read the row ranges. Files are
taken in the order in which they appeared; that order, and the place up to which rows were
admitted, lie in the ``progress`` folder, so a query that restarts goes on from there. Rows
that Spark had not taken when it stopped come with the next micro-batch, none twice.

With ``availableNow`` a run takes one such micro-batch; with a processing time they follow
each other. The folders must be on a file system that Arrow reaches from the executors.
"""

from __future__ import annotations

import json
import sys
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

# Workers get the classes below with the plan and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "packetloom_log"
POLL_ROWS = 100
# Rows of one input partition.
SLICE = 100_000


def _place(path):
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


@dataclass
class Rows(InputPartition):
    """Rows ``first``..``last - 1`` of a file."""

    path: str
    first: int
    last: int


class LogReader(DataSourceStreamReader):
    def __init__(self, path, progress, rows, schema):
        self.path, self.progress, self.rows, self.schema = path, progress, rows, schema
        self.sizes = {}

    def initialOffset(self):
        return {"file": 0, "row": 0}

    def _kept(self, name, empty):
        system, root = _place(self.progress)
        place = f"{root}/{name}.json"
        if system.get_file_info(place).type != fs.FileType.File:
            return empty
        with system.open_input_stream(place) as file:
            return json.loads(file.read())

    def _keep(self, name, value):
        system, root = _place(self.progress)
        system.create_dir(root, recursive=True)
        with system.open_output_stream(f"{root}/{name}.new") as file:
            file.write(json.dumps(value).encode())
        system.move(f"{root}/{name}.new", f"{root}/{name}.json")

    def _files(self):
        """Every file seen so far, in a fixed order; files that are new come last."""
        known = self._kept("files", [])
        system, root = _place(self.path)
        found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        there = sorted(
            (f.mtime_ns or 0, f.path[len(root) + 1 :]) for f in found
            if f.type == fs.FileType.File and f.path.endswith(".parquet") and not any(p[:1] in "._" for p in f.path[len(root) + 1 :].split("/"))
        )
        seen = set(known)
        new = [name for _, name in there if name not in seen]
        if new:
            known += new
            self._keep("files", known)
        return known

    def _size(self, name):
        if name not in self.sizes:
            system, root = _place(self.path)
            with system.open_input_file(f"{root}/{name}") as file:
                self.sizes[name] = pq.read_metadata(file).num_rows
        return self.sizes[name]

    def latestOffset(self):
        at = self._kept("admitted", self.initialOffset())
        files, file, row, room = self._files(), at["file"], at["row"], self.rows
        while file < len(files) and room:
            left = self._size(files[file]) - row
            taken = min(left, room)
            room, row = room - taken, row + taken
            if taken == left:
                file, row = file + 1, 0
        now = {"file": file, "row": row}
        if now != at:
            self._keep("admitted", now)
        return now

    def partitions(self, start, end):
        files, out = self._kept("files", []), []
        for k in range(start["file"], end["file"] + 1):
            if k == len(files):
                break
            first = start["row"] if k == start["file"] else 0
            last = end["row"] if k == end["file"] else self._size(files[k])
            out += [Rows(files[k], a, min(a + SLICE, last)) for a in range(first, last, SLICE)]
        return out

    def read(self, partition):
        system, root = _place(self.path)
        wanted = to_arrow_schema(self.schema)
        with system.open_input_file(f"{root}/{partition.path}") as source:
            file, begin = pq.ParquetFile(source), 0
            held = set(file.schema_arrow.names)
            for group in range(file.num_row_groups):
                n = file.metadata.row_group(group).num_rows
                a, b = max(partition.first - begin, 0), min(partition.last - begin, n)
                begin += n
                if a >= b:
                    continue
                table = file.read_row_group(group, columns=[f.name for f in wanted if f.name in held]).slice(a, b - a)
                columns = [table[f.name].cast(f.type) if f.name in held else pa.nulls(b - a, f.type) for f in wanted]
                yield from pa.table(columns, schema=wanted).to_batches()

    def commit(self, end):
        pass


class LogSource(DataSource):
    """Options: path, progress, rows."""

    @classmethod
    def name(cls):
        return FORMAT

    def streamReader(self, schema):
        return LogReader(self.options["path"], self.options["progress"], int(self.options.get("rows", POLL_ROWS)), schema)


def read_admitted(spark, path: str, schema, progress: str, rows: int = POLL_ROWS) -> DataFrame:
    """The Parquet files under ``path`` as a stream of ``rows`` rows to a micro-batch.

    ``schema`` names the columns of the files (not those in folder names); one that a file
    lacks is null. ``progress`` belongs to one query, like its checkpoint.
    """
    spark.dataSource.register(LogSource)
    reader = spark.readStream.format(FORMAT).schema(schema).option("path", path)
    return reader.option("progress", progress).option("rows", str(rows)).load()
