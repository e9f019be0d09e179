import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql.types import StructType

from packetloom.session import shared_folder
from packetloom.sources import logstream
from packetloom.streaming import runs, stateful

SCHEMA = "n bigint, more string"


class _Files:
    """Parquet files with numbers that go on from file to file."""

    def __init__(self, folder):
        self.folder, self.next, self.made = folder, 0, 0

    def add(self, n, groups=3, sub=""):
        os.makedirs(self.folder / sub, exist_ok=True)
        path = self.folder / sub / f"part-{99 - self.made:02d}.parquet"
        pq.write_table(pa.table({"n": pa.array(range(self.next, self.next + n), pa.int32())}), path, row_group_size=groups)
        os.utime(path, (1_000_000 + self.made, 1_000_000 + self.made))
        self.next, self.made = self.next + n, self.made + 1


def _reader(files, tmp_path, rows):
    return logstream.LogReader(str(files.folder), str(tmp_path / "progress"), rows, StructType.fromDDL(SCHEMA))


def _numbers(reader, start, end):
    return [n for p in reader.partitions(start, end) for b in reader.read(p) for n in b.column("n").to_pylist()]


@pytest.mark.parametrize("rows", [1, 4, 7, 1000])
def test_batches_cut_files(spark, tmp_path, monkeypatch, rows):
    monkeypatch.setattr(logstream, "SLICE", 5)
    files = _Files(tmp_path / "log")
    for n in (10, 0, 3, 8):
        files.add(n, sub="log_date=2024-01-01")
    (files.folder / "_SUCCESS").touch()
    (files.folder / "_temporary").mkdir()
    pq.write_table(pa.table({"n": [99]}), files.folder / "_temporary" / "x.parquet")
    at, seen = _reader(files, tmp_path, rows).initialOffset(), []
    while True:
        reader = _reader(files, tmp_path, rows)  # a restart before every batch
        now = reader.latestOffset()
        if now == at:
            if files.made == 5:
                break
            files.add(6)
            continue
        batch = _numbers(reader, at, now)
        assert 0 < len(batch) <= rows
        assert batch == _numbers(_reader(files, tmp_path, rows), at, now)  # a batch that runs again
        seen, at = seen + batch, now
    assert seen == list(range(27))


def test_missing_columns_and_kinds(spark, tmp_path):
    files = _Files(tmp_path / "log")
    files.add(2)
    reader = _reader(files, tmp_path, 10)
    [batch] = [b for p in reader.partitions(reader.initialOffset(), reader.latestOffset()) for b in reader.read(p)]
    assert batch.to_pydict() == {"n": [0, 1], "more": [None, None]} and batch.schema.types == [pa.int64(), pa.string()]


def test_nothing_there(spark, tmp_path):
    reader = logstream.LogReader(str(tmp_path / "none"), str(tmp_path / "progress"), 10, StructType.fromDDL(SCHEMA))
    assert reader.latestOffset() == reader.initialOffset() and reader.partitions({"file": 0, "row": 0}, {"file": 0, "row": 0}) == []


def test_a_query_that_fails_takes_its_rows_again(spark, tmp_path):
    files = _Files(tmp_path / "log")
    files.add(25)
    out, checkpoint = shared_folder(spark, "out"), shared_folder(spark, "cp")

    def run(fn):
        stream = logstream.read_admitted(spark, str(files.folder), SCHEMA, str(tmp_path / "progress"), 10)
        runs.start(stream, fn, checkpoint).awaitTermination()

    def broken(batch, batch_id):
        raise OSError("sink away")

    run(stateful.to_folder(out))
    with pytest.raises(Exception, match="sink away"):
        run(broken)
    for _ in range(3):
        run(stateful.to_folder(out))
    found = spark.read.parquet(out).collect()
    assert sorted(r.n for r in found) == list(range(25))
    assert sorted(r.batch_id for r in found) == [0] * 10 + [1] * 10 + [2] * 5
