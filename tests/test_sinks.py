import gzip
import json

import pytest
from pyspark.sql import functions as F

from packetloom.operators import streamlog
from packetloom.session import shared_folder
from packetloom.sources import exports, folders, smallfiles, stores, topics


def folder(spark, name):
    return shared_folder(spark, name)


def rows(spark, data):
    df = spark.createDataFrame(data, "stream_key string, message_id string, value string, arrival bigint")
    return streamlog.stream_table_rows(df.withColumn("ingest_second", F.lit(0).cast("bigint"))).select(
        "stream_key", "message_id", "value", "arrival", "unix_timestamp", "streaming_date"
    )


@pytest.mark.parametrize("overwrite, want", [(False, {"v1", "w1", "n"}), (True, {"v2", "w1", "n"})])
def test_stream_table(spark, overwrite, want):
    path = folder(spark, "table")
    day = 86_400_000
    first = rows(spark, [("s", "1640995200000-0", "v1", 1), ("s", f"{1640995200000 + day}-0", "w1", 2)])
    second = rows(spark, [("s", "1640995200000-0", "v2", 3), ("s", "1640995200001-0", "n", 4)])
    stores.write_stream_table(first, path, overwrite)
    for _ in range(2):  # a batch that runs again changes nothing
        stores.write_stream_table(second, path, overwrite)
        got = spark.read.parquet(path)
        assert {r.value for r in got.collect()} == want and got.count() == 3
    assert {str(r.streaming_date) for r in got.collect()} == {"2022-01-01", "2022-01-02"}


def test_left_overs_are_not_a_table(spark, tmp_path):
    path = tmp_path / "table"
    (path / "_temporary" / "0").mkdir(parents=True)
    assert not stores.exists(spark, str(path)) and not stores.exists(spark, str(tmp_path / "none"))
    stores.write_stream_table(rows(spark, [("s", "1640995200000-0", "v1", 1)]), str(path))
    assert stores.exists(spark, str(path)) and spark.read.parquet(str(path)).count() == 1


def test_kv_table(spark):
    path = folder(spark, "kv")
    schema = "redis_db int, redis_key string, redis_value string, arrival bigint"
    stores.write_kv_table(spark.createDataFrame([(0, "a", "1", 1), (1, "a", "x", 1)], schema), path)
    stores.write_kv_table(spark.createDataFrame([(0, "a", None, 2), (0, "b", "2", 3)], schema), path)
    got = {(r.redis_db, r.redis_key): r.redis_value for r in spark.read.parquet(path).collect()}
    assert got == {(0, "a"): "", (0, "b"): "2", (1, "a"): "x"}


def test_log_scan_prunes_dates(spark):
    path = folder(spark, "log")
    day = 86_400_000
    df = spark.range(10).select(
        F.lit("s").alias("stream_key"), (F.col("id") * day).alias("id_ms"), F.lit(0).alias("id_seq"),
        F.lit("ecg").alias("characteristic"),
    )
    stores.append_log(df, path)
    out = stores.read_log(spark, path, 3 * day, 5 * day, key="s", char="ecg")
    assert sorted(r.id_ms // day for r in out.collect()) == [3, 4, 5]
    plan = out._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "log_date" in filters
    assert "GreaterThanOrEqual(id_ms" in plan


def test_provision(spark):
    for _ in range(2):
        names = stores.provision(spark, "telemetry")
    assert all(spark.catalog.tableExists(n) for n in names)


def test_written_rows_show_in_the_catalog(spark):
    base = folder(spark, "warehouse")
    name, _ = stores.provision(spark, "telemetry2", folder=base)
    raw = spark.createDataFrame(
        [("s", "1640995200000-0", {"value": "7", "uid": "u"}, 1)],
        "stream_key string, message_id string, data map<string,string>, arrival bigint",
    ).withColumn("ingest_second", F.lit(0).cast("bigint"))
    stores.write_stream_table(stores.table_rows(streamlog.stream_table_rows(raw)), f"{base}/stream_messages")
    stores.refresh(spark, name)
    row = spark.table(name).first()
    assert json.loads(row.data) == {"value": "7", "uid": "u"}
    assert (row.stream_key, str(row.streaming_date)) == ("s", "2022-01-01")


def test_pressure_csv(spark):
    path = folder(spark, "csv")
    df = spark.createDataFrame(
        [("1234567890", 1, 50, 0, [1, 2, 3, 4], "1620000000000", "AA:BB", 1_620_000_000_000)],
        "timestamp string, counter int, read int, trigger int, pressure array<int>, timestamp_python string, address string, start_ms bigint",
    )
    named = exports.session_columns(exports.pressure_csv_rows(df), "pressure", "address", "start_ms")
    assert named.first().session_file == "sessions/AABB/2021-05-03_00-00-00/pressure_AABB_1620000000000.csv"
    exports.write_session_csv(named, path, exports.PRESSURE_HEADER)
    files = spark.read.text(path + "/session_address=AABB").collect()
    lines = [r.value for r in files]
    assert lines == [",".join(exports.PRESSURE_HEADER), '1620000000000,1234567890,1,50,0,"1, 2, 3, 4"']
    with pytest.raises(ValueError):
        exports.session_columns(df, "audio", "address", "start_ms")


def test_fixed_header_and_empty(spark):
    path = folder(spark, "csv")
    df = spark.createDataFrame([(1, 2, "x", "b")], "packet_counter int, timestamp_python int, extra string, bucket string")
    shaped = exports.with_header(df, exports.IMU_HEADER)
    assert shaped.columns == exports.IMU_HEADER and shaped.first().ts_board is None
    exports.write_session_csv(df.where("false"), path, exports.IMU_HEADER, by=("bucket",))
    assert not stores.exists(spark, path) or spark.read.text(path).count() == 0


def test_json(spark, tmp_path):
    path = str(tmp_path / "json")
    exports.write_compressed_json(spark.createDataFrame([(1, [1, 2])], "a int, b array<int>"), path)
    files = list((tmp_path / "json").glob("*.json.gz"))
    assert b"".join(gzip.decompress(f.read_bytes()) for f in files) == b'{"a":1,"b":[1,2]}\n'
    body = spark.createDataFrame([([1, 2],)], "v array<int>").select(exports.json_body("v").alias("j"))
    assert body.first().j == '{"data":[1,2]}'


def test_binary_files(spark, tmp_path):
    for name, size in (("empty.bin", 0), ("good.bin", 10), ("large.bin", 11)):
        (tmp_path / name).write_bytes(b"x" * size)
    got = {r.name: r.verdict for r in topics.read_files(spark, str(tmp_path), limit=10).collect()}
    assert got == {"good.bin": "ok", "large.bin": "too_large"}
    sent = topics.file_messages(spark, str(tmp_path), "t", 1_700_000_000, limit=10).collect()
    assert [(r.key, bytes(r.value)) for r in sent] == [("file:good.bin:1700000000", b"x" * 10)]
    keyed = topics.file_messages(spark, str(tmp_path), "t", 5, device="mat", limit=10)
    assert keyed.first().key == "mat:good.bin:5"


def test_topic_frame(spark):
    df = spark.createDataFrame([("t", "k", "v", 1)], "topic string, key string, value string, extra int")
    out = topics.topic_frame(df)
    assert [f.dataType.simpleString() for f in out.schema] == ["string", "binary", "binary"]


def test_delivery_reports_each_message(spark):
    df = spark.range(20).select(F.lit("s").alias("stream_key"), F.col("id").cast("string").alias("message_id"))

    def open_writer():
        def send(row):
            if row["message_id"] == "3":
                raise OSError("broker away")
            return int(row["message_id"]) % 2 == 1

        return send

    got = {r.message_id: (r.success, r.error) for r in topics.deliver(df, open_writer, tasks=2).collect()}
    assert len(got) == 20 and got["3"] == (False, "broker away")
    assert all(got[str(i)][0] == (i % 2 == 1 and i != 3) for i in range(20))


def test_transform_messages(spark):
    df = spark.createDataFrame([("k", "test-message"), ("bad", "!"), ("none", None)], "key string, value string")

    def work(value):
        if value == b"!":
            raise ValueError("no")
        return b"PROCESSED:" + value

    got = {r.key: (None if r.result is None else bytes(r.result), r.error) for r in topics.transform_messages(df, work).collect()}
    assert got == {"k": (b"PROCESSED:test-message", None), "bad": (None, "no"), "none": (None, None)}


def test_many_at_once_keeps_ids_and_order(spark):
    rows = [(9007199254740993, 1), (None, 2), (3, 3), (4, 4), (5, 5)]
    df = spark.createDataFrame(rows, "message_id bigint, n int").coalesce(1)
    asked = spark.sparkContext.accumulator(0)

    def open_writer():
        def send_many(batch):
            asked.add(len(batch) > 2)
            return [ValueError("no") if r["n"] == 3 else r["n"] != 4 for r in batch]

        return send_many

    got = [tuple(r) for r in topics.deliver(df, open_writer, ids=["message_id"], in_flight=2).collect()]
    assert got == [(9007199254740993, True, None), (None, True, None), (3, False, "no"), (4, False, None), (5, True, None)]
    assert asked.value == 0
    short = topics.deliver(df, lambda: lambda batch: [], ids=["message_id"], in_flight=2)
    assert {r.success for r in short.collect()} == {False}


def test_one_changed_key_rewrites_one_bucket(spark, tmp_path):
    path = str(tmp_path / "kv")
    rows = [(db, f"k{k}", "v", 1) for db in (0, 1) for k in range(50)]
    schema = "redis_db int, redis_key string, redis_value string, arrival bigint"
    stores.write_kv_table(spark.createDataFrame(rows, schema), path, buckets=8)

    def files():
        return {str(p) for p in (tmp_path / "kv").rglob("*.parquet")}

    before = files()
    stores.write_kv_table(spark.createDataFrame([(0, "k7", "new", 2)], schema), path, buckets=8)
    gone = before - files()
    assert len({p.rsplit("/", 1)[0] for p in gone}) == 1
    found = {(r.redis_db, r.redis_key): r.redis_value for r in spark.read.parquet(path).collect()}
    assert len(found) == 100 and found[0, "k7"] == "new" and found[1, "k7"] == "v"


def test_small_files_one_for_each_name(spark):
    """No folder for each file, a bounded number of reading tasks, and the bytes that went in."""
    path = folder(spark, "small")
    rows = [(k, "é\n" * (k % 3)) for k in range(60)] + [(7, "again")]
    df = spark.createDataFrame(rows, "id bigint, text string").repartition(1)
    where = smallfiles.write_small_files(df, path, "id", "text")
    got = {r.key.split(":")[1]: bytes(r.value) for r in topics.file_messages(spark, where, "t", 5, tasks=2).collect()}
    want = {f"part-{k}.txt": f"{t}\n".encode() for k, t in rows[:60]}
    want["part-7.txt"] += b"again\n"
    assert got.keys() == want.keys() and all(sorted(got[k].split(b"\n")) == sorted(want[k].split(b"\n")) for k in want)
    assert topics.read_files(spark, where, tasks=2).rdd.getNumPartitions() == 2
    assert folders.children(spark, path) == ["0"]
    nothing = smallfiles.write_small_files(df.where("id < 0"), folder(spark, "none"), "id", "text")
    assert not nothing.startswith(path)


def test_folders_of_small_files_are_read_in_the_tasks(spark, tmp_path, monkeypatch):
    """Several folders of a writing task, read as Spark's own source reads them, without its list of files."""
    monkeypatch.setattr(smallfiles, "FOLDER_FILES", 4)
    monkeypatch.setattr(smallfiles, "BATCH_BYTES", 10)
    path = folder(spark, "small")
    rows = [(k, "x" * k) for k in range(10)]
    where = smallfiles.write_small_files(spark.createDataFrame(rows, "id bigint, text string").repartition(1), path, "id", "text")
    assert folders.children(spark, f"{path}/0") == ["0", "1", "2"]

    def plain(df):
        return sorted((r.key, bytes(r.value)) for r in df.collect())

    many = topics.file_messages(spark, where, "t", 5, limit=8, tasks=3)
    assert many.rdd.getNumPartitions() == 3 and not many.inputFiles()
    assert plain(many) == plain(topics.file_messages(spark, where, "t", 5, limit=8)) and many.count() == 8
    for name, size in (("empty.bin", 0), ("_hidden", 3), (".dot", 3), ("a b%20.bin", 3), ("large.bin", 4)):
        (tmp_path / name).write_bytes(b"x" * size)
    odd = [topics.read_files(spark, str(tmp_path), limit=3, tasks=n).collect() for n in (None, 2)]
    assert sorted(map(tuple, odd[0])) == sorted(map(tuple, odd[1])) and len(odd[0]) == 2
    assert topics.read_files(spark, f"{tmp_path}/none/*", tasks=2).count() == 0
