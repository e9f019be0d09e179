"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_made: list[str] = []
_setting = threading.RLock()
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ARROW_BYTES = 8 << 20
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(app="packetloom", cpus="8", shuffle_partitions="8", **conf):
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.adaptive.enabled", "true")
        # no call-site capture for every column expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # small test tables: keep all cores busy after a shuffle
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config(PROVIDER, ROCKSDB)
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _keyed_settings(spark):
    """What a query with keyed state runs with: its rows may hold many packets, so that Arrow
    batches are limited by their bytes too. A session that asks for less keeps its limit."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    value = spark.conf.get(name).removesuffix("b")
    small = value.isdigit() and 0 < int(value) <= ARROW_BYTES
    return {PROVIDER: ROCKSDB} | ({} if small else {name: f"{ARROW_BYTES}b"})


@contextmanager
def keyed_state(spark):
    """Queries started inside keep their state in RocksDB, whatever the session's store is, and
    hand Python ``ARROW_BYTES`` at once.

    A query takes the settings when it starts; the session has its own again afterwards.
    Threads that share the session start their queries one at a time, or one would give the
    settings back under another.
    """
    with _setting:
        settings = _keyed_settings(spark)
        before = {name: spark.conf.get(name, None) for name in settings}
        for name, value in settings.items():
            spark.conf.set(name, value)
        try:
            yield
        finally:
            for name, value in before.items():
                spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def shared_folder(spark, label):
    """A new, empty folder path that every executor can reach.

    The base is ``spark.checkpoint.dir``. Only a local master, where the driver
    and the executors are one process, may fall back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="packetloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def remove_scratch(spark) -> int:
    """Removes the folders that ``shared_folder`` named in this process; gives their number.

    Call it once nothing that was read from them is used any more.
    """
    from packetloom.sources import folders

    gone = sum(folders.remove(spark, path) for path in _made)
    _made.clear()
    return gone
