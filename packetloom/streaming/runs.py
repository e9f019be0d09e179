"""Starting queries: file log sources, triggers, intake limits, fan-out."""

from __future__ import annotations

from pyspark.sql import DataFrame

from packetloom.operators.streamlog import positions
from packetloom.session import keyed_state
from packetloom.sources.stores import exists

# Seconds between micro-batches.
SYNC_SECONDS = 5
DISCOVERY_SECONDS = 10


def read_stream(spark, path: str, schema, max_files: int | None = None, clean: str | None = None,
                archive: str | None = None) -> DataFrame:
    """A folder (or glob) of parquet files as a stream.

    New files, and new folders that match the glob, are found while running.
    ``max_files`` limits the intake of one micro-batch. ``clean`` is
    ``archive`` or ``delete``: what happens to a file once it is processed.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if clean:
        reader = reader.option("cleanSource", clean)
        if archive:
            reader = reader.option("sourceArchiveDir", archive)
    return reader.parquet(path)


def start_positions(log: DataFrame, folder: str) -> DataFrame:
    """Newest position of every stream of a stored log, written down once.

    With ``streamlog.tail_from`` a stream starts from here; a restarted query
    finds the same positions.
    """
    spark = log.sparkSession
    if not exists(spark, folder):
        positions(log).write.mode("overwrite").parquet(folder)
    return spark.read.parquet(folder)


def read_topic(spark, servers: str, pattern: str, start: str = "earliest", max_offsets: int | None = None) -> DataFrame:
    """Kafka topics by pattern as a stream; needs the Kafka connector.

    ``start="earliest"`` replays from the beginning, ``"latest"`` tails.
    """
    reader = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribePattern", pattern).option("startingOffsets", start)
    )
    return reader.option("maxOffsetsPerTrigger", max_offsets).load() if max_offsets else reader.load()


def start(stream: DataFrame, fn, checkpoint: str, every_seconds: float | None = None, name: str | None = None,
          keyed: bool = False):
    """Run ``fn(batch, batch_id)`` for every micro-batch.

    The source position moves on only after ``fn`` returns. Without
    ``every_seconds`` the query takes what is there and ends. ``keyed`` is for the
    streams of ``stateful``, which need the RocksDB state store.
    """
    if keyed:
        with keyed_state(stream.sparkSession):
            return start(stream, fn, checkpoint, every_seconds, name)
    writer = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if every_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{every_seconds} seconds").start()


def fan_out(stream: DataFrame, sinks: dict, checkpoints: str, every_seconds: float | None = None):
    """One query per sink over the same source, each with its own progress."""
    return {
        name: start(stream, fn, f"{checkpoints}/{name}", every_seconds) for name, fn in sinks.items()
    }


def dedupe_stream(stream: DataFrame, ts: str, delay: str, keys=("stream_key", "message_id")) -> DataFrame:
    """Drop repeats of an entry that arrive within ``delay``; bounds the kept state."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))
