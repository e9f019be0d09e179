"""Topic writers and file sources."""

from __future__ import annotations

import sys

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.functions.payloads import MAX_MESSAGE_BYTES
from packetloom.sources import smallfiles

# Workers get these functions with the plan and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def topic_frame(messages: DataFrame) -> DataFrame:
    """(topic, key, value) with binary key and value, as the Kafka writer takes it."""
    return messages.select(
        "topic", F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value")
    )


def write_topic(messages: DataFrame, servers: str, **options) -> None:
    """Send to Kafka; needs the Kafka connector on the class path."""
    writer = topic_frame(messages).write.format("kafka").option("kafka.bootstrap.servers", servers)
    writer.option("kafka.max.request.size", str(MAX_MESSAGE_BYTES)).options(**options).save()


def deliver(messages: DataFrame, open_writer, ids=("stream_key", "message_id"), tasks: int | None = None,
            in_flight: int | None = None) -> DataFrame:
    """Hand every message to a user writer, inside the tasks.

    ``open_writer()`` is called once per task and returns ``send(row) -> bool``
    where ``row`` is a dict. With ``in_flight`` it returns ``send_many(rows)``
    instead: it gets that many rows at a time, may have them all under way at once,
    and gives one outcome per row, True, False or an exception. Gives (ids,
    success, error), the ids as they came. Sending is at-least-once: a task that
    runs again sends again, so write the result down once before using it.
    ``tasks`` bounds how many writers are open.
    """
    ids = list(ids)
    fields = dict(messages.dtypes)
    schema = ", ".join([f"`{c}` {fields[c]}" for c in ids] + ["success boolean", "error string"])

    def outcomes(send, rows):
        if in_flight is None:
            for row in rows:
                try:
                    yield send(row)
                except Exception as error:  # a failed message stays for a later attempt
                    yield error
            return
        try:
            found = list(send(rows))
            if len(found) != len(rows):
                raise ValueError(f"{len(found)} outcomes for {len(rows)} messages")
        except Exception as error:
            found = [error] * len(rows)
        yield from found

    def run(batches):
        send = open_writer()
        for batch in batches:
            size = in_flight or max(1, batch.num_rows)
            for k in range(0, batch.num_rows, size):
                part = batch.slice(k, size)
                done = list(outcomes(send, part.to_pylist()))
                failed = [isinstance(d, Exception) for d in done]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(part.schema.names.index(c)) for c in ids),
                        pa.array([not f and bool(d) for f, d in zip(failed, done)], pa.bool_()),
                        pa.array([str(d) if f else None for f, d in zip(failed, done)], pa.string()),
                    ],
                    names=[*ids, "success", "error"],
                )

    spread = messages if tasks is None else messages.repartition(tasks)
    return spread.mapInArrow(run, schema)


def transform_messages(messages: DataFrame, fn, value: str = "value") -> DataFrame:
    """Apply ``fn(bytes) -> bytes`` to each message; adds ``result`` and ``error``.

    A message whose call raises has a null result and the error text.
    """

    @F.pandas_udf("result binary, error string")
    def apply(values: pd.Series) -> pd.DataFrame:
        done = []
        for v in values:
            try:
                done.append((None if v is None else fn(bytes(v)), None))
            except Exception as error:
                done.append((None, str(error)))
        return pd.DataFrame(done, columns=["result", "error"], dtype="object")

    out = messages.withColumn("_t", apply(F.col(value).cast("binary")))
    return out.select(*messages.columns, "_t.result", "_t.error")


def _files(spark, path, tasks, limit=None, contents=True):
    if tasks is None:
        return spark.read.format("binaryFile").load(path)
    return smallfiles.read_folders(spark, path, tasks, limit, contents)


def read_files(spark, path: str, limit: int = MAX_MESSAGE_BYTES, tasks: int | None = None) -> DataFrame:
    """Files as (path, name, length, verdict); the contents are not read.

    The verdict is ``ok`` or ``too_large``; empty files are skipped, Spark's file
    source does not list them. ``file_messages`` reads the accepted ones. For very many
    files in folders, give the glob of the folders and the number of ``tasks`` that list and
    read them (``smallfiles.read_folders``): Spark would list them all on the driver, count
    a small file as 4 MB and make a task of a few.
    """
    files = _files(spark, path, tasks, contents=False)
    return files.select(
        "path", F.element_at(F.split("path", "/"), -1).alias("name"), "length",
        F.when(F.col("length") > limit, "too_large").otherwise("ok").alias("verdict"),
    )


def file_messages(spark, path: str, topic: str, epoch_s: int, device: str | None = None,
                  limit: int = MAX_MESSAGE_BYTES, tasks: int | None = None) -> DataFrame:
    """Accepted files as messages keyed ``{device or 'file'}:{name}:{epoch_s}``.

    The size conditions are pushed to the source, so an oversized file is never read.
    ``tasks`` as in ``read_files``.
    """
    files = _files(spark, path, tasks, limit)
    ok = files.where((F.col("length") > 0) & (F.col("length") <= limit))
    name = F.element_at(F.split("path", "/"), -1)
    return ok.select(
        F.lit(topic).alias("topic"),
        F.concat_ws(":", F.lit(device or "file"), name, F.lit(str(epoch_s))).alias("key"),
        F.col("content").alias("value"),
    )
