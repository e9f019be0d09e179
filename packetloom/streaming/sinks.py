"""Micro-batch functions for ``runs.start``. Each may run again for the same
batch id and then leaves the same result."""

from __future__ import annotations

from pyspark.sql import functions as F

from packetloom.functions.ids import prefixed
from packetloom.operators import outbox, routing, streamlog
from packetloom.sources import folders, stores, topics


def _write_batch(rows, folder, batch_id, *parts):
    rows.write.mode("overwrite").partitionBy(*parts).parquet(f"{folder}/batch_id={batch_id}")


def _hour(written_at, ttl_s="ttl_s"):
    """Partition of a row that expires: the hour it does; -1 for one that never does."""
    over = F.floor((F.col(written_at) + F.col(ttl_s)) / 3600)
    return F.when(F.col(ttl_s).isNull(), -1).otherwise(F.greatest(over, F.lit(0))).cast("bigint")


def _not_over(rows, as_of):
    """The partitions that can hold a live row at ``as_of``, by the life of each row."""
    return rows.where((F.col("expires") == -1) | (F.col("expires") >= max(as_of // 3600, 0)))


def _read(spark, folder, batch_id=None):
    path = folder if batch_id is None else f"{folder}/batch_id={batch_id}"
    return spark.read.parquet(path)


def table_sink(path: str, overwrite: bool = False, zone: str = "UTC"):
    """Stream-table sink with the first-wins or last-wins rule."""

    def run(batch, batch_id):
        rows = streamlog.stream_table_rows(batch, zone=zone)
        stores.write_stream_table(rows, path, overwrite)

    return run


ENTRY_KEY = ["stream_key", "message_id"]


def replica_sink(path: str, prefix: str = "", rejects: str | None = None, arrival: str = "arrival"):
    """Append entries under the target key, those already there left out.

    Of entries with the same id in one batch the first by ``arrival`` stays. Entries
    without an id cannot be told apart; they go to ``rejects`` (``{path}-rejects``),
    a folder per batch. Only the target's dates that the batch has are read.
    """
    apart = rejects or f"{path.rstrip('/')}-rejects"

    def run(batch, batch_id):
        spark = batch.sparkSession
        whole = batch.where(F.col("message_id").isNotNull() & F.col("id_ms").isNotNull())
        lost = batch.where(F.col("message_id").isNull() | F.col("id_ms").isNull())
        if not lost.isEmpty():
            _write_batch(lost.withColumn("reason", F.lit("no message id")), apart, batch_id)
        rows = streamlog.keep_first(whole, ENTRY_KEY, arrival=arrival)
        if stores.exists(spark, path):
            held = stores.on_dates(spark.read.parquet(path), whole.withColumn("log_date", stores.log_date()), "log_date")
            rows = streamlog.replicate(rows, held, prefix)
        else:
            rows = rows.withColumn("stream_key", prefixed("stream_key", prefix))
        stores.append_log(rows, path)

    return run


def outbox_sink(folder: str, open_writer, stamp_s: str = "stamp_s", ttl_s: int = outbox.DEFAULT_TTL_S,
                sweep_every: int | None = None):
    """Write the content, send it, write markers for what was acknowledged.

    With ``sweep_every``, every so many batches what expired by the newest stamp is swept.

    Input: topic, key, value and the write time. What fails stays without a
    marker; ``resync`` sends it again. The send result is written down before
    markers are derived, so they always agree.
    """

    def run(batch, batch_id):
        spark = batch.sparkSession
        content = batch.select(
            "topic", "key", "value", F.col(stamp_s).alias("written_at"),
            F.lit(ttl_s).cast("bigint").alias("ttl_s"),
        )
        _write_batch(content.withColumn("expires", _hour("written_at")), f"{folder}/content", batch_id, "expires")
        written = _read(spark, f"{folder}/content", batch_id)
        _send(spark, written, folder, str(batch_id), open_writer, ttl_s)
        if sweep_every and batch_id % sweep_every == sweep_every - 1:
            newest = written.agg(F.max("written_at")).first()[0]
            if newest is not None:
                sweep_outbox(spark, folder, newest)

    return run


def _send(spark, content, folder, label, open_writer, ttl_s):
    attempts = topics.deliver(content, open_writer, ids=("key", "written_at"))
    _write_batch(attempts, f"{folder}/attempts", label)
    acked = _read(spark, f"{folder}/attempts", label).withColumn("acked", F.col("success"))
    marks = acked.where("acked").select(
        "key", F.col("written_at").alias("marked_at"), F.lit(ttl_s).cast("bigint").alias("ttl_s")
    )
    _write_batch(marks.withColumn("expires", _hour("marked_at")), f"{folder}/markers", label, "expires")
    return acked


def resync(spark, folder: str, label: str, open_writer, as_of: int, ttl_s: int = outbox.DEFAULT_TTL_S):
    """Send live content without a live marker again; gives attempted and synced counts.

    ``label`` names this run. Its attempts and markers lie under ``resync/``, apart from
    those of the stream's batches, and a run with the same label replaces them.
    ``ttl_s`` is the life of the markers it writes. Content and markers lie by the hour
    they expire, so only hours that are over at ``as_of`` are not read.
    """
    if not stores.exists(spark, f"{folder}/content"):
        # all of it expired and was swept
        return outbox.sync_counts(spark.createDataFrame([], "acked boolean"))
    content = outbox.unsynced(
        _not_over(_read(spark, f"{folder}/content"), as_of),
        _not_over(_markers(spark, folder, label), as_of), as_of,
    )
    return outbox.sync_counts(
        _send(spark, content.select("topic", "key", "value", "written_at"), f"{folder}/resync", label, open_writer, ttl_s)
    )


def _markers(spark, folder, label):
    """Markers of the stream and of the other resync runs."""
    place = f"{folder}/markers"
    schema = "key string, marked_at long, ttl_s long, batch_id string, expires long"
    marks = _read(spark, place) if stores.exists(spark, place) else spark.createDataFrame([], schema)
    again = f"{folder}/resync/markers"
    if stores.exists(spark, again):
        others = _read(spark, again).where(F.col("batch_id").cast("string") != label)
        columns = ["key", "marked_at", "ttl_s", "expires"]
        marks = marks.select(*columns).unionByName(others.select(*columns))
    return marks


GRACE_S = 3600


def sweep_outbox(spark, folder: str, as_of: int, grace_s: int = GRACE_S) -> int:
    """Removes what expired more than ``grace_s`` before ``as_of``; gives the folders removed.

    Content and markers lie by the hour they expire, so whole hours go, without reading them.
    The grace is for readers that began before: a resync of that time still finds its files.
    Batches of which no content is left lose their attempts as well.
    """
    over = (as_of - grace_s) // 3600
    gone = 0
    for part in ("content", "markers", "resync/markers"):
        for batch in folders.children(spark, f"{folder}/{part}"):
            at = f"{folder}/{part}/{batch}"
            hours = [n for n in folders.children(spark, at) if n.startswith("expires=")]
            old = [n for n in hours if 0 <= int(n[8:]) < over]
            if not hours or not batch.startswith("batch_id="):
                continue
            if len(old) == len(hours):
                gone += folders.remove(spark, at)
            else:
                gone += sum(folders.remove(spark, f"{at}/{n}") for n in old)
    for part, of in (("attempts", "content"), ("resync/attempts", "resync/markers")):
        kept = set(folders.children(spark, f"{folder}/{of}"))
        for batch in folders.children(spark, f"{folder}/{part}"):
            if batch.startswith("batch_id=") and batch not in kept:
                gone += folders.remove(spark, f"{folder}/{part}/{batch}")
    return gone


def publish_sink(folder: str, open_writer, base: str, field=None, values=(), stamp: str = "stamp"):
    """Validate, filter, publish; settled outcomes per batch under ``folder``.

    Input: stream_key, message_id, raw and a stamp column. What was to be sent is kept
    under ``outgoing``; ``backlog`` lists what failed, ``republish`` sends it again.
    """

    def run(batch, batch_id):
        spark = batch.sparkSession
        planned = routing.plan_outcomes(routing.parse_messages(batch), field, values)
        out = routing.publish_messages(planned.where("outcome = 'publish'"), base, stamp)
        _write_batch(out, f"{folder}/outgoing", batch_id)
        out = _read(spark, f"{folder}/outgoing", batch_id)
        _write_batch(topics.deliver(out, open_writer), f"{folder}/sent", batch_id)
        settled = routing.settle_outcomes(planned, _read(spark, f"{folder}/sent", batch_id))
        _write_batch(
            settled.select("stream_key", "message_id", "outcome", "ack"), f"{folder}/outcomes", batch_id
        )

    return run


def backlog(spark, folder: str, since: int = 0, leave_out: str | None = None):
    """Messages that no attempt has published yet, of batches from ``since`` on."""
    out = _read(spark, f"{folder}/outgoing").where(F.col("batch_id") >= since)
    done = _read(spark, f"{folder}/sent").where(F.col("batch_id") >= since).where("success").select(*ENTRY_KEY)
    again = f"{folder}/retried"
    if stores.exists(spark, again):
        retried = spark.read.parquet(again).where("success")
        if leave_out is not None:
            retried = retried.where(F.col("run").cast("string") != leave_out)
        done = done.unionByName(retried.select(*ENTRY_KEY))
    return out.join(done.distinct(), ENTRY_KEY, "left_anti")


def republish(spark, folder: str, label: str, open_writer, since: int = 0):
    """Send the backlog again; gives attempted and published counts.

    ``label`` names this run; a run with the same label starts it over.
    """
    place = f"{folder}/retried/run={label}"
    waiting = backlog(spark, folder, since, leave_out=label).drop("batch_id")
    topics.deliver(waiting, open_writer).write.mode("overwrite").parquet(place)
    return spark.read.parquet(place).agg(
        F.count(F.lit(1)).alias("attempted"), F.count_if("success").alias("published")
    )


def transform_sink(folder: str, fn, topic: str):
    """Consume, transform, produce: results under their new key, failures apart.

    Input: key, new_key, value. The function runs once per message; results and
    failures are two partitions (``failed``) of one write.
    """

    def run(batch, batch_id):
        done = topics.transform_messages(batch, fn).select(
            F.lit(topic).alias("topic"), F.coalesce("new_key", "key").alias("key"),
            F.col("result").alias("value"), "error", F.col("error").isNotNull().alias("failed"),
        )
        done.write.mode("overwrite").partitionBy("failed").parquet(f"{folder}/batch_id={batch_id}")

    return run


def discovery_sink(folder: str):
    """Record streams seen for the first time, with the batch that showed them.

    A batch without a new stream writes nothing, so the folder grows with the streams
    and not with the batches.
    """

    def run(batch, batch_id):
        spark = batch.sparkSession
        seen = batch.select("stream_key").distinct()
        if stores.exists(spark, folder):
            known = _read(spark, folder)
            seen = seen.join(
                known.where(F.col("batch_id") < batch_id).select("stream_key"), "stream_key", "left_anti"
            )
        if not seen.isEmpty():
            _write_batch(seen, folder, batch_id)

    return run
