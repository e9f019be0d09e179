"""Counters of running streams: observed while rows are written, kept per micro-batch.

``observed`` adds named counters to a stream; they fill in the pass that writes it.
``MetricsTable`` listens to the queries and writes each micro-batch's counters, with Spark's
own row and time figures, to a folder named by query and batch, so one that runs again
replaces what it wrote and restarts add up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

NAME = "packetloom"
SCHEMA = "query string, batch_id long, run_id string, metric string, value double"


def observed(stream: DataFrame, ok: str = "ok", ms: str = "id_ms", name: str = NAME) -> DataFrame:
    """The same rows with counters: rows, synced, errors, newest time in milliseconds."""
    good = F.coalesce(F.col(ok), F.lit(False))
    return stream.observe(
        name, F.count(F.lit(1)).alias("rows"), F.count_if(good).alias("messages_synced"),
        F.count_if(~good).alias("errors"), F.max(ms).alias("last_sync_ms"),
    )


class MetricsTable(StreamingQueryListener):
    """Collects the counters of named queries; ``spark.streams.addListener`` starts it."""

    def __init__(self, spark, folder: str, name: str = NAME):
        self.spark, self.folder, self.name = spark, folder, name

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        seen = p.observedMetrics.get(self.name)
        if seen is None:
            return
        values = {k: v for k, v in seen.asDict().items() if v is not None}
        values |= {"input_rows": p.numInputRows, "seconds": (p.durationMs or {}).get("triggerExecution", 0) / 1000}
        query = p.name or str(p.id)
        rows = [(query, p.batchId, str(p.runId), k, float(v)) for k, v in values.items()]
        place = f"{self.folder}/query={query}/batch={p.batchId}"
        self.spark.createDataFrame(rows, SCHEMA).drop("query").coalesce(1).write.mode("overwrite").parquet(place)


def totals(spark, folder: str) -> DataFrame:
    """Per query: every counter summed over the micro-batches, the newest of ``last_...``."""
    rows = spark.read.parquet(folder)
    newest = F.col("metric").startswith("last_")
    return rows.groupBy("query", "metric").agg(
        F.when(F.first(newest), F.max("value")).otherwise(F.sum("value")).alias("value")
    )


def settle(spark) -> None:
    """Waits until the listeners have seen everything that happened."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
