"""One read of a source for several sinks, each with its own progress.

Every micro-batch is written down once, then given to the sinks. What a sink has taken is
marked in its ledger; one that fails keeps its place, is tried again with every later
micro-batch, from the first that it lacks, and holds up neither the source nor the others.
A copy goes when all sinks have taken it. As with all micro-batch functions, a sink may see a
batch twice and then must leave the same result.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame

from packetloom.sources import folders

log = logging.getLogger(__name__)
MOST_BEHIND = 100


class FallenBehind(RuntimeError):
    """A sink lacks more batches than are kept for it."""


class FanOut:
    """Gives every batch to all ``sinks`` (name -> fn(batch, batch_id)) by way of ``folder``."""

    def __init__(self, sinks: dict[str, Callable], folder: str, most_behind: int = MOST_BEHIND):
        self.sinks, self.folder, self.most_behind = dict(sinks), folder, most_behind

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id not in self.held(spark) and not self._taken_by_all(spark, batch_id):
            batch.write.mode("overwrite").parquet(self._copy(batch_id))
        self.catch_up(spark)

    def _copy(self, batch_id):
        return f"{self.folder}/batches/batch={batch_id}"

    def _mark(self, name, batch_id):
        return f"{self.folder}/ledger/{name}/{batch_id}"

    def held(self, spark) -> list[int]:
        """The batches of which a whole copy is there, in order."""
        found = [int(n[6:]) for n in folders.children(spark, f"{self.folder}/batches") if n.startswith("batch=")]
        return sorted(n for n in found if folders.is_done(spark, self._copy(n)))

    def taken(self, spark, name: str) -> set[int]:
        """The batches that a sink has taken, as far as the ledger goes back."""
        return {int(n) for n in folders.children(spark, f"{self.folder}/ledger/{name}") if n.isdigit()}

    def _taken_by_all(self, spark, batch_id):
        return bool(self.sinks) and all(batch_id in self.taken(spark, name) for name in self.sinks)

    def behind(self, spark) -> dict[str, list[int]]:
        """The batches that each sink still lacks."""
        held = self.held(spark)
        return {name: [n for n in held if n not in self.taken(spark, name)] for name in self.sinks}

    def catch_up(self, spark) -> dict[str, Exception]:
        """Gives every sink the batches that it lacks, in order, up to its first failure;
        then drops copies that nobody lacks. Gives the failures."""
        failed = {}
        for name, lacks in self.behind(spark).items():
            for n in lacks:
                try:
                    self.sinks[name](spark.read.parquet(self._copy(n)), n)
                except Exception as error:  # one sink must not stop the others
                    log.warning("sink %s failed on batch %d: %s", name, n, error)
                    failed[name] = error
                    break
                folders.touch(spark, self._mark(name, n))
        self._forget(spark)
        late = {name: lacks for name, lacks in self.behind(spark).items() if len(lacks) > self.most_behind}
        if late:
            name, lacks = next(iter(late.items()))
            raise FallenBehind(f"sink {name} lacks {len(lacks)} batches from {lacks[0]} on") from failed.get(name)
        return failed

    def _forget(self, spark):
        """Drops settled copies, and ledger marks but those of the newest batch, which a
        restart may bring again."""
        held = self.held(spark)
        lacking = {n for lacks in self.behind(spark).values() for n in lacks}
        for n in held:
            if n not in lacking and n != held[-1]:
                folders.remove(spark, self._copy(n))
                for name in self.sinks:
                    folders.remove(spark, self._mark(name, n))
