"""Tables of sorted runs: written in proportion to the changes, merged on read.

Every batch becomes a run, a folder ``run=<first>-<last>-<level>`` with one row for each
key of the batch, sorted by key. Where ``FANOUT`` runs of a level lie side by side they are
merged into one of the next level, so a row is rewritten once per level and their number
grows with the logarithm of the batches. A merged run stands for the batches first..last and
hides the runs inside it; those stay readable until ``sweep``, so a reader that listed them
before the merge finishes.

A run is live once its write has committed. A batch that runs again replaces its own run, or
finds it merged and leaves it. One writer at a time; any number of readers.

``RunStore`` does this for any rows and any way to merge the rows of a key; the functions
below it are the key-value table, whose rows are changes, delete marks included.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.operators.keyvalues import KEY
from packetloom.operators.streamlog import keep_last
from packetloom.sources import folders

FANOUT = 4
DELETED = "deleted"


class Run(NamedTuple):
    first: int
    last: int
    level: int

    @property
    def name(self):
        return f"run={self.first}-{self.last}-{self.level}"


class RunStore:
    """Runs under ``path``. ``merge(rows)`` gives one row per key and takes its own results;
    batches count up from 0."""

    def __init__(self, spark, path: str, key, merge: Callable[[DataFrame], DataFrame], fanout: int = FANOUT):
        self.spark, self.path, self.key, self.merge, self.fanout = spark, path, list(key), merge, fanout

    def runs(self) -> list[Run]:
        """All committed runs, the widest first where they begin alike."""
        names = [n for n in folders.children(self.spark, self.path) if n.startswith("run=")]
        found = [Run(*map(int, n[4:].split("-"))) for n in names]
        found = [r for r in found if folders.is_done(self.spark, f"{self.path}/{r.name}")]
        return sorted(found, key=lambda r: (r.first, -r.last))

    def live(self) -> list[Run]:
        """The runs that a reader needs, oldest first: those inside no other."""
        out = []
        for r in self.runs():
            if not out or r.last > out[-1].last:
                out.append(r)
        return out

    def rows(self, some=None, until: int | None = None) -> DataFrame | None:
        """The rows of some runs, or of all live ones, not merged. ``until`` leaves out later
        batches, which must not be merged yet. None where there is no run."""
        some = self.live() if some is None else some
        if until is not None:
            some = [r for r in some if r.last <= until]
        return self.spark.read.parquet(*(f"{self.path}/{r.name}" for r in some)) if some else None

    def read(self) -> DataFrame | None:
        """One row per key; None where nothing was written."""
        rows = self.rows()
        return None if rows is None else self.merge(rows)

    def holds(self, batch: int) -> bool:
        """The batch is part of a merged run and no longer a run of its own."""
        return any(r.first <= batch <= r.last and r.last > r.first for r in self.runs())

    def write(self, rows: DataFrame, batch: int, settle=None, compact: bool = True) -> None:
        """Adds a batch; see ``compact`` for ``settle``."""
        if self.holds(batch):
            return
        self._put(self.merge(rows), Run(batch, batch, 0))
        if compact:
            self.compact(settle)

    def _put(self, rows, run):
        """Sorted by key over the files, so that their statistics tell which can hold a key."""
        ordered = rows.repartitionByRange(*self.key).sortWithinPartitions(*self.key)
        ordered.write.mode("overwrite").parquet(f"{self.path}/{run.name}")

    def compact(self, settle=None) -> list[Run]:
        """Merges while ``fanout`` neighbours have one level; gives the runs made.

        ``settle(rows)`` may drop rows of a merge that takes in the oldest run.
        """
        made = []
        while True:
            now = self.live()
            alike = (now[k : k + self.fanout] for k in range(len(now) - self.fanout + 1))
            group = next((g for g in alike if len({r.level for r in g}) == 1), None)
            if group is None:
                return made
            rows = self.merge(self.rows(group))
            if settle and group[0] == now[0]:
                rows = settle(rows)
            run = Run(group[0].first, group[-1].last, group[0].level + 1)
            self._put(rows, run)
            made.append(run)

    def sweep(self) -> int:
        """Removes runs that a merged one hides; call it when no reader can still use them."""
        needed = set(self.live())
        return sum(folders.remove(self.spark, f"{self.path}/{r.name}") for r in self.runs() if r not in needed)


def _store(spark, path, key=KEY, fanout=FANOUT):
    """The last change of every key by ``arrival``; it may be a delete mark."""
    return RunStore(spark, path, key, lambda rows: keep_last(rows, list(key), "arrival"), fanout)


def _settled(before):
    """Drops delete marks that arrived before ``before``."""
    return None if before is None else lambda rows: rows.where(~F.col(DELETED) | (F.col("arrival") >= before))


def runs(spark, path: str) -> list[Run]:
    return _store(spark, path).runs()


def live(spark, path: str) -> list[Run]:
    return _store(spark, path).live()


def write(changes: DataFrame, path: str, batch: int, key=KEY, fanout: int = FANOUT, merge: bool = True,
          settled: int | None = None) -> None:
    """Adds a batch of changes: the key columns, ``redis_value``, ``arrival`` and, where
    keys can go, ``deleted``. The last change by ``arrival`` counts, in whichever batch it
    came. Batches count up from 0; see ``compact`` for ``settled``."""
    if DELETED not in changes.columns:
        changes = changes.withColumn(DELETED, F.lit(False))
    changes = changes.withColumn(DELETED, F.coalesce(DELETED, F.lit(False)))
    _store(changes.sparkSession, path, key, fanout).write(changes, batch, _settled(settled), merge)


def compact(spark, path: str, key=KEY, fanout: int = FANOUT, settled: int | None = None) -> list[Run]:
    """Merges while ``fanout`` neighbours have one level; gives the runs made.

    A delete mark hides changes that arrived before it, also those of a later batch. It goes
    when it is merged with the oldest run and arrived before ``settled``, from which on the
    caller knows that no earlier change will come; without ``settled`` marks stay.
    """
    return _store(spark, path, key, fanout).compact(_settled(settled))


def read(spark, path: str, key=KEY) -> DataFrame | None:
    """The table: every key's last value, deleted keys left out. None where nothing was written."""
    rows = _store(spark, path, key).read()
    return None if rows is None else rows.where(~F.col(DELETED)).drop(DELETED)


def lookup(spark, path: str, redis_key: str, db: int | None = None, key=KEY) -> DataFrame | None:
    """The value of one key: the filter reaches every run's scan, whose files are sorted by key."""
    store = _store(spark, path, key)
    rows = store.rows()
    if rows is None:
        return None
    rows = rows.where(F.col("redis_key") == redis_key)
    if db is not None:
        rows = rows.where(F.col("redis_db") == db)
    return store.merge(rows).where(~F.col(DELETED)).drop(DELETED)


def sweep(spark, path: str) -> int:
    """Removes runs that a merged one hides; call it when no reader can still use them."""
    return _store(spark, path).sweep()
