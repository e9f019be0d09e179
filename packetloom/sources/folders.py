"""Folders of a store: list, check, remove. Works on whatever file system the path names."""

from __future__ import annotations

from pyspark.sql import SparkSession

DONE = "_SUCCESS"


def _system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none where there is no such folder."""
    system, place = _system(spark, path)
    if not system.exists(place):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(place))


def matching(spark: SparkSession, glob: str) -> list[tuple[str, str]]:
    """(URI, path as Spark's sources write it) of the folders that match a glob."""
    system, place = _system(spark, glob)
    found = [status.getPath() for status in system.globStatus(place) or [] if status.isDirectory()]
    return [(path.toUri().toString(), path.toString()) for path in found]


def is_done(spark: SparkSession, path: str) -> bool:
    """A write job has committed the folder."""
    system, _ = _system(spark, path)
    return system.exists(spark._jvm.org.apache.hadoop.fs.Path(path, DONE))


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    system, place = _system(spark, path)
    return system.getContentSummary(place).getLength() if system.exists(place) else 0


def rename(spark: SparkSession, old: str, new: str) -> bool:
    """Moves a folder; False where ``new`` is there already."""
    system, place = _system(spark, old)
    target = spark._jvm.org.apache.hadoop.fs.Path(new)
    return not system.exists(target) and system.rename(place, target)


def remove(spark: SparkSession, path: str) -> bool:
    """Removes a folder and all in it; False where there is none."""
    system, place = _system(spark, path)
    return system.exists(place) and system.delete(place, True)


def touch(spark: SparkSession, path: str) -> None:
    """Makes an empty file, with the folders above it."""
    system, place = _system(spark, path)
    system.create(place, True).close()
