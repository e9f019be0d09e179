"""What the corpus operators share: tables, scratch tables, text basics."""

from __future__ import annotations

import ctypes
import inspect

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from packetloom.session import shared_folder

# White space between words, and a word, as every operator here counts them.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def saved(df, label):
    """The same rows, written to the cluster's shared folder and read back.

    It cuts the lineage with files that outlive a lost executor.
    """
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark):
    """Lets the session's Arrow batches hold ``BATCH_ROWS`` rows and ``BATCH_BYTES`` at most.

    Rows are whole documents here, and a worker holds a batch several times over. A session
    that asks for less keeps its settings.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    value = spark.conf.get(name).removesuffix("b")
    if not value.isdigit() or not 0 < int(value) <= BATCH_BYTES:
        spark.conf.set(name, f"{BATCH_BYTES}b")


def tidy():
    """Gives freed memory back: Python workers live on after their task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run, keep=0):
    """A function over an Arrow table or batches that tidies up behind itself.

    Arrays of some megabytes are mapped one by one, so that they go when they are freed.
    ``keep`` bytes of freed memory, if given, are kept until the function is done.
    """

    def begin():
        # -3 is glibc's M_MMAP_THRESHOLD
        option = getattr(ctypes.CDLL(None), "mallopt", None)
        if option:
            option(-3, 4 << 20)
            # -1 is M_TRIM_THRESHOLD
            option(-1, keep or 128 << 10)

    def batches(given):
        begin()
        try:
            yield from run(given)
        finally:
            tidy()

    def done(*given):
        begin()
        try:
            return run(*given)
        finally:
            tidy()

    if inspect.isgeneratorfunction(run):
        return batches
    # Spark counts the arguments of a function over groups
    return (lambda left, right: done(left, right)) if len(inspect.signature(run).parameters) == 2 else (lambda table: done(table))


def text_of(name):
    """A text column with null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def id_fold(name, folds):
    """crc32 of the id written as text, modulo ``folds``; a null id counts as ''."""
    written = F.coalesce(F.col(name).cast("string"), F.lit(""))
    return F.crc32(written.cast("binary")) % folds


def labelled_sample(docs, labels, column, folds, held, per_class, id_col="doc_id", text_col="text"):
    """Labelled training texts as (id, text, label), at most ``per_class`` of each label.

    Rows whose id fold is ``held`` stay out. The sample is the same on every run: ids in
    the order of their hash. An id with two labels counts with the larger one, an id with
    several texts with one of them. Null ids and labels are left out.
    """
    known = (
        labels.filter(F.col(id_col).isNotNull() & F.col(column).isNotNull())
        .filter(id_fold(id_col, folds) != held)
        .groupBy(F.col(id_col).alias("id")).agg(F.max(column).cast("int").alias("label"))
    )
    order = [F.xxhash64("id"), F.col("id")]
    picked = known.filter("label = 0").orderBy(*order).limit(per_class).union(
        known.filter("label = 1").orderBy(*order).limit(per_class)
    )
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    # 2 * per_class rows at most
    return texts.join(F.broadcast(picked), "id").dropDuplicates(["id"])


def label_shares(labels, column, folds, held, id_col="doc_id"):
    """Number of training rows with label 0 and 1."""
    row = (
        labels.filter(F.col(column).isNotNull() & (id_fold(id_col, folds) != held))
        .agg(F.count_if(F.col(column) == 0), F.count_if(F.col(column) == 1)).first()
    )
    return int(row[0]), int(row[1])


def same_columns(docs, id_col, **more):
    """Schema text of an id column named ``id`` with the given further columns."""
    kind = docs.schema[id_col].dataType.simpleString()
    return ", ".join([f"id {kind}", *(f"{name} {of}" for name, of in more.items())])


def byte_views(column):
    """The texts of an Arrow string column as arrays of bytes, without copying."""
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return [data[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
