"""Helpers shared by the document operators: tables, folds, bounded samples of labelled rows."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str | Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; a null key belongs to no fold and gives -1."""
    column = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % folds, F.lit(-1))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """At most ``bound`` labelled rows with their texts: (doc_id, text, label).

    The rows of least hash of their id are taken, so the sample depends neither on the order nor
    on the partitions of the input. Rows without label, id or text are left out. The sampled ids
    are broadcast: their number is bounded, and the texts stay where they are. An id that repeats
    gives one row for each of its labels, with its text of least hash.
    """
    ids = (
        labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("double").alias("label"))
        .where("_id is not null and label is not null")
        .distinct()
        .orderBy(F.xxhash64("_id"), "_id", "label")
        .limit(bound)
    )
    texts = docs.select("doc_id", "text").where("text is not null")
    rows = texts.join(F.broadcast(ids), F.col("doc_id") == F.col("_id"))
    return rows.groupBy("doc_id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))


def parts(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Batches (key, text as bytes) cut so that a part holds about ``most`` bytes, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
        part = (np.cumsum(sizes, dtype=np.int64) - sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(part)]
        for a, b in zip(cuts, cuts[1:]):
            if a < b:
                yield batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a)


def slices(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[pa.Array, list[bytes | None]]]:
    """The same with the texts as a list."""
    return ((keys, texts.to_pylist()) for keys, texts in parts(batches, most))


def give_back() -> None:
    """Return the memory that this Python worker no longer uses; workers live on between tasks, and
    those that wait hold what they once took."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def lean(run):
    """A function over a task's batches that gives memory back when the task is done."""

    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps.

    It does so once the driver has collected what refers to them, which may otherwise be much later
    than the next step needs the disks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
