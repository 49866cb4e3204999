"""Arrow batches and files of tasks in Python."""

from __future__ import annotations

import ctypes
import os
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import SparkSession

BATCH_BYTES = 8 << 20
Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def bounded_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Arrow batches of few rows and bytes, so that long texts don't gather in one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """Filesystem and path of a folder: a local path or file:, hdfs:, s3:, gs: URI. Executors and driver use it alike."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), os.path.abspath(uri)
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return pafs.FileSystem.from_uri(uri)


def give_back() -> None:
    """Hands freed memory to the system: worker processes live on from stage to stage, beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim:
            trim(0)


def tidy(task: Task) -> Task:
    """``task`` that gives back its memory when it ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            give_back()

    return run
