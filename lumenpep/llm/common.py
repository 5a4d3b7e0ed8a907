"""What the operators share: the shared folder, tables written there, and word boundaries."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but blank, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A folder that the driver and all executors see: spark.checkpoint.dir, or, where that is unset and all run in one
    process (tests), a temporary folder that is set as checkpoint folder for the session. On any other master an unset
    folder is an error, as each executor would write to a disk of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is unset: it must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="lumenpep-")
        spark.sparkContext.setCheckpointDir(found)
        atexit.register(shutil.rmtree, found[len("file://"):], ignore_errors=True)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/lumenpep/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it again: the lineage ends there, and a lost executor costs no
    more than the tasks that it ran."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes a table of stage() that no later step reads."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def only(df: DataFrame, *names: str) -> DataFrame:
    """The columns an operator works with; all others, whatever their names, stay behind."""
    return df.select(*(F.col(f"`{n}`") for n in names))


def slices(batch: pa.RecordBatch, column: int, most: int = 2 << 20, rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batch in parts whose texts in a column have about `most` bytes, one row at least."""
    length = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    low, held = 0, 0
    for i, n in enumerate(length.tolist()):
        if i > low and (held + n > most or i - low >= rows):
            yield batch.slice(low, i - low)
            low, held = i, 0
        held += n
    if batch.num_rows:
        yield batch.slice(low)


def values(batch: pa.RecordBatch, column: int) -> Iterator:
    """A column's values as Python objects, a few at a time: a batch of long texts isn't held twice."""
    if pa.types.is_string(batch.schema.field(column).type) or pa.types.is_binary(batch.schema.field(column).type):
        for part in slices(batch, column):
            yield from part.column(column).to_pylist()
    else:
        for low in range(0, batch.num_rows, 1000):
            yield from batch.column(column).slice(low, 1000).to_pylist()


def small_batches(spark: SparkSession, most: str = "8m") -> None:
    """Bounds the bytes of Arrow batches, in the JVM and in Python, where the session has Spark's default of 64 MB."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == "67108864b":
        spark.conf.set(name, most)


def released(run):
    """A function of Arrow batches that gives memory back to the system when its task ends: workers live on after it."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # another C library than glibc
                ctypes.CDLL(None).malloc_trim(0)

    return whole
