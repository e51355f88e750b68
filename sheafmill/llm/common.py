"""What the corpus operators share: written intermediates, Arrow text access, digests."""

from __future__ import annotations

import atexit
import gc
import re
import tempfile
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch while an intermediate is written.
BATCH_ROWS = 512
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

_own_root: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; one of our own only where none is set and all runs in one process (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not _own_root:
        held = tempfile.TemporaryDirectory(prefix="sheafmill-")
        atexit.register(held.cleanup)
        _own_root.append(f"file://{held.name}")
    return _own_root[0]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/sheafmill-{name}-{uuid.uuid4().hex}"


def frozen(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    This cuts the lineage: a lost executor costs a re-read, not a recomputation, and a
    consumer sees the same rows however often it reads them.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    # Rows hold whole texts: with the default of 10,000 to an Arrow batch a few long texts in each
    # make batches of hundreds of megabytes, on both sides.
    before = spark.conf.get(_BATCH_ROWS)
    spark.conf.set(_BATCH_ROWS, str(min(int(before), BATCH_ROWS) if int(before) > 0 else BATCH_ROWS))
    try:
        writer.parquet(path)
    finally:
        spark.conf.set(_BATCH_ROWS, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the table that :func:`frozen` gave, once nothing reads it any more."""
    jvm = df.sparkSession._jvm
    for file in df.inputFiles()[:1]:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        while path.getName() and not re.fullmatch(r"sheafmill-.+-[0-9a-f]{32}", path.getName()):
            path = path.getParent()
        if path.getName():
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Drop the shuffle files of jobs whose results are written down.

    Spark removes them once the driver has collected its references to them, which it otherwise
    does when its heap is full, however full the executors' disks are. What listeners still hold of
    a job that has just ended goes with a second collection.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_buffer(column: pa.Array, fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column (null: empty) and the n + 1 offsets of its rows.

    ``fold`` lower-cases A-Z and nothing else.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.string())
    if column.null_count:
        column = pc.fill_null(column, "")
    if fold:
        column = pc.ascii_lower(column)
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces(column: pa.Array, fold: bool = False) -> Iterator[memoryview]:
    """The bytes of each row of a string column, without a copy."""
    raw, at = text_buffer(column, fold)
    view = memoryview(np.ascontiguousarray(raw))
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        yield view[a:b]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit values (two multiply-xorshift rounds)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xA0761D6478BD642F)
    x ^= x >> np.uint64(32)
    return x


def input_partitions(df: DataFrame) -> int:
    """How many partitions the scan behind ``df`` has; it grows with the input."""
    return max(1, df.rdd.getNumPartitions())


def pow2_at_least(n: int) -> int:
    return 1 << max(0, int(n) - 1).bit_length()


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on keys in which null equals null; the right side's keys are dropped."""
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    on = None
    for k in keys:
        same = left[k].eqNullSafe(renamed[f"__r_{k}"])
        on = same if on is None else on & same
    return left.join(renamed, on, how).drop(*[f"__r_{k}" for k in keys])
