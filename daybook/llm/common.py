"""Helpers shared by the operators: scratch tables, columns, Arrow buffers."""

from __future__ import annotations

import ctypes
import gc
import os
import uuid
from collections.abc import Callable, Hashable
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.session import checkpoint_root


# Bytes of an Arrow batch between Spark and a Python worker; below the 8 MB parts that operators cut.
BATCH_BYTES = 7 << 20


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's limit of an Arrow batch to BATCH_BYTES.

    By default a batch ends at 10 000 rows or 64 MB.  A batch is held by the JVM,
    outside its heap and twice while a buffer grows, and by the worker.
    """
    if spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch() > BATCH_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


class Scratch:
    """Intermediate tables in the shared folder named by spark.checkpoint.dir.

    A table written here cuts the lineage: losing an executor later costs a
    re-read of the shared files only.  ``drop`` deletes a table once nothing
    lazy reads it any more.
    """

    def __init__(self, spark: SparkSession, name: str):
        small_batches(spark)
        self.spark = spark
        self.base = f"{checkpoint_root(spark)}/llm/{name}-{uuid.uuid4().hex}"
        self._n = 0
        self._at: dict[int, str] = {}

    def table(self, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        self._n += 1
        path = f"{self.base}/{self._n}"
        writer = df.write.partitionBy(partition_by) if partition_by else df.write
        writer.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._at[id(out)] = path
        out._scratch_path = path          # keeps the id tied to this object
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for t in tables:
            path = jvm.org.apache.hadoop.fs.Path(t._scratch_path)
            path.getFileSystem(conf).delete(path, True)


def share_package(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver did, and bounds their batches.

    For local runs from any folder; on a cluster the package is installed or
    shipped, and a path that doesn't exist there is ignored.
    """
    small_batches(spark)
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


_HELD: dict[Hashable, object] = {}


def held(operator: str, key: Hashable = None, make: Callable[[], object] | None = None) -> object:
    """What this Python worker keeps between tasks of ``operator``, made on first use.

    Workers are reused by later stages and other operators.  A worker keeps
    tables of one operator at a time: its first task for another one drops
    them and gives the memory back to the system.
    """
    if any(name != operator for name, _ in _HELD):
        _HELD.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)
    if (operator, key) not in _HELD:
        _HELD[operator, key] = make() if make else None
    return _HELD[operator, key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_column(name: str = "text"):
    """The text, with null read as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias("text")


def text_key(name: str = "text") -> dict:
    """Two hashes that together know a text by its content."""
    return {"k1": F.xxhash64(name), "k2": F.xxhash64(F.lit(1), F.col(name))}


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string or binary column's bytes and its n + 1 offsets into them.

    No copy is made; a null is an empty value.
    """
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    start, n = column.offset, len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[start:start + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, column: str, limit: int):
    """Cuts a batch so that each part's ``column`` holds about ``limit`` bytes.

    A single longer value is a part of its own.
    """
    _, off = utf8(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        to = int(np.searchsorted(off, off[at] + limit, "right")) - 1
        to = min(n, max(at + 1, to))
        yield batch.slice(at, to - at)
        at = to
