"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import tempfile
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)
# Words are runs of anything but the six ASCII white-space bytes.
WORD = r"[^\x20\x09-\x0D]+"
ROW_BYTES = 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir).

    A folder of our own is made only where the session runs in one process
    and names none, as in tests."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError("spark.checkpoint.dir must name a shared folder")
            path = tempfile.mkdtemp(prefix="visitlens-shared-")
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """Bytes of a text column; one number reaches the driver."""
    return df.agg(F.sum(F.octet_length(F.col(column).cast("string")))).first()[0] or 0


def row_bytes(column: str) -> Column:
    """Bytes that a row with this text takes in a block: also rows without
    text fill it."""
    return F.coalesce(F.octet_length(F.col(column).cast("string")), F.lit(0)) + F.lit(ROW_BYTES)


def pieces(total: int, each: int) -> int:
    return max(1, -(-total // each))


def sample(df: DataFrame, columns: list[str], rows: int, total: int) -> DataFrame:
    """At most ``rows`` rows, drawn by a hash of ``columns`` and the row's
    place in the input, so rows that repeat a key or a text are drawn one by
    one.  Of ``total`` rows first a share is taken that holds about twice as
    many, so that this, and not ``rows`` from each partition, is what a
    sorted limit brings together."""
    return _drawn(df, columns, F.lit(_share(rows, total))).orderBy("_draw").limit(rows).drop("_draw")


def sample_each(df: DataFrame, label: str, columns: list[str], rows: int) -> DataFrame:
    """``sample`` within each value of ``label``, which share ``rows`` alike;
    a value with fewer rows gives them all.  The values (classes to learn,
    not data) and their counts reach the driver."""
    counts = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}
    if not counts:
        return df
    each = max(1, rows // len(counts))
    shares = F.create_map(*[F.lit(x) for name, n in counts.items() for x in (name, _share(each, n))])
    nth = F.row_number().over(Window.partitionBy(label).orderBy("_draw"))
    return _drawn(df, columns, F.element_at(shares, F.col(label))).withColumn("_nth", nth).where(
        F.col("_nth") <= each).drop("_draw", "_nth")


def _share(rows: int, total: int) -> float:
    return min(1.0, (2 * rows + 64) / max(total, 1))


def _drawn(df: DataFrame, columns: list[str], share: Column) -> DataFrame:
    drawn = df.withColumn("_draw", F.xxhash64(*columns, F.monotonically_increasing_id(), F.lit(3)))
    return drawn.where(F.pmod("_draw", F.lit(1 << 30)) < share * (1 << 30))


# What other operators keep in a worker between its tasks.
KEPT: list[Callable[[], None]] = []


def release() -> None:
    """Drop what operators have kept in this worker and give freed memory
    back to the system: workers live on from task to task, and from one
    operator's stage to another's."""
    for clear in KEPT:
        clear()
    trim()


def trim() -> None:
    """Give freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = column.buffers()
    off = np.frombuffer(buffers[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]
