"""Shared helpers of the corpus operators: text buffers, ASCII folding, hashing, staging."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast import session

__all__ = ["stage", "table", "ascii_lower", "text_chunks", "mix64", "buckets_for", "same_key", "carried", "release_memory", "freed"]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder; the write's shuffle files go when it ends, as the table replaces them."""
    conf = df.sparkSession.conf
    before = conf.get(RELEASE)
    conf.set(RELEASE, "true")
    try:
        return session.stage(df)
    finally:
        conf.set(RELEASE, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only.

    ``lower`` agrees with that on texts whose other characters are ASCII or
    lower-case Latin-1 letters, and is several times faster than ``translate``.
    """
    plain = ~c.rlike(r"[^\x00-\x7Fß-öø-ÿ]")
    return F.when(plain, F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def carried(df: DataFrame, carry: list[Column | str], results: list[str]) -> list[Column]:
    """The columns to carry; one named like a result column becomes ``input_<name>``."""
    names = df.select(*carry).columns
    cols = [F.col(f"`{c}`") if isinstance(c, str) else c for c in carry]
    return [c.alias(f"input_{n}") if n in results else c for c, n in zip(cols, names)]


def same_key(df: DataFrame, other: DataFrame, cols: list[str]) -> Column:
    """Null-safe equality of ``cols`` in both frames."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & df[c].eqNullSafe(other[c])
    return cond


def buckets_for(n_bytes: int, per_bucket: int, least: int) -> int:
    """Number of hash buckets so that one holds about ``per_bucket`` bytes."""
    return max(least, -(-int(n_bytes or 0) // per_bucket))


def release_memory() -> None:
    """Give back what freed buffers hold of this process, if the platform can: the driver and the workers of tasks live on after their local work."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def freed(work: Callable, *given):
    """What ``work`` returns; all else that it held goes back, as the worker of a task waits for others."""
    try:
        return work(*given)
    finally:
        release_memory()


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (works on a copy)."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def text_chunks(column: pa.Array, max_bytes: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, end row, UTF-8 bytes, row offsets) for runs of whole texts.

    A run holds at most ``max_bytes`` unless one text alone is longer.  Nulls
    are empty.  The arrays are views of the Arrow buffers.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0) if column.num_chunks else pa.array([], pa.large_string())
    n = len(column)
    if not n:
        return
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, off_buf, data = column.buffers()
    offs = np.frombuffer(off_buf, dtype=np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + max_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, raw[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi
