"""Helpers shared by the text operators: stored intermediates, ASCII lower case, hashing of whole Arrow batches."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.sources.storage import shared_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = "[ \\t-\\r]+"  # \x20 and \x09-\x0D, as a Java pattern
PIECE_BYTES = 1 << 20
_shipped: dict[str, str] = {}
RADIX = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` to the cluster's shared folder and read it back: lineage ends, sizes become known.  Also tells where it is."""
    path = f"{shared_folder(df.sparkSession)}/llm-{name}-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame, name: str) -> DataFrame:
    return stored_at(df, name)[0]


def forget(spark: SparkSession, path: str) -> None:
    """Delete a stored intermediate that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, where it need not be installed."""
    if _shipped.get("to") != spark.sparkContext.applicationId:
        package = Path(__file__).resolve().parents[1]
        folder = tempfile.mkdtemp(prefix="spark-")  # read by the driver alone, which hands the archive out
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name))
        _shipped["to"] = spark.sparkContext.applicationId


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` does the same, and faster, where the text is all ASCII."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """Maximal runs without white space (\\x20, \\x09-\\x0D); NULL has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where the body uses it in a loop."""
    return F.element_at(F.transform(F.array(value), body), 1)


def texts_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string column; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    if column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def pieces(offsets: np.ndarray, most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``most`` bytes, at least one row each, so that working memory is bounded."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, hi
        lo = hi


def _powers(size: int, known: list = []) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006  remembered between calls
    """The powers of RADIX and of its inverse; only the longest series asked for is remembered, up to a few pieces."""
    if known and len(known[0][0]) >= size:
        return known[0]
    size = -(-size // (1 << 18)) << 18
    up, down = np.full(size, RADIX, np.uint64), np.full(size, pow(RADIX, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    powers = np.multiply.accumulate(up, out=up), np.multiply.accumulate(down, out=down)
    if size <= 4 * PIECE_BYTES:
        known[:] = [powers]
    return powers


def prefix_sums_of(values: np.ndarray) -> np.ndarray:
    """Sums of ``value * RADIX^position`` (modulo 2^64) before each position."""
    up, _ = _powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return sums


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """``prefix_sums_of`` the bytes plus one."""
    return prefix_sums_of(data.astype(np.uint64) + np.uint64(1))


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans; equal spans hash alike wherever they stand."""
    _, down = _powers(len(sums))
    return mixed((sums[ends] - sums[starts]) * down[starts])


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def tokens(kind: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of one non-zero ``kind`` inside one text: starts, ends and the number of tokens before each text."""
    edge = np.zeros(len(kind) + 1, bool)
    edge[0] = edge[-1] = True
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[offsets] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    real = kind[starts] != 0 if len(kind) else np.zeros(0, bool)
    starts, ends = starts[real], ends[real]
    return starts, ends, np.searchsorted(starts, offsets)


def sums_by(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive ``bounds``; empty ranges give zero."""
    total = np.zeros(len(values) + 1, np.float64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
