"""Helpers shared by the operators: scratch tables, Arrow slices, byte hashing.

Everything that runs in a task works on a bounded slice of an Arrow batch, so
the memory of a worker does not depend on the size of a partition.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import COMPRESSION, scratch_path, shuffles_freed

SLICE_BYTES = PIECE = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: the plan
    behind it is cut, and lost executors do not take the rows with them."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    with shuffles_freed(spark):
        df.write.parquet(path, compression=COMPRESSION)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_path = path
    return table


def forget(*tables: DataFrame) -> None:
    """Delete tables of ``written`` once the last table that reads them has been written."""
    for df in tables:
        spark = df.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(df.written_path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """Bytes of all texts (one number)."""
    return int(docs.agg(F.sum(F.octet_length(text_col)).alias("b")).first().b or 0)


def bounded_sample(rows: DataFrame, n: int, by: list[str]) -> DataFrame:
    """At most ``n`` rows, those with the smallest hash of the columns ``by``. A threshold
    on the hash, from the number of rows, first leaves about ``2 * n`` of them, so that
    what the tasks send on does not grow with their number."""
    total = rows.count()
    span = 1 << 30
    key = F.xxhash64(*by)
    few = rows.filter(F.pmod(key, F.lit(span)) < F.lit(min(span, -(-2 * n * span // max(total, 1)))))
    return few.orderBy(F.pmod(key, F.lit(span)), key, *by).limit(n)


def strings(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its row offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offs, data = column.buffers()
    n = len(column)
    if n == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(offs, np.int64)[column.offset:column.offset + n + 1]
    lo, hi = int(offsets[0]), int(offsets[-1])
    body = np.frombuffer(data, np.uint8)[lo:hi] if data is not None else np.zeros(0, np.uint8)
    return body, offsets - lo


def slices(batch, text_col: str = "text", limit: int = SLICE_BYTES) -> Iterator:
    """Cut a record batch (or table) into runs of rows of about ``limit`` text
    bytes; a longer text is a run of its own."""
    n = batch.num_rows
    if n == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_pylist()
    start, used = 0, 0
    for i in range(n):
        if i > start and used + sizes[i] > limit:
            yield batch.slice(start, i - start)
            start, used = i, 0
        used += sizes[i]
    yield batch.slice(start, n - start)


# --- hashing of byte ranges ---------------------------------------------------
# A range [i, j) of a byte array hashes to sum(T[byte] * R^(k - i)) mod 2^64, from
# one running sum; T is a table of seeded random numbers.

_MULT = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            up = np.full(size, _MULT, np.uint64)
            up[0] = 1
            down = np.full(size, _INV, np.uint64)
            down[0] = 1
            _POWERS[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _POWERS[0][:n], _POWERS[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every ``data[start:end]``; it depends on the bytes alone. Long data are
    worked through by the piece in which the ranges start."""
    if len(data) > 2 * PIECE and len(starts):
        out = np.empty(len(starts), np.uint64)
        piece = starts // PIECE
        for p in np.unique(piece):
            own = np.flatnonzero(piece == p)
            a, b = int(p) * PIECE, int(ends[own].max())
            if b - a > 2 * PIECE:  # a range longer than a piece
                out[own] = _range_hashes(data[a:b], starts[own] - a, ends[own] - a)
            else:
                out[own] = range_hashes(data[a:b], starts[own] - a, ends[own] - a)
        return out
    return _range_hashes(data, starts, ends)


def _range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = _powers(len(data) + 1)
    with np.errstate(over="ignore"):
        run = np.empty(len(data) + 1, np.uint64)
        run[0] = 0
        np.cumsum(_BYTES[data] * up[:-1], out=run[1:])
        return mix((run[ends] - run[starts]) * down[starts])


def window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """64-bit hash of every run of ``width`` bytes of ``data``."""
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _powers(len(data) + 1)
    with np.errstate(over="ignore"):
        run = np.empty(len(data) + 1, np.uint64)
        run[0] = 0
        np.cumsum(_BYTES[data] * up[:-1], out=run[1:])
        return mix((run[width:] - run[:n]) * down[:n])


# --- words -----------------------------------------------------------------------

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def separators(word_bytes) -> np.ndarray:
    """Boolean table over bytes: True where the byte is part of no word."""
    sep = np.ones(256, bool)
    sep[list(word_bytes)] = False
    return sep


def word_ranges(data: np.ndarray, offsets: np.ndarray, sep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of every row, and the index of each row's first
    word (length rows + 1). Words never cross rows."""
    if len(data) == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    is_sep = sep[data]
    before = np.empty(len(data), bool)
    before[0] = True
    before[1:] = is_sep[:-1]
    after = np.empty(len(data), bool)
    after[-1] = True
    after[:-1] = is_sep[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    before[cuts] = True
    after[cuts - 1] = True
    starts = np.flatnonzero(~is_sep & before)
    ends = np.flatnonzero(~is_sep & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_MIXERS = np.random.default_rng(77).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` word hashes, whatever row it lies in."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.full(n, np.uint64(k) * _MIXERS[63], np.uint64)
        for i in range(k):
            out += words[i:i + n] * _MIXERS[i % 63]
    return mix(out)
