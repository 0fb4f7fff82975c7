"""Token ids as binary files with Elias-Fano document boundaries.

A shard is one file of at most about ``SHARD_IDS`` ids: the ids of its documents,
concatenated, then two Elias-Fano sequences, the boundaries between the documents and
the document ids. Bytes of a shard (little-endian):

    magic "EFT1" | u4 partition | u4 shard number in it | u1 bytes an id | u4 rows |
    u4 rows without document id | ids | sequence of rows + 1 boundaries |
    sequence of document ids (less the smallest, an i8 before it) | newline

An Elias-Fano sequence of n sorted numbers below u keeps ``l = floor(log2(u / n))``
low bits of each, packed, and the high parts in unary: one set bit a number in
``n + (u >> l) + 1`` bits. ``select`` finds the k-th set bit through the number of set
bits before every 512-bit block (u4 each) and a look inside one block, so an offset
takes about ``2 + log2(u / n)`` bits and no table of 64-bit offsets exists.

Spark's text writer puts the bytes into the shared folder, with its commit protocol
(a lost executor leaves nothing half-written), and the binaryFile source reads them
back, so both work on any store Spark knows.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import slices
from .packing import in_id_order
from .tokens import encoder

SHARD_IDS = 1 << 21
MAGIC = b"EFT1"
_BLOCK = 512
_HEAD = "<IIBII"
_HEAD_BYTES = struct.calcsize(_HEAD)


class EliasFano:
    """Sorted non-negative numbers in near-minimal space, with random access."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        ones = np.unpackbits(high, bitorder="little").reshape(-1, _BLOCK).sum(1, dtype=np.uint32)
        self.before = np.concatenate([[0], np.cumsum(ones, dtype=np.uint32)]).astype(np.uint32)

    @classmethod
    def of(cls, values: np.ndarray) -> "EliasFano":
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        low = np.packbits(((values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1))
                          .astype(np.uint8).ravel(), bitorder="little")
        at = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(-(-((int(at[-1]) + 1) if n else 1) // _BLOCK) * _BLOCK, np.uint8)
        bits[at] = 1
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little"))

    def tobytes(self) -> bytes:
        return struct.pack("<IBII", self.n, self.low_bits, len(self.low), len(self.high)) \
            + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def frombytes(cls, raw: bytes, at: int) -> tuple["EliasFano", int]:
        n, low_bits, a, b = struct.unpack_from("<IBII", raw, at)
        at += 13
        low = np.frombuffer(raw, np.uint8, a, at)
        high = np.frombuffer(raw, np.uint8, b, at + a)
        return cls(n, low_bits, low, high), at + a + b

    def select(self, k: np.ndarray) -> np.ndarray:
        """Positions of the k-th set bits (from 0)."""
        k = np.asarray(k, np.int64)
        block = np.searchsorted(self.before, k, side="right") - 1
        bits = np.unpackbits(self.high.reshape(-1, _BLOCK // 8)[block], axis=1, bitorder="little")
        rank = np.cumsum(bits, axis=1, dtype=np.int32)
        inside = (rank <= (k - self.before[block])[:, None]).sum(1)
        return block * _BLOCK + inside

    def get(self, k: np.ndarray) -> np.ndarray:
        """The k-th numbers."""
        k = np.asarray(k, np.int64)
        out = np.empty(len(k), np.int64)
        for at in range(0, len(k), 4096):
            part = k[at:at + 4096]
            high = self.select(part) - part
            value = np.zeros(len(part), np.int64)
            for b in range(self.low_bits):
                bit = part * self.low_bits + b
                value |= ((self.low[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1).astype(np.int64) << b
            out[at:at + 4096] = (high << self.low_bits) | value
        return out


def build_shard(part: int, number: int, width: int, doc_ids: list, ids: list[bytes]) -> bytes:
    """One shard of rows in ascending id order, rows without id first."""
    bounds = np.concatenate([[0], np.cumsum([len(x) // width for x in ids])])
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    least = int(known[0]) if len(known) else 0
    gaps = known.astype(object) - least if len(known) and int(known[-1]) - least > (1 << 62) else known - least
    return b"".join([
        MAGIC, struct.pack(_HEAD, part, number, width, len(ids), len(ids) - len(known)), *ids,
        EliasFano.of(bounds).tobytes(), struct.pack("<q", least),
        EliasFano.of(np.array(gaps, np.uint64)).tobytes()])


class Shard:
    """Random access to a shard's documents."""

    def __init__(self, raw: bytes):
        if raw[:4] != MAGIC:
            raise ValueError("not a token shard")
        self.part, self.number, self.width, self.rows, self.nulls = struct.unpack_from(_HEAD, raw, 4)
        self.raw, self.body = raw, 4 + _HEAD_BYTES
        # the boundaries follow the ids; their end is found from the back
        tail = struct.unpack_from("<I", raw, len(raw) - 4)[0]
        self.bounds, at = EliasFano.frombytes(raw, tail)
        self.least = struct.unpack_from("<q", raw, at)[0]
        self.ids_ef, _ = EliasFano.frombytes(raw, at + 8)

    def offsets(self) -> np.ndarray:
        return self.bounds.get(np.arange(self.rows + 1))

    def doc_ids(self) -> list:
        known = self.ids_ef.get(np.arange(self.ids_ef.n)) + self.least
        return [None] * self.nulls + known.tolist()

    def ids(self, row: int) -> np.ndarray:
        lo, hi = self.bounds.get(np.array([row, row + 1]))
        return np.frombuffer(self.raw, f"<u{self.width}", int(hi - lo), self.body + int(lo) * self.width)


def _shards(path: str, end_id: int, shard_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        part, width = TaskContext.get().partitionId(), enc.dtype.itemsize
        end = np.array([end_id], enc.dtype).tobytes()
        docs: list = []
        ids: list[bytes] = []
        held = number = 0

        def shard() -> pa.RecordBatch:
            raw = build_shard(part, number, width, docs, ids)
            tail = 4 + _HEAD_BYTES + sum(map(len, ids))
            return pa.RecordBatch.from_arrays([pa.array([raw + struct.pack("<I", tail)], pa.binary())], names=["raw"])

        for batch in batches:
            for piece in slices(batch):
                for d, x in zip(piece.column("doc_id").to_pylist(), enc.encode(piece.column("text").to_pylist())):
                    x += end
                    if ids and held + len(x) // width > shard_ids:
                        yield shard()
                        docs, ids, held, number = [], [], 0, number + 1
                    docs.append(d)
                    ids.append(x)
                    held += len(x) // width
        if ids:
            yield shard()

    return run


def write_shards(docs: DataFrame, out: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                 shard_ids: int = SHARD_IDS) -> None:
    """Encode every text (null: empty), append ``end_id`` and write shard files below
    ``out``, in ascending id order over partitions and shards."""
    rows = in_id_order(docs, id_col, text_col).mapInArrow(_shards(path, end_id, shard_ids), "raw binary")
    (rows.select(F.col("raw").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", 1).option("compression", "none").text(out))


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            raw = batch.column("content")[i].as_buffer().to_pybytes()[:-1]  # the writer's newline
            s = Shard(raw)
            bounds = s.offsets()
            all_ids = np.frombuffer(raw, f"<u{s.width}", int(bounds[-1]), s.body)
            crc = [zlib.crc32(all_ids[a:b].astype("<u4").tobytes()) for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(s.doc_ids(), pa.int64()), pa.array(np.full(s.rows, s.part, np.int32)),
                 pa.array(np.full(s.rows, s.number, np.int32)), pa.array(bounds[:-1]), pa.array(np.diff(bounds)),
                 pa.array(crc, pa.int64())], names=["doc_id", "part", "shard", "local", "n_tokens", "ids_crc32"])


def read_documents(spark: SparkSession, out: str) -> DataFrame:
    """``doc_id, part, shard, local, n_tokens, ids_crc32`` of every document in the files;
    ``local`` is its offset in its shard."""
    files = spark.read.format("binaryFile").load(out).filter(F.length("content") > 1).select("content")
    return files.mapInArrow(_documents, "doc_id long, part int, shard int, local long, n_tokens long, ids_crc32 long")


def with_starts(rows: DataFrame) -> DataFrame:
    """Adds ``start``, the ids of all documents before: shard totals are summed inside
    partitions, partition totals (one row each) over them."""
    shards = rows.groupBy("part", "shard").agg(F.sum("n_tokens").alias("n"))
    parts = shards.groupBy("part").agg(F.sum("n").alias("pn"))
    bases = parts.select("part", (F.sum("pn").over(Window.orderBy("part")) - F.col("pn")).alias("pbase"))
    inner = shards.select("part", "shard", (F.sum("n").over(Window.partitionBy("part").orderBy("shard"))
                                            - F.col("n")).alias("sbase"))
    return rows.join(inner.join(bases, "part"), ["part", "shard"]).withColumn(
        "start", F.col("pbase") + F.col("sbase") + F.col("local"))


def round_trip(docs: DataFrame, path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
               shard_ids: int = SHARD_IDS) -> DataFrame:
    """Write the shards to the shared folder, read them back and return per document
    ``doc_id, start, n_tokens, ids_crc32, part, shard``.

    Cases: a null or empty text has only the end id; rows that share an id are documents
    of their own, ordered by text; rows without id come first; a text longer than a
    shard is a shard of its own; an empty table gives no rows. Extra columns are ignored.
    """
    from .common import written
    spark = docs.sparkSession
    out = scratch_path(spark, f"llm-shards-{uuid.uuid4().hex}")
    write_shards(docs, out, path, end_id, id_col, text_col, shard_ids)
    rows = written(read_documents(spark, out), "shard-documents")
    return with_starts(rows).select("doc_id", "start", "n_tokens", "ids_crc32", "part", "shard")
