"""Encode documents once, in id order, and concatenate and cut them into sequences.

``encoded`` range-partitions the texts by id, sorts each partition and encodes it;
every row keeps its partition and the ids before it there. Partition totals (one row
a partition) are summed twice, which gives global offsets without moving the ids
again: the tables are written in between.

``pack`` cuts the one long stream at multiples of ``length``. Only the last sequence
can be partly filled, so padding is under one sequence in all; a document that crosses
a cut has a piece on either side, and each piece is a boundary record.

Cases: a null or empty text has only its end id; rows that share an id follow each
other, ordered by text, each as a document of its own; null ids come first; a very
long text is one row of ids and as many pieces as it fills; an empty table gives no
rows. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, slices, text_bytes, written
from .tokens import encoder

PARTITION_BYTES = 24 << 20
BROADCAST_PARTS = 1 << 18     # 24 bytes each


def in_id_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, text)`` range-partitioned by id and sorted, in partitions of about
    ``PARTITION_BYTES``; ties are ordered by text."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    parts = max(shuffle_partitions(docs.sparkSession), -(-text_bytes(d) // PARTITION_BYTES))
    # rows of one id may lie on two partitions only when the text decides as well
    return d.repartitionByRange(parts, "doc_id", F.xxhash64("text")).sortWithinPartitions(
        "doc_id", F.xxhash64("text"), "text")


def encode_rows(path: str, end_id: int):
    """Arrow function: rows ``(doc_id, text)`` of a partition in order -> ids as bytes,
    the number of ids, the partition and the ids before the row in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        part = TaskContext.get().partitionId()
        end = np.array([end_id], enc.dtype).tobytes()
        before = 0
        for batch in batches:
            for piece in slices(batch):
                ids = [x + end for x in enc.encode(piece.column("text").to_pylist())]
                n = np.array([len(x) for x in ids], np.int64) // enc.dtype.itemsize
                local = before + np.cumsum(n) - n
                before += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(ids, pa.binary()), pa.array(n),
                     pa.array(np.full(len(ids), part, np.int32)), pa.array(local)],
                    names=["doc_id", "ids", "n", "part", "local"])

    return run


def encoded(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Written table ``doc_id, ids binary (little-endian, 2 bytes an id if the
    vocabulary allows, else 4), n, gstart`` with the global offset of every document."""
    rows = written(in_id_order(docs, id_col, text_col).mapInArrow(
        encode_rows(path, end_id), "doc_id long, ids binary, n long, part int, local long"), "ids")
    base = offsets(rows, "part", "n")
    # one row of a few bytes a partition: while they are few, the ids stay where they are
    if (rows.agg(F.max("part").alias("p")).first().p or 0) < BROADCAST_PARTS:
        base = F.broadcast(base)
    return rows.join(base, "part").select("doc_id", "ids", "n", (F.col("base") + F.col("local")).alias("gstart"))


def offsets(rows: DataFrame, part: str, n: str) -> DataFrame:
    """``part, base``: what all smaller parts hold. One row a part is summed."""
    totals = rows.groupBy(part).agg(F.sum(n).alias("total"))
    return totals.select(part, (F.sum("total").over(Window.orderBy(part)) - F.col("total")).alias("base"))


def _cut(length: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(0, batch.num_rows, 256):
                out = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")}
                some = batch.slice(r, 256)
                for doc, ids, n, g in zip(*(some.column(c).to_pylist() for c in ("doc_id", "ids", "n", "gstart"))):
                    wide = np.frombuffer(ids, f"<u{width}").astype("<u4").tobytes()
                    at = 0
                    while at < n:
                        seq, off = divmod(g + at, length)
                        take = min(length - off, n - at)
                        out["doc_id"].append(doc)
                        out["start"].append(at)
                        out["length"].append(take)
                        out["ids_crc32"].append(zlib.crc32(wide[at * 4:(at + take) * 4]))
                        out["doc_tokens"].append(n)
                        out["sequence_id"].append(seq)
                        out["offset"].append(off)
                        at += take
                yield pa.RecordBatch.from_pydict(out, schema=pa.schema([(k, pa.int64()) for k in out]))

    return run


def pack(docs: DataFrame, path: str, end_id: int = 1, length: int = 2048, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Boundary records of the packed stream: ``doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset``; sequence ``s`` holds ids ``[s * length, (s + 1) *
    length)`` of the concatenation."""
    width = encoder(path).dtype.itemsize
    return encoded(docs, path, end_id, id_col, text_col).mapInArrow(
        _cut(length, width), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                             "sequence_id long, offset long")
