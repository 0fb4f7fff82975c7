"""Which hashes of a corpus occur in more than one text, told to the texts themselves.

Texts are dealt into groups of a few MB by a hash of their row. Every group sends its
distinct hashes once, as packed 32-bit numbers by hash range (the range gives more
bits), so a hash that a third of all texts hold costs one number a group. A range
counts the groups that sent each number and answers with one byte a number: 0, or the
binary logarithm of the count. The answers meet their group again in a cogroup; the
texts are shuffled once, since both uses share that exchange.

Rows whose text also stands under a smaller id are copies. They are found first, by
partial aggregation over text digests, and travel as marks beside the texts.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions, text_bytes, written

GROUP_BYTES = 4 << 20
RANGE_BYTES = 8 << 20


def marked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(rows, copies)``. rows: ``doc_id, row_key, text, digest``; copies: ``doc_id,
    row_key, rep, blank`` of every row whose text also has the smaller id ``rep`` (smallest);
    ``blank`` says that the text is empty or all white space."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = d.select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"), "text", F.md5("text").alias("digest"),
                    (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"))
    ids = rows.select("doc_id", "row_key", "digest", "blank").filter("digest is not null and doc_id is not null")
    shared = (ids.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"))
              .filter("rep < last").select("digest", "rep"))
    copies = ids.join(shared, "digest").filter("doc_id > rep").select("doc_id", "row_key", "rep", "blank")
    return rows.select("doc_id", "row_key", "text"), written(copies, "copies")


def grouped(rows: DataFrame, copies: DataFrame) -> tuple[DataFrame, int]:
    """``(groups, ranges)``. groups: ``g, doc_id, row_key, text, mark`` dealt by ``g``;
    a marked row has no text and says that the row of that key is a copy."""
    size = text_bytes(rows)
    count = max(1, -(-size // GROUP_BYTES))
    g = F.pmod(F.xxhash64("row_key"), F.lit(count)).cast("int").alias("g")
    both = rows.select(g, "doc_id", "row_key", "text", F.lit(False).alias("mark")).unionByName(
        copies.select(g, "doc_id", "row_key", F.lit(None).cast("string").alias("text"), F.lit(True).alias("mark")))
    return (both.repartition(shuffle_partitions(rows.sparkSession), "g"), max(1, -(-size // RANGE_BYTES)))


def unmarked(group: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """Text rows of a group, and which of them are copies."""
    mark = np.asarray(group.column("mark").to_pylist(), bool)
    keys = group.column("row_key").to_numpy()
    return group.filter(pa.array(~mark)), np.isin(keys[~mark], keys[mark])


def _ranges(sorted_hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Cuts of a sorted hash array into the ranges (length ranges + 1)."""
    at = ((sorted_hashes >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    return np.searchsorted(at, np.arange(ranges + 1))


def repeat_classes(groups: DataFrame, ranges: int, distinct: Callable[[pa.Table, np.ndarray], np.ndarray]) -> DataFrame:
    """``g, r, classes``: for every group and range one byte for each of the group's
    distinct hashes in ascending order. ``distinct(rows, copies)`` gives those hashes;
    the same function must be used when the answers are read."""

    def send(group: pa.Table) -> pa.Table:
        own = distinct(*unmarked(group))
        cuts = _ranges(own, ranges)
        low = own.astype(np.uint32)
        used = np.flatnonzero(np.diff(cuts))
        g = group.column("g")[0].as_py()
        return pa.table({"g": pa.array(np.full(len(used), g, np.int32)), "r": pa.array(used.astype(np.int32)),
                         "low": pa.array([low[cuts[i]:cuts[i + 1]].tobytes() for i in used], pa.binary())})

    def count(part: pa.Table) -> pa.Table:
        blobs = part.column("low").to_pylist()
        low = np.frombuffer(b"".join(blobs), np.uint32)
        order = np.argsort(low, kind="stable")
        ranked = low[order]
        first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        times = np.diff(np.append(first, len(ranked)))
        classes = np.empty(len(low), np.uint8)
        classes[order] = np.repeat(np.log2(times).astype(np.uint8), times)
        ends = np.cumsum([len(b) // 4 for b in blobs])
        return pa.table({"g": part.column("g"), "r": part.column("r"),
                         "classes": pa.array([classes[e - len(b) // 4:e].tobytes() for b, e in zip(blobs, ends)],
                                             pa.binary())})

    sent = groups.groupBy("g").applyInArrow(send, "g int, r int, low binary")
    return sent.groupBy("r").applyInArrow(count, "g int, r int, classes binary")


def read_classes(own: np.ndarray, answer: pa.Table) -> np.ndarray:
    """Classes of a group's sorted distinct hashes from its answer rows."""
    if answer.num_rows == 0:
        return np.zeros(len(own), np.uint8)
    order = np.argsort(answer.column("r").to_numpy())
    blobs = answer.column("classes").to_pylist()
    out = np.frombuffer(b"".join(blobs[i] for i in order), np.uint8)
    if len(out) != len(own):
        raise ValueError("the answers do not fit the group")
    return out
