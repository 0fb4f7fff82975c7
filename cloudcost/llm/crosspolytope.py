"""Approximate nearest neighbours by cross-polytope hashing.

A unit vector is turned by a pseudo-random rotation (three rounds of random signs
and a fast Hadamard transform) and hashed to the signed axis it is nearest to. Each
of ``tables`` rotations gives one table; a query visits the ``probes`` nearest signed
axes of every table, and all vectors found there are ranked by their exact cosine in
double precision.

Every vector is indexed. How many tables and probes that takes depends on the vectors:
``calibrated`` compares the axes of queries and true neighbours in a sample of at most
``SAMPLE`` vectors and takes the cheapest choice whose recall there is ``RECALL``. Neighbours
in a sample are farther than in the whole, so the whole does no worse. Where no choice
visits less than every vector once (near random vectors of many dimensions), the axes are
left out and queries meet all vectors, dealt into ``SLOTS`` slots: an exact scan in blocks.
Queries that find fewer than ``k`` vectors are scanned for in the same way: none is left with
less than there is.

Vectors of a bucket travel as blocks of bounded size, in the precision they are stored
in, and so do the queries that probe it. A block's rows of a crowded axis (many equal
vectors) are dealt out under ``SALTS`` keys, to all of which its queries go, so that it is
several tasks. A task returns at most ``k`` rows a query.

Cases: vectors that are null, empty, zero, of another length than most rows of the
table have (the smallest such length on ties), or that hold null or non-finite
components take no part; rows that share an id are one candidate, with its best score,
and never their own neighbour; ties go to the smaller id; with fewer than ``k``
candidates all are returned; rows without id take no part; an empty table gives no
rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, written

BLOCK = 8192
CROWDED = BLOCK // 16         # rows of a block on one axis
SALTS, SLOTS = 4, 64
SAMPLE, ASKED, RECALL = 4000, 200, 0.96
MOST_TABLES, MOST_PROBES = 16, 32
EVERY = 0  # probes of an exact scan


def _hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows (power-of-two width), orthonormal."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def rotate(x: np.ndarray, t: int, seed: int) -> np.ndarray:
    """Pseudo-rotation ``t`` of the rows; the width grows to a power of two."""
    width = 1 << max(1, (x.shape[1] - 1).bit_length())
    if width > x.shape[1]:
        x = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    rng = np.random.default_rng((seed, t))
    for _ in range(3):
        x = _hadamard(x * rng.choice((-1.0, 1.0), width))
    return x


def signed_axes(x: np.ndarray, probes: int) -> np.ndarray:
    """The ``probes`` nearest signed axes of every row, nearest first."""
    both = np.concatenate([x, -x], axis=1)
    probes = min(probes, both.shape[1])
    if probes == 1:
        return both.argmax(1)[:, None]
    near = np.argpartition(-both, probes - 1, axis=1)[:, :probes]
    return np.take_along_axis(near, np.argsort(-np.take_along_axis(both, near, 1), axis=1, kind="stable"), 1)


def _matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    ids = batch.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
    col = batch.column("v")
    return ids, col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(ids), -1)


def _hashed(role: str, tables: int, probes: int, seed: int, kind: str):
    """Blocks of vectors by (table, signed axis, salt); queries go to all salts. With ``EVERY``
    for probes the slots of an exact scan stand for the axes, and queries go to all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                ids, x = _matrix(batch.slice(at, BLOCK))
                unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                out = {"t": [], "axis": [], "salt": [], f"{role}_ids": [], f"{role}_vecs": []}
                for t in range(tables):
                    if probes == EVERY:
                        axes = ids[:, None] % SLOTS if role == "v" else np.tile(np.arange(SLOTS), (len(ids), 1))
                    else:
                        axes = signed_axes(rotate(unit, t, seed), 1 if role == "v" else probes)
                    rows = np.repeat(np.arange(len(ids)), axes.shape[1])
                    flat = axes.ravel().astype(np.int64)
                    crowded = (np.bincount(flat)[flat] > CROWDED) & (role == "v")
                    flat = flat * SALTS + np.where(crowded, ids[rows] // SLOTS % SALTS, 0)
                    order = np.argsort(flat, kind="stable")
                    cuts = np.flatnonzero(np.diff(flat[order])) + 1
                    for part in np.split(order, cuts):
                        axis, own = divmod(int(flat[part[0]]), SALTS)
                        packed = ids[rows[part]].tobytes(), x[rows[part]].astype(kind).tobytes()
                        for s in (own,) if role == "v" else range(SALTS):
                            out["t"].append(t)
                            out["axis"].append(axis)
                            out["salt"].append(s)
                            out[f"{role}_ids"].append(packed[0])
                            out[f"{role}_vecs"].append(packed[1])
                yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                    ("t", pa.int32()), ("axis", pa.int32()), ("salt", pa.int32()), (f"{role}_ids", pa.binary()),
                    (f"{role}_vecs", pa.binary())]))

    return run


def _best(qids, vids, scores, k):
    """At most k best (score, then smaller id) of every query row; own id excluded."""
    scores = np.where(vids[None, :] == qids[:, None], -np.inf, scores)
    if scores.shape[1] > 4 * k:  # keep everything that ties with the k-th
        kth = -np.partition(-scores, k - 1, axis=1)[:, k - 1:k]
        keep = (scores >= kth) & (scores > -np.inf)
    else:
        keep = scores > -np.inf
    qi, vi = np.nonzero(keep)
    return _first_k(qids[qi], vids[vi], scores[qi, vi], k)


def _top(found: list, k: int) -> list:
    """The k best different vectors of every query of the finds so far."""
    q, v, s = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((-s, v, q))
    q, v, s = q[order], v[order], s[order]
    new = np.concatenate([[True], (q[1:] != q[:-1]) | (v[1:] != v[:-1])]) if len(q) else np.zeros(0, bool)
    return [_first_k(q[new], v[new], s[new], k)]


def _first_k(q, v, s, k):
    order = np.lexsort((v, -s, q))
    q, v, s = q[order], v[order], s[order]
    top = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[top], v[top], s[top]


def _ranked(k: int, kind: str):
    """Rank block pairs; a task keeps k finds a query, however many blocks it sees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                q, v = (np.frombuffer(batch.column(c)[i].as_buffer(), np.int64) for c in ("q_ids", "v_ids"))
                qx, vx = (np.frombuffer(batch.column(c)[i].as_buffer(), kind).astype(np.float64).reshape(len(n), -1)
                          for c, n in (("q_vecs", q), ("v_vecs", v)))
                norm = np.sqrt(np.einsum("ij,ij->i", qx, qx))[:, None] * np.sqrt(np.einsum("ij,ij->i", vx, vx))[None, :]
                found.append(_best(q, v, np.einsum("ij,kj->ik", qx, vx) / norm, k))
                held += len(found[-1][0])
                if held > 200_000:
                    found = _top(found, k)
                    held = 0
        if found:
            a, b, s = _top(found, k)[0]
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(s)],
                                             names=["query_id", "vec_id", "score"])

    return run


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(id, v array<double>)`` of the rows that can take part."""
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    v = v.filter(F.col("id").isNotNull() & (F.size("v") > 0)
                 & F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
                 & F.exists("v", lambda c: c != 0))
    width = v.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).select("n").first()
    return v.filter(F.size("v") == F.lit(width.n if width else 0))


def calibrated(rows: DataFrame, k: int, seed: int) -> tuple[int, int]:
    """Tables and probes for these vectors (see the top). The sample is at most ``SAMPLE``
    rows, chosen by a hash of their ids; ``ASKED`` of them are its queries."""
    some = bounded_sample(rows.select("id", "v"), SAMPLE, ["id"]).collect()
    if len(some) <= 10 * k:
        return 1, EVERY
    x = np.array([r.v for r in some], np.float64)
    axes = 2 << max(1, (x.shape[1] - 1).bit_length())
    x /= np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
    cosine = x[:ASKED] @ x.T
    np.fill_diagonal(cosine, -np.inf)
    true = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
    least, best = np.full(true.shape, axes), (1.0, 1, EVERY)
    for t in range(MOST_TABLES):
        turned = rotate(x, t, seed)
        home = signed_axes(turned, 1)[:, 0]
        place = np.argsort(signed_axes(turned[:ASKED], axes), axis=1)  # of every axis in the query's order
        least = np.minimum(least, np.take_along_axis(place, home[true], 1))
        probes = int(np.quantile(least, RECALL, method="higher")) + 1
        if probes <= MOST_PROBES:  # a query is sent once a probe
            best = min(best, ((t + 1) * (probes / axes + 0.01), t + 1, probes))  # share of all pairs, making a table
    return best[1:]


def _found(rows: DataFrame, asked: DataFrame, k: int, tables: int, probes: int, seed: int, kind: str) -> DataFrame:
    """``query_id, vec_id, score``: what the queries ``asked`` find."""
    index = rows.mapInArrow(_hashed("v", tables, probes, seed, kind), "t int, axis int, salt int, v_ids binary, v_vecs binary")
    queries = asked.mapInArrow(_hashed("q", tables, probes, seed, kind),
                               "t int, axis int, salt int, q_ids binary, q_vecs binary")
    found = (index.join(queries, ["t", "axis", "salt"]).select("q_ids", "q_vecs", "v_ids", "v_vecs")
             .mapInArrow(_ranked(k, kind), "query_id long, vec_id long, score double"))
    # each task gives at most k rows a query; a pair found in several tables collapses
    return found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))


def nearest(vectors: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5,
            tables: int | None = None, probes: int | None = None, seed: int = 9) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found for every row whose
    id satisfies ``is_query`` (a function of the id column). Tables and probes that are not
    given are calibrated."""
    rows = usable(vectors, id_col, vec_col)
    # the stored precision loses nothing and is half the bytes for 32-bit floats
    kind = "<f4" if vectors.schema[vec_col].dataType.simpleString() == "array<float>" else "<f8"
    if tables is None or probes is None:
        tables, probes = calibrated(rows, k, seed)
    asked = rows.filter(is_query(F.col("id")))
    first = written(_found(rows, asked, k, tables, probes, seed, kind), "neighbours")
    # queries with fewer than k finds visit every vector
    enough = first.groupBy("query_id").count().filter(F.col("count") >= k).select(F.col("query_id").alias("id"))
    rest = asked.join(enough, "id", "left_anti")
    distinct = first
    if probes != EVERY and not rest.isEmpty():
        every = _found(rows, rest, k, 1, EVERY, seed, kind)
        distinct = first.unionByName(every).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    entries = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("low"), "vec_id", "score"))), 1, k)
    return (distinct.groupBy("query_id").agg(entries.alias("e"))
            .select("query_id", F.posexplode("e").alias("p", "x"))
            .select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"),
                    F.col("x.score").alias("score")))
