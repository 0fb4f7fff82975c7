"""Vector codes: product quantisation by Lloyd's rounds over partition-local cover trees.

Components become whole numbers, ``floor(SCALE * x)``; vectors are cut into ``parts`` equal
consecutive pieces, each with a codebook of its own. Every slice of a partition builds one
cover tree for each part, once, and the trees are written. A node covers its points within
a radius about a point of the slice; its points lie side by side, so the sum over a subtree
is the difference of two cumulative sums.

A round takes the codebooks (a fixed, small number of entries) to the trees. With ``a`` the
nearest entry to a node's centre and ``r`` its radius, the triangle inequality gives every
point of the node to ``a`` when ``d(a) + r < d(b) - r`` for all other ``b``; only nodes for
which that fails descend, and only points of such leaves are compared one by one. Sums and
counts by (part, entry) meet in one aggregation of ``parts * entries`` rows a task. All
arithmetic that decides is on whole numbers, so the result is that of the plain rounds.

Cases: rows whose vector is null, empty, or holds null or non-finite components are dropped;
so are vectors of another length than most kept rows have (the smallest such length on
ties); a length that ``parts`` does not divide is filled with zeros at the end; the
codebooks start from the smallest ids, rows that share an id in the order of their
components, rows without an id last; with fewer kept rows than entries the codebooks are
shorter; equal distances go to the lower entry; an entry without points stays; repeated
rows are rows of their own; null labels are one label; an empty table gives no rows.
Components beyond 2^24 are computed in Python integers: exact, slower; an error beyond a
long integer fails. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, written

SCALE = 4096
SLICE = 4096
LEAF = 12
SAFE = 1 << 24
LABEL_SALTS = 16


# --- rows --------------------------------------------------------------------------

def usable(vectors: DataFrame, id_col: str, vec_col: str, label_col: str | None) -> DataFrame:
    """``id, label, v array<double>`` of the rows that are kept."""
    label = F.col(label_col).cast("string") if label_col else F.lit(None).cast("string")
    v = vectors.select(F.col(id_col).cast("long").alias("id"), label.alias("label"),
                       F.col(vec_col).cast("array<double>").alias("v"))
    v = v.filter((F.size("v") > 0) & F.forall(
        "v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))))
    width = v.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).first()
    return v.filter(F.size("v") == F.lit(width.n if width else 0))


def whole_numbers(x: np.ndarray, parts: int) -> np.ndarray:
    """``floor(SCALE * x)`` with a width that ``parts`` divides; Python integers when a
    component is too large for exact sums of squares in 64 bits."""
    scaled = np.floor(x * float(SCALE))
    if scaled.shape[1] % parts:
        scaled = np.pad(scaled, ((0, 0), (0, parts - scaled.shape[1] % parts)))
    if scaled.size and np.abs(scaled).max() > SAFE:
        return np.array([[int(c) for c in row] for row in scaled], dtype=object).reshape(scaled.shape)
    return scaled.astype(np.int64)


# --- cover trees -------------------------------------------------------------------

class CoverTree:
    """Nodes in breadth-first order over the points of one part of one slice.

    ``order``: points so that those of a node are ``order[lo:hi]``; ``centre``: a point of
    the node; ``radius``: the largest distance from it; children of a node are the nodes
    ``first .. first + kids - 1``; ``sums[i]``: component sums of the first ``i`` points."""

    def __init__(self, points: np.ndarray):
        self.points = points
        near = points.astype(np.float64)
        order = np.arange(len(points))
        self.lo, self.hi, self.centre, self.radius, self.first, self.kids = ([] for _ in range(6))
        scale = float(np.sqrt(((near - near[0]) ** 2).sum(1)).max()) if len(points) else 0.0
        queue = [(0, len(points), 0, scale)] if len(points) else []
        at = 0
        while at < len(queue):
            lo, hi, centre, scale = queue[at]
            at += 1
            own = order[lo:hi]
            away = np.sqrt(((near[own] - near[centre]) ** 2).sum(1))
            radius = float(away.max())
            self.lo.append(lo)
            self.hi.append(hi)
            self.centre.append(centre)
            self.radius.append(radius)
            if radius == 0.0 or hi - lo <= LEAF:
                self.first.append(0)
                self.kids.append(0)
                continue
            # children: a net whose members are more than half the radius apart, each
            # point with the first member that covers it
            half = min(scale, radius) / 2.0
            members, centres, rest = [], [centre], own
            while True:
                covered = away <= half
                members.append(rest[covered])
                rest = rest[~covered]
                if not len(rest):
                    break
                centres.append(int(rest[0]))
                away = np.sqrt(((near[rest] - near[centres[-1]]) ** 2).sum(1))
            order[lo:hi] = np.concatenate(members)
            self.first.append(len(queue))
            self.kids.append(len(centres))
            for c, m in zip(centres, members):
                queue.append((lo, lo + len(m), c, half))
                lo += len(m)
        self.order = order
        self._seal()

    def _seal(self) -> None:
        for name in ("lo", "hi", "centre", "first", "kids"):
            setattr(self, name, np.asarray(getattr(self, name), np.int64))
        # distances above are rounded: a little more is always enough
        self.radius = np.asarray(self.radius, np.float64) * (1 + 1e-9)
        self.sums = np.zeros((len(self.points) + 1, self.points.shape[1]), self.points.dtype)
        np.cumsum(self.points[self.order], axis=0, out=self.sums[1:])

    NUMBERS = ("order", "lo", "hi", "centre", "first", "kids")

    def pack(self) -> list[bytes]:
        return [getattr(self, n).astype(np.int32).tobytes() for n in self.NUMBERS] + [self.radius.tobytes()]

    @classmethod
    def unpack(cls, points: np.ndarray, blobs: list[bytes]) -> CoverTree:
        tree = cls.__new__(cls)
        tree.points = points
        for n, b in zip(cls.NUMBERS, blobs):
            setattr(tree, n, np.frombuffer(b, np.int32).astype(np.int64))
        tree.radius = np.frombuffer(blobs[-1], np.float64) / (1 + 1e-9)
        tree._seal()
        return tree

    def assign(self, book: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
        """Whole subtrees as ``(lo, hi, entry)`` and single points as ``(point, entry)``."""
        subtrees, points, entries = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        nodes = np.zeros(min(1, len(self.lo)), np.int64)
        while len(nodes):
            squares = distances(self.points[self.centre[nodes]], book)
            nearest = squares.argmin(1)
            d = np.sqrt(squares.astype(np.float64))
            r = self.radius[nodes]
            mine = np.take_along_axis(d, nearest[:, None], 1)[:, 0]
            np.put_along_axis(d, nearest[:, None], np.inf, 1)
            other = d.min(1)
            sure = (r == 0) | (mine + r < other - r - 1e-6 * (1 + mine + r))
            subtrees.append((self.lo[nodes[sure]], self.hi[nodes[sure]], nearest[sure]))
            open_ = nodes[~sure]
            leaves = open_[self.kids[open_] == 0]
            if len(leaves):
                own = self.order[_runs(self.lo[leaves], self.hi[leaves] - self.lo[leaves])]
                points.append(own)
                entries.append(distances(self.points[own], book).argmin(1))
            inner = open_[self.kids[open_] > 0]
            nodes = _runs(self.first[inner], self.kids[inner])
        return subtrees, np.concatenate(points), np.concatenate(entries)

    def round(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Component sums and counts of every entry's points."""
        subtrees, points, entries = self.assign(book)
        sums = np.zeros((len(book), self.points.shape[1]), self.points.dtype)
        counts = np.zeros(len(book), np.int64)
        for lo, hi, entry in subtrees:
            np.add.at(sums, entry, self.sums[hi] - self.sums[lo])
            np.add.at(counts, entry, hi - lo)
        np.add.at(sums, entries, self.points[points])
        np.add.at(counts, entries, 1)
        return sums, counts

    def codes(self, book: np.ndarray) -> np.ndarray:
        """The entry of every point."""
        subtrees, points, entries = self.assign(book)
        out = np.empty(len(self.points), np.int64)
        for lo, hi, entry in subtrees:
            out[self.order[_runs(lo, hi - lo)]] = np.repeat(entry, hi - lo)
        out[points] = entries
        return out


def _runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All of ``start, start + 1, ...`` of every run, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def distances(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances, points by entries."""
    out = np.zeros((len(points), len(book)), object if object in (points.dtype, book.dtype) else np.int64)
    for c in range(points.shape[1]):
        gap = points[:, c:c + 1] - book[None, :, c]
        out = out + gap * gap
    return out


# --- rounds ------------------------------------------------------------------------

def _ints(blob: bytes, width: int) -> np.ndarray:
    """Whole numbers as written by ``_bytes``."""
    if blob[:1] == b"o":
        flat = np.array([int(c) for c in blob[1:].decode().split(",") if c], dtype=object)
        return flat.reshape(-1, width)
    return np.frombuffer(blob[1:], np.int32).astype(np.int64).reshape(-1, width)


def _bytes(x: np.ndarray) -> bytes:
    if x.dtype == object:
        return b"o" + ",".join(str(int(c)) for c in x.ravel()).encode()
    return b"i" + x.astype(np.int32).tobytes()


_TREES = "ids binary, known binary, labels array<string>, points binary, trees array<array<binary>>"


def _grow(parts: int, slice_rows: int):
    """Rows -> slices with the cover tree of every part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                some = batch.slice(at, slice_rows)
                ids = some.column("id")
                v = some.column("v")
                x = v.flatten().to_numpy(zero_copy_only=False).reshape(some.num_rows, -1)
                points = whole_numbers(x, parts)
                cuts = np.split(points, parts, axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).tobytes()], pa.binary()),
                     pa.array([np.asarray(ids.is_valid()).astype(np.uint8).tobytes()], pa.binary()),
                     pa.array([some.column("label").to_pylist()], pa.list_(pa.string())),
                     pa.array([_bytes(points)], pa.binary()),
                     pa.array([[CoverTree(p).pack() for p in cuts]], pa.list_(pa.list_(pa.binary())))],
                    names=["ids", "known", "labels", "points", "trees"])

    return run


def _loaded(batch: pa.RecordBatch, i: int, width: int, parts: int):
    points = _ints(batch.column("points")[i].as_py(), width)
    cuts = np.split(points, parts, axis=1)
    return [CoverTree.unpack(p, t) for p, t in zip(cuts, batch.column("trees")[i].as_py())]


def _partial(books: list[np.ndarray], width: int):
    """One round over the slices of a task: a row ``part, entry, n, sums`` for each entry.
    Sums are decimal strings: whole numbers of any size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(b.shape, object) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            for i in range(batch.num_rows):
                for p, tree in enumerate(_loaded(batch, i, width, len(books))):
                    s, c = tree.round(books[p])
                    sums[p] = sums[p] + s.astype(object)
                    counts[p] += c
        rows = [(p, e, int(counts[p][e]), [str(int(x)) for x in sums[p][e]])
                for p in range(len(books)) for e in range(len(books[p])) if counts[p][e]]
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("part", "entry", "n", "sums"), r)) for r in rows],
            schema=pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.string()))]))

    return run


def lloyd_round(trees: DataFrame, books: list[np.ndarray], width: int) -> list[np.ndarray]:
    """Codebooks after one more round: ``parts * entries`` rows reach the driver."""
    found = trees.mapInArrow(_partial(books, width), "part int, entry int, n long, sums array<string>")
    total = found.select("part", "entry", "n", F.posexplode("sums").alias("at", "s")).groupBy("part", "entry", "at").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
    new = [b.copy() for b in books]
    for r in total.collect():
        new[r.part][r.entry][r["at"]] = int(r.s) // int(r.n)
    return new


def _first_entries(rows: DataFrame, parts: int, entries: int) -> np.ndarray:
    """Whole numbers of the rows with the smallest ids."""
    few = rows.select("id", "v").orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    if not few:
        return np.zeros((0, parts), np.int64)
    return whole_numbers(np.array([r.v for r in few], np.float64), parts)


def _coded(books: list[np.ndarray], width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                trees = _loaded(batch, i, width, len(books))
                codes = np.stack([t.codes(b) for t, b in zip(trees, books)], axis=1)
                error = sum(((t.points - b[c]) ** 2).sum(1) for t, b, c in zip(trees, books, codes.T))
                ids = np.frombuffer(batch.column("ids")[i].as_py(), np.int64)
                known = np.frombuffer(batch.column("known")[i].as_py(), np.uint8).astype(bool)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, mask=~known), pa.array([bytes(c).hex() for c in codes.astype(np.uint8)], pa.string()),
                     pa.array([int(e) for e in error], pa.int64()),
                     pa.array(batch.column("labels")[i].as_py(), pa.string())],
                    names=["id", "code", "error", "label"])

    return run


def books_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(str(int(c)) for b in books for c in b.ravel()).encode()).hexdigest()


def compress(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str | None = "label",
             parts: int = 8, entries: int = 16, rounds: int = 6, slice_rows: int = SLICE) -> tuple[DataFrame, list[np.ndarray]]:
    """``(id, code, error, label)`` of every kept row (written), and the final codebooks."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has one byte a part")
    rows = usable(vectors, id_col, vec_col, label_col)
    start = _first_entries(rows, parts, entries)
    width = start.shape[1]
    books = [b.copy() for b in np.split(start, parts, axis=1)]
    trees = written(rows.mapInArrow(_grow(parts, slice_rows), _TREES), "cover-trees")
    for _ in range(rounds if len(start) else 0):
        books = lloyd_round(trees, books, width)
    coded = written(trees.mapInArrow(_coded(books, width), "id long, code string, error long, label string"), "codes")
    forget(trees)
    return coded, books


def with_label_error(coded: DataFrame, salt: Column) -> DataFrame:
    """Adds ``label_error``: the errors of equal labels summed, nulls together. The sums stand
    under ``LABEL_SALTS`` keys a label, of which each row takes one by ``salt``, so that a label
    that holds a third of the rows is not one join key."""
    key = F.coalesce(F.concat(F.lit("="), F.col("label")), F.lit("null"))
    keyed = coded.withColumn("label_key", key).withColumn("salt", F.pmod(F.xxhash64(salt), F.lit(LABEL_SALTS)).cast("int"))
    sums = keyed.groupBy("label_key").agg(F.sum("error").alias("label_error"))
    spread = sums.select("*", F.explode(F.sequence(F.lit(0), F.lit(LABEL_SALTS - 1))).alias("salt"))
    return keyed.join(spread, ["label_key", "salt"]).drop("label_key", "salt")
