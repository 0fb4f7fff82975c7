"""Merkle manifest of a dataset: a content-addressed DAG, descended for proofs.

A row's leaf is the SHA-256 of its fields. The leaves of a tree (one tree a source), in
the order of their ids, are hashed in runs of ``FAN`` until one node is left, the
subroot; the subroots, in the order of their sources, give the root in the same way.

*Build.* Ranks come from one range partitioning: running numbers within a partition, plus
sums over partitions. ``FAN ** LEVELS`` leaves in a row (``LEVELS`` levels of nodes) are one
segment, hashed in one task; the tops of the segments are the leaves of the next layer, so
a tree of any size takes a few layers. The store holds digest-to-children records, grouped
by segment and addressed by the segment's digest alone; equal segments are stored once
(once for each of ``SPREAD`` buckets, so that a very common segment is not one join key).

*Proof.* A leaf's rank in base ``FAN`` is the way down: from the root, the records give the
children, the digit picks one, the others are collected; at the end the pieces of the path
are reversed. Requests of one segment walk it together, and a path above a segment exists
once for all of them, so what is shuffled for a leaf does not grow with the depth.

Cases: a null field is written ``-``, other than an empty text (``0:``); rows without a
source form the first tree; rows without an id come first in their tree; rows that share an
id follow each other by leaf digest; repeated rows are leaves of their own with proofs of
their own (they travel as one row with a count); a tree of one leaf has it as its subroot,
and one tree's subroot is the root; a leaf without siblings has the digest of the empty
text as its proof; an empty table gives no rows; a very long text is hashed where it is
read, only digests travel. Extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import forget, shuffle_partitions, written

FAN = 3
LEVELS = 7
SPREAD = 64

_SEGMENTS = "tree string, block long, total long, segment binary, digests binary, children binary, counts binary"
_FRONT = "tree string, block long, whole long, subroot binary, segment binary, path array<binary>"
_FRONT_ARROW = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("whole", pa.int64()), ("subroot", pa.binary()),
                          ("segment", pa.binary()), ("path", pa.list_(pa.binary()))])


@dataclass
class Manifest:
    """``pieces`` and ``top_pieces``: leaves and subroots by segment; ``store``:
    digest-to-children records; ``layers`` and ``top_layers``: of segments, in the deepest tree
    and in the one above the subroots; ``levels`` of a segment; ``root`` hex (None: no rows)."""
    pieces: DataFrame
    top_pieces: DataFrame
    store: DataFrame
    layers: int
    top_layers: int
    levels: int
    root: str | None


# --- leaves ------------------------------------------------------------------------

def record_digest(*fields: Column) -> Column:
    """Binary SHA-256 of the fields: ``-`` for null, else byte count, ``:``, value."""
    parts = []
    for f in fields:
        text = f.cast("string")
        parts.append(F.when(f.isNull(), F.lit("-")).otherwise(
            F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the partition and the number of leaves of the same tree before the row in it."""
    part = TaskContext.get().partitionId()
    last, seen = None, 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        trees = batch.column("tree")
        codes = trees.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        n = batch.column("n").to_numpy(zero_copy_only=False)
        before = np.cumsum(n) - n
        heads = np.concatenate([[True], codes[1:] != codes[:-1]])
        head = np.maximum.accumulate(np.where(heads, np.arange(len(n)), 0))
        local = before - before[head]
        if trees[0].as_py() == last:
            local[head == 0] += seen
        last, seen = trees[-1].as_py(), int(local[-1] + n[-1])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(n), part, np.int32)), pa.array(local)],
            names=[*batch.schema.names, "part", "local"])


def _ranked(rows: DataFrame, order: Sequence[str], name: str, segment: int) -> DataFrame:
    """``rows`` (with ``tree`` and a count ``n``) cut into pieces that lie in one segment:
    adds ``block, start, count, total`` (the tree's leaves)."""
    parts = shuffle_partitions(rows.sparkSession)
    local = written(rows.repartitionByRange(parts, "tree", *order).sortWithinPartitions("tree", *order)
                    .mapInArrow(_numbered, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
                                + ", part int, local long"), name)
    counts = local.groupBy("tree", "part").agg(F.sum("n").alias("c"))
    tree = Window.partitionBy("tree")  # one row a partition that holds the tree
    bases = counts.select("tree", "part", (F.sum("c").over(tree.orderBy("part")) - F.col("c")).alias("base"),
                          F.sum("c").over(tree).alias("total"))
    placed = local.join(bases, ["tree", "part"]).withColumn("first", F.col("base") + F.col("local"))
    cut = placed.withColumn("block", F.explode(F.expr(f"sequence(first div {segment}, (first + n - 1) div {segment})")))
    start = F.greatest("first", F.col("block") * segment)
    count = F.least(F.col("first") + F.col("n"), (F.col("block") + 1) * segment) - start
    return cut.select("tree", *order, *[c for c in rows.columns if c not in ("tree", "n", *order)],
                      "block", start.alias("start"), count.alias("count"), "total")


# --- building ----------------------------------------------------------------------

def _height(total: int, levels: int) -> int:
    """Levels above the leaves of a segment in a layer of ``total`` nodes of its tree."""
    height = 0
    while total > 1 and height < levels:
        total, height = -(-total // FAN), height + 1
    return height


def _hash(children: list[bytes]) -> bytes:
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def _segment(levels: int):
    def run(group: pa.Table) -> pa.Table:
        rows = sorted(zip(*(group.column(c).to_pylist() for c in ("start", "count", "digest"))))
        level = [d for _, count, d in rows for _ in range(count)]
        total = group.column("total")[0].as_py()
        nodes = {}
        for _ in range(_height(total, levels)):
            runs = [level[i:i + FAN] for i in range(0, len(level), FAN)]
            level = [_hash(r) for r in runs]
            nodes.update(zip(level, runs))
        return pa.table({
            "tree": group.column("tree").slice(0, 1), "block": group.column("block").slice(0, 1), "total": [total],
            "segment": pa.array(level, pa.binary()), "digests": pa.array([b"".join(nodes)], pa.binary()),
            "children": pa.array([b"".join(c for r in nodes.values() for c in r)], pa.binary()),
            "counts": pa.array([bytes(len(r) for r in nodes.values())], pa.binary())})

    return run


def _layers(pieces: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """Segments of every layer, lowest first, and ``tree, whole, subroot``."""
    nodes = pieces.select("tree", "block", "start", "count", "digest", "total")
    layers, tops, segment = [], [], FAN ** levels
    whole = pieces.select("tree", F.col("total").alias("whole")).distinct()
    while True:
        layer = written(nodes.groupBy("tree", "block").applyInArrow(_segment(levels), _SEGMENTS), "segments")
        layers.append(layer)
        tops.append(layer.filter(F.col("total") <= segment).select("tree", F.col("segment").alias("subroot")))
        more = layer.filter(F.col("total") > segment)
        if more.isEmpty():
            break
        nodes = more.select("tree", F.expr(f"block div {segment}").alias("block"), F.col("block").alias("start"),
                            F.lit(1).cast("long").alias("count"), F.col("segment").alias("digest"),
                            F.expr(f"(total + {segment - 1}) div {segment}").alias("total"))
    roots = tops[0]
    for t in tops[1:]:
        roots = roots.unionByName(t)
    return layers, roots.join(whole, "tree")


def _bucket() -> Column:
    return F.pmod(F.xxhash64("tree", "block"), F.lit(SPREAD)).cast("int").alias("bucket")


def build(rows: DataFrame, leaf: Column, tree: str = "source", order: str = "doc_id",
          altered: Column | None = None, levels: int = LEVELS) -> Manifest:
    """Manifest of ``rows``: one tree a value of ``tree``, leaves in the order of the whole
    number ``order``. ``altered`` is a leaf to be checked in place of a row's own (null: none)."""
    # null first, then bytewise: the empty name stands for null, all others begin with '='
    named = F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit(""))
    other = altered if altered is not None else F.lit(None).cast("binary")
    # one leaf has one altered leaf: equal rows are counted before they are shuffled
    leaves = (rows.select(named.alias("tree"), F.col(order).cast("long").alias("id"), leaf.alias("digest"),
                          other.alias("altered"))
              .groupBy("tree", "id", "digest", "altered").agg(F.count(F.lit(1)).alias("n")))
    pieces = _ranked(leaves, ["id", "digest", "altered"], "leaves", FAN ** levels)
    layers, trees = _layers(pieces, levels)
    trees = written(trees, "trees")
    tops = trees.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("subroot").alias("digest"), "whole",
                        F.lit(1).cast("long").alias("n"))
    top_pieces = _ranked(tops, ["name"], "subroots", FAN ** levels)
    top_layers, top = _layers(top_pieces, levels)
    found = top.first()  # the one root
    records = [x.select("segment", _bucket(), "digests", "children", "counts") for x in (*layers, *top_layers)]
    store = records[0]
    for r in records[1:]:
        store = store.unionByName(r)
    store = written(store.dropDuplicates(["segment", "bucket"]), "records")
    for x in (*layers, *top_layers):
        forget(x)
    return Manifest(pieces, top_pieces, store, len(layers), len(top_layers), levels,
                    bytes(found.subroot).hex() if found else None)


# --- descent -----------------------------------------------------------------------

def _records(front: pa.Table) -> dict[bytes, list[bytes]]:
    digests, children, counts = (front.column(c)[0].as_py() for c in ("digests", "children", "counts"))
    out, at = {}, 0
    for i, n in enumerate(counts):
        out[digests[32 * i:32 * i + 32]] = [children[32 * k:32 * k + 32] for k in range(at, at + n)]
        at += n
    return out


def _down(records: dict, digest: bytes, position: int, height: int) -> tuple[bytes, list[bytes]]:
    """The node at ``position`` below ``digest`` and the way to it: for each level, the
    digit and the children that were not taken."""
    way = []
    for level in reversed(range(height)):
        digit = position // FAN ** level % FAN
        children = records[digest]
        way.append(bytes([digit]) + b"".join(children[:digit] + children[digit + 1:]))
        digest = children[digit]
    return digest, way


def _entered(front: pa.Table, layer: int, levels: int) -> tuple[dict, bytes, int, list[bytes]]:
    if front.num_rows != 1:
        raise ValueError("a requested segment was not reached from the root")
    whole = front.column("whole")[0].as_py()
    return (_records(front), front.column("segment")[0].as_py(), _height(-(-whole // FAN ** (levels * layer)), levels),
            front.column("path")[0].as_py())


def _walk(layer: int, levels: int):
    """Requests for nodes inside a segment -> the segments below them."""

    def run(requests: pa.Table, front: pa.Table) -> pa.Table:
        out = []
        if requests.num_rows:
            records, top, height, path = _entered(front, layer, levels)
            block, tree, subroot = (front.column(c)[0].as_py() for c in ("block", "tree", "subroot"))
            for index, whole in zip(requests.column("index").to_pylist(), requests.column("total").to_pylist()):
                digest, way = _down(records, top, index - block * FAN ** levels, height)
                out.append((tree, index, whole, subroot, digest, path + way))
        return pa.table(list(zip(*out)) if out else [[]] * 6, schema=_FRONT_ARROW)

    return run


def _named(levels: int):
    """Lowest layer of the top tree: requests for subroots -> where the trees are entered."""

    def run(requests: pa.Table, front: pa.Table) -> pa.Table:
        out = []
        if requests.num_rows:
            records, top, height, path = _entered(front, 0, levels)
            first = front.column("block")[0].as_py() * FAN ** levels
            for at, name, whole, want in zip(*(requests.column(c).to_pylist() for c in (
                    "start", "name", "whole", "digest"))):
                digest, way = _down(records, top, at - first, height)
                if digest != want:
                    raise ValueError("the store does not lead to this subroot")
                out.append((name, 0, whole, digest, digest, path + way))
        return pa.table(list(zip(*out)) if out else [[]] * 6, schema=_FRONT_ARROW)

    return run


def fold(leaf: bytes, way_up: list[bytes]) -> bytes:
    """The root that a leaf and its proof (lowest level first) lead to."""
    for step in way_up:
        siblings = [step[i:i + 32] for i in range(1, len(step), 32)]
        leaf = _hash(siblings[:step[0]] + [leaf] + siblings[step[0]:])
    return leaf


def _proofs(root: str, with_proofs: bool, levels: int):
    def run(requests: pa.Table, front: pa.Table) -> pa.Table:
        out = []
        if requests.num_rows:
            records, top, height, path = _entered(front, 0, levels)
            first = front.column("block")[0].as_py() * FAN ** levels
            subroot = front.column("subroot")[0].as_py().hex()
            for at, count, id_, leaf, altered in zip(*(requests.column(c).to_pylist() for c in (
                    "start", "count", "id", "digest", "altered"))):
                for position in range(at - first, at - first + count):
                    digest, way = _down(records, top, position, height)
                    if digest != leaf:
                        raise ValueError("the store does not lead to this leaf")
                    up = (path + way)[::-1]
                    siblings = [step[i:i + 32].hex() for step in up for i in range(1, len(step), 32)]
                    folded = fold(leaf if altered is None else altered, up).hex()
                    out.append((id_, leaf.hex(), subroot, root, hashlib.sha256("".join(siblings).encode()).hexdigest(),
                                folded, folded == root, [step.hex() for step in up] if with_proofs else None))
        return pa.table(list(zip(*out)) if out else [[]] * 8, schema=pa.schema([
            ("id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
            ("proof_sha256", pa.string()), ("folded_root", pa.string()), ("verified", pa.bool_()),
            ("proof", pa.list_(pa.string()))]))

    return run


def _descend(pieces: DataFrame, starts: DataFrame, store: DataFrame, layers: int, levels: int, finish,
             schema: str) -> DataFrame:
    """Walk from ``starts`` (one row a tree, at its subroot) to the pieces, layer by layer."""
    front, segment = None, FAN ** levels
    for layer in reversed(range(layers)):
        size = segment ** layer
        here = starts.filter((F.col("whole") > (size if layer else 0)) & (F.col("whole") <= size * segment))
        front = here if front is None else front.unionByName(here)
        loaded = front.withColumn("bucket", _bucket()).join(store, ["segment", "bucket"]).drop("bucket")
        if layer == 0:
            asked, run, out = pieces, finish, schema
        else:
            below = F.expr(f"block div {segment ** (layer - 1)}").alias("index")
            asked = (pieces.filter(F.col("total") > size).select("tree", below, "total").distinct()
                     .withColumn("block", F.expr(f"index div {segment}")))
            run, out = _walk(layer, levels), _FRONT
        reached = asked.groupBy("tree", "block").cogroup(loaded.groupBy("tree", "block")).applyInArrow(run, out)
        front = reached if layer == 0 else written(reached, "front")
    return front


def prove(manifest: Manifest, wanted: Column | None = None, with_proofs: bool = False) -> DataFrame:
    """``id, leaf, subroot, root, proof_sha256, folded_root, verified, proof``: one row a leaf
    (of those that satisfy ``wanted``, a condition on ``id`` and ``tree``). ``proof`` has a
    step a level, lowest first, in hex: one byte for the place, then the siblings."""
    root = manifest.root or ""
    pieces = manifest.pieces if wanted is None else manifest.pieces.filter(wanted)
    tops = manifest.top_pieces
    if wanted is not None:
        tops = tops.join(pieces.select(F.col("tree").alias("name")).distinct(), "name", "left_semi")
    entry = tops.select(F.col("tree").alias("tree"), F.lit(0).cast("long").alias("block"), F.col("total").alias("whole"),
                        F.unhex(F.lit(root)).alias("subroot"), F.unhex(F.lit(root)).alias("segment"),
                        F.array().cast("array<binary>").alias("path")).distinct()
    starts = written(_descend(tops, entry, manifest.store, manifest.top_layers, manifest.levels,
                              _named(manifest.levels), _FRONT), "trees")
    return _descend(pieces, starts, manifest.store, manifest.layers, manifest.levels, _proofs(root, with_proofs, manifest.levels),
                    "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
                    "verified boolean, proof array<string>")
