"""Vector codes against plain Lloyd rounds in Python integers; cover trees; odd rows."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cloudcost.llm import vectorcodes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, id int, v string, salt int, error int"


def brute(rows, parts, entries, rounds):
    """rows: (vec_id, vector, label) -> sorted (vec_id, code, error, label_error), digest."""
    kept = [(i, v, x) for i, v, x in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    lengths = [len(v) for _, v, _ in kept]
    width = min(set(lengths), key=lambda n: (-lengths.count(n), n), default=0)
    kept = sorted((k for k in kept if len(k[1]) == width), key=lambda k: (k[0] is None, k[0] or 0, k[1]))
    ints = [[math.floor(4096 * c) for c in v] + [0] * (-len(v) % parts) for _, v, _ in kept]
    step = (width + parts - 1) // parts
    cut = [[x[p * step:(p + 1) * step] for p in range(parts)] for x in ints]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for c in cut:
                own.setdefault(nearest(c[p], books[p])[1], []).append(c[p])
            for e, points in own.items():
                books[p][e] = [sum(col) // len(points) for col in zip(*points)]
    out = []
    for (i, _, label), c in zip(kept, cut):
        found = [nearest(x, b) for x, b in zip(c, books)]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), label))
    sums = {}
    for _, _, e, label in out:
        sums[label] = sums.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, sums[label]) for i, c, e, label in out), key=str), digest


def run(df, **kw):
    coded, books = vc.compress(df, **kw)
    got = vc.with_label_error(coded, F.struct("id", "code")).collect()
    return sorted(((r.id, r.code, r.error, r.label_error) for r in got), key=str), vc.books_digest(books)


@pytest.mark.parametrize("kind", ["spread", "clusters", "grid", "large"])
def test_trees_assign_like_all_comparisons(kind):
    rng = np.random.default_rng(3)
    points = {"spread": lambda: rng.integers(-4000, 4000, (3000, 8)),
              "clusters": lambda: rng.integers(-4000, 4000, (30, 8))[rng.integers(0, 30, 3000)] + rng.integers(-40, 40, (3000, 8)),
              "grid": lambda: rng.integers(-2, 3, (3000, 2)),
              "large": lambda: rng.integers(-2 ** 31, 2 ** 31, (300, 3)).astype(object)}[kind]()
    book = points[:16].copy()
    tree = vc.CoverTree.unpack(points, vc.CoverTree(points).pack())
    for node in range(len(tree.lo)):  # nodes cover their points, children partition their node
        own = tree.order[tree.lo[node]:tree.hi[node]]
        away = vc.distances(points[own], points[tree.centre[node]][None, :])[:, 0]
        assert max(math.sqrt(int(a)) for a in away) <= tree.radius[node] * (1 + 1e-9)
        kids = range(tree.first[node], tree.first[node] + tree.kids[node])
        assert not len(kids) or [(tree.lo[k], tree.hi[k]) for k in kids][0][0] == tree.lo[node]
        assert sum(tree.hi[k] - tree.lo[k] for k in kids) in (0, len(own))
    for _ in range(4):
        want = vc.distances(points, book).argmin(1)
        assert np.array_equal(tree.codes(book), want)
        sums, counts = tree.round(book)
        for e in range(16):
            assert counts[e] == (want == e).sum() and (sums[e] == points[want == e].sum(0)).all()
            if counts[e]:
                book[e] = sums[e] // counts[e]
    single = len(tree.assign(book)[1])
    assert single < len(points) * (0.25 if kind in ("clusters", "grid") else 1.01)  # whole subtrees do go


def test_codes_against_plain_rounds(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(400), [rng.choice([rng.gauss(0, 1), 0.5, -0.0001]) for _ in range(8)], rng.choice([None, 1, 2, 2, 2]))
            for _ in range(500)]
    df = spark.createDataFrame([(i, v, x, 1, "a", 2, 3) for i, v, x in rows], SCHEMA).repartition(5)
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]  # as 32-bit floats
    for parts, entries, rounds in ((4, 16, 3), (2, 7, 2), (8, 16, 0), (3, 5, 1)):
        assert run(df, parts=parts, entries=entries, rounds=rounds, slice_rows=60) == brute(rows, parts, entries, rounds)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.25, 1.0], 1), (1, [0.25, 1.0], 1), (None, [0.5, -1.0], None), (2, None, 1), (3, [nan, 1.0], 1), (4, [1.0, -inf], 1),
            (5, [None, 1.0], None), (6, [1.0], 2), (7, [], 2), (8, [9000.0, -9000.0], None), (9, [-0.1, 0.1], 7), (1, [0.0, 2.0], 1)]
    df = spark.createDataFrame([(i, v, x, 1, "a", 2, 3) for i, v, x in rows], SCHEMA)
    plain = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    for parts in (1, 2, 3):
        assert run(df, parts=parts, entries=3, rounds=4) == brute(plain, parts, 3, 4)
    got, digest = run(df.limit(0), parts=2)
    assert got == [] and digest == hashlib.sha256(b"").hexdigest()
    same = spark.createDataFrame([(i, [1.0, 2.0], None, 1, "a", 2, 3) for i in range(50)], SCHEMA)
    assert run(same, parts=2, entries=16, rounds=6)[0] == sorted(((i, "0000", 0, 0) for i in range(50)), key=str)
