"""The Merkle manifest against a plain recursion, deep trees, odd rows, broken stores."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cloudcost.llm import merkle
from tests.llm.test_llm import no_docs, odd_docs

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def leaf(r, text=None):
    text = r["text"] if text is None else text
    values = [r["doc_id"], r["source"], r["lang"], r["n_chars"], text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree_levels(level):
    out = [level]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def siblings(levels, k):
    out = []
    for level in levels[:-1]:
        run = range(k // 3 * 3, min(k // 3 * 3 + 3, len(level)))
        out.append([(i, level[i]) for i in run] + [k])
        k //= 3
    return out


def brute(rows, altered):
    """Sorted (doc_id, leaf, subroot, root, proof, folded, verified); altered: row -> leaf or None."""
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        own = sorted(by[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[s] = (own, tree_levels([leaf(r) for r in own]))
    top = tree_levels([trees[s][1][-1][0] for s in order])
    out = []
    for j, s in enumerate(order):
        own, levels = trees[s]
        for k, r in enumerate(own):
            steps = siblings(levels, k) + siblings(top, j)
            proof = "".join(d for *run, me in steps for i, d in run if i != me)
            h = altered(r) or leaf(r)
            for *run, me in steps:
                h = sha("".join(h if i == me else d for i, d in run))
            out.append((r["doc_id"], leaf(r), levels[-1][0], top[-1][0], sha(proof), h, h == top[-1][0]))
    return sorted(out, key=str)


def digest(*cols):
    return merkle.record_digest(*[F.col(c) if isinstance(c, str) else c for c in cols])


def proved(docs, altered=None, levels=merkle.LEVELS, **kw):
    got = merkle.prove(merkle.build(docs, digest(*FIELDS), altered=altered, levels=levels), **kw).collect()
    return sorted(((r.id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in got), key=str)


def sources(spark, sizes, seed=1):
    rng = random.Random(seed)
    rows = [(i, s, rng.choice(["de", None]), rng.choice([None, 3]), rng.choice(["a\nb", "x" * 50, "", None, "é\n"]))
            for s, n in sizes.items() for i in rng.sample(range(10 * n + 10), n)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")


def cut_text(r):
    """The leaf without newlines, for rows with an even number of bytes in their id."""
    even = len(str(r["doc_id"])) % 2 == 0
    return leaf(r, None if r["text"] is None else r["text"].replace("\n", "")) if even else None


def cut_leaf():
    return F.when(F.char_length(F.col("doc_id").cast("string")) % 2 == 0,
                  digest(*FIELDS[:-1], F.replace(F.col("text"), F.lit("\n"), F.lit(""))))


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_proofs_against_a_plain_recursion(spark, levels):
    docs = sources(spark, {None: 4, "": 1, "a": 28, "Z": 3, "é": 82, "aa": 9, "b": 10})
    want = brute([r.asDict() for r in docs.collect()], cut_text)
    assert proved(docs, cut_leaf(), levels) == want and {w[-1] for w in want} == {True, False}


def test_one_source_one_row_and_requests(spark):
    one = sources(spark, {"a": 1})
    assert proved(one) == brute([r.asDict() for r in one.collect()], lambda r: None)
    assert proved(one)[0][1] == proved(one)[0][3] and proved(one)[0][4] == sha("")
    docs = sources(spark, {"a": 30, "b": 5})
    want = [w for w in brute([r.asDict() for r in docs.collect()], lambda r: None) if w[0] % 7 == 0]
    assert proved(docs, wanted=F.col("id") % 7 == 0) == want and 0 < len(want) < 35


def test_repeated_rows_are_leaves_of_their_own(spark):
    docs = sources(spark, {"a": 7, "b": 2})
    many = docs.unionByName(spark.range(40).select(
        F.lit(3).cast("long").alias("doc_id"), F.lit("a").alias("source"), F.lit("de").alias("lang"),
        F.lit(None).cast("long").alias("n_chars"), F.lit("same").alias("text")))
    assert proved(many, levels=1) == proved(many) == brute([r.asDict() for r in many.collect()], lambda r: None)


def test_odd_rows(spark):
    odd = odd_docs(spark).withColumn("tree", F.lit("x")).withColumn("n", F.lit(1)).withColumn("digest", F.lit(1))
    assert proved(odd) == brute([r.asDict() for r in odd.select(*FIELDS).collect()], lambda r: None)
    assert merkle.prove(merkle.build(no_docs(spark), digest(*FIELDS))).count() == 0
    assert merkle.build(no_docs(spark), digest(*FIELDS)).root is None


def test_proofs_fold_to_the_root_by_themselves(spark):
    docs = sources(spark, {"a": 40, "b": 11})
    built = merkle.build(docs, digest(*FIELDS))
    for r in merkle.prove(built, with_proofs=True).collect():
        way = [bytes.fromhex(x) for x in r.proof]
        assert merkle.fold(bytes.fromhex(r.leaf), way).hex() == built.root
        assert merkle.fold(bytes.fromhex(sha("other")), way).hex() != built.root


def test_equal_segments_are_stored_once_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(merkle, "SPREAD", 1)
    same = spark.range(81).select(F.lit(3).cast("long").alias("doc_id"), F.lit("a").alias("source"), F.lit("t").alias("text"),
                                  F.lit("de").alias("lang"), F.lit(1).cast("long").alias("n_chars"))
    built = merkle.build(same, digest(*FIELDS), levels=1)
    assert built.layers == 4 and built.store.filter("counts <> X''").count() == 4  # one a layer
    assert merkle.prove(built).filter("verified").count() == 81


def test_a_store_that_lost_a_segment_is_noticed(spark):
    built = merkle.build(sources(spark, {"a": 30}), digest(*FIELDS), levels=1)
    built.store = built.store.filter(F.crc32("segment") % 2 == 0)
    with pytest.raises(Exception, match="not reached|lead to"):
        merkle.prove(built).count()
