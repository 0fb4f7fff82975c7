"""Operators against plain definitions, where a shortcut once lost part of the result."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cloudcost.llm import jaccard, linededup, quality, tokenbin
from cloudcost.llm.components import components
from cloudcost.llm.tokens import SegmentEncoder, tokenizer_path
from tests.llm.test_llm import SCHEMA, edit, odd_docs, rows


# --- 2: lines ----------------------------------------------------------------------

def removed_by_edits(lines, similarity):
    """Numbers of the lines that go, by edit similarity of all pairs."""
    root = list(range(len(lines)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    near = {}
    for i, a in enumerate(lines):
        for j, b in enumerate(lines[:i]):
            longest = max(len(a), len(b))
            most = int(longest * (1 - similarity) + 1e-9)
            if abs(len(a) - len(b)) <= most and edit(a, b) <= most:
                near[longest // 10] = near.get(longest // 10, 0) + (a != b)
                root[max(top(i), top(j))] = min(top(i), top(j))
    return [i for i in range(len(lines)) if top(i) != i], near


@pytest.mark.parametrize("similarity", [0.85, 0.7])
def test_no_similar_line_is_missed(spark, similarity):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 9))) for _ in range(400)]
    lines = []
    for n in [*range(3, 30), 40, 60, 110]:
        line = rng.choices(words, k=n)
        lines.append(line)
        for share in (0.05, 0.1, 0.15, 0.3, 0.45):  # changed, lost and added words
            copy = list(line)
            for _ in range(max(1, int(n * share))):
                at = rng.randrange(len(copy))
                copy[at:at + 1] = rng.choice([[rng.choice(words)], [], [copy[at], rng.choice(words)]]) or copy[at:at + len(copy) // n]
            lines.append(copy)
    rng.shuffle(lines)
    docs = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(lines)], "doc_id long, text string")
    gone, near = removed_by_edits(lines, similarity)
    assert all(near.get(n) for n in (0, 1, 2, 4, 6, 11))
    got = linededup.dedup_lines(docs, similarity).filter("n_removed > 0")
    assert sorted(r.doc_id for r in got.collect()) == gone  # recall 1 at all lengths


def test_lines_around_the_border_of_the_classes(spark, monkeypatch):
    """Lines with few and with many classes of words link; the order of the runs changes no result."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    lines = []
    for n in (linededup.LONGER - 25, linededup.LONGER - 1, linededup.LONGER, linededup.LONGER + 20):
        line = rng.choices(words, k=n)
        lines.append(line)
        for cut, changed in ((1, 0), (n // 10, 0), (n // 10, n // 25), (0, n // 7), (0, n // 5)):
            copy = line[cut:]
            for at in rng.sample(range(len(copy)), changed):
                copy[at] = rng.choice(words)
            lines.append(copy)
    docs = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(lines)], "doc_id long, text string")
    gone, _ = removed_by_edits(lines, linededup.SIMILARITY)
    assert 12 <= len(gone) < 20
    for classes in (linededup._classes, lambda d, q: bytes(linededup.SLOTS_SEEN),
                    lambda d, q: bytes(rng.randrange(30) for _ in range(linededup.SLOTS_SEEN))):
        monkeypatch.setattr(linededup, "_classes", classes)
        got = linededup.dedup_lines(docs).filter("n_removed > 0")
        assert sorted(r.doc_id for r in got.collect()) == gone


def test_classes_of_long_lines_fold(spark):
    """A line has as many classes as its length needs (each takes a pass over its words); numbers of
    different parities follow from the fewer classes of two."""
    hashes = [random.Random(i).getrandbits(63) for i in range(260)]
    sizes = (20, 100, 199, 205, 260)
    made = spark.createDataFrame([(n, hashes[:n]) for n in sizes], "n int, hs array<long>").select(
        "n", linededup._wide(F.col("hs")).alias("wide"))
    assert {r.n: r.wide and len(r.wide) for r in made.collect()} == {20: None, 100: 4, 199: 4, 205: 16, 260: 16}
    pairs = made.alias("x").crossJoin(made.alias("y")).select(
        F.col("x.n").alias("a"), F.col("y.n").alias("b"), linededup._wide_apart("x", "y").alias("apart")).collect()

    def want(a, b):
        if min(a, b) < linededup.LONG:
            return 0
        classes = 1024 if min(a, b) >= linededup.LONGER else 256
        odd = {}
        for h in hashes[min(a, b):max(a, b)]:
            odd[h % classes] = odd.get(h % classes, 0) ^ 1
        return sum(odd.values())
    assert {(r.a, r.b): r.apart for r in pairs} == {(a, b): want(a, b) for a in sizes for b in sizes}


def test_long_lines_far_apart_make_no_pairs(spark, monkeypatch):
    rng = random.Random(5)
    shared = [f"s{i}" for i in range(75)]
    lines = [" ".join(shared + [f"w{rng.randrange(10**6)}" for _ in range(75)]) for _ in range(40)]
    made, write = {}, linededup.written

    def counted(df, name):
        out = write(df, name)
        made.setdefault(name, []).append(out.count())
        return out
    monkeypatch.setattr(linededup, "written", counted)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    assert linededup.dedup_lines(docs).filter("n_removed > 0").count() == 0
    assert made["open-lines"][0] >= 39  # all but the smallest meet
    assert made["near-lines"][1] == 0   # 741 by 64 parities alone


def test_short_spaceless_and_wordless_lines(spark):
    chinese = "我们在公园里散步然后一起去吃饭再回家休息"
    lines = ["Menu", "menu!", "Log in", "LOG IN", "log out", "-----", " -----", "=====", "", "", "  ", "  ",
             chinese, chinese + "。", chinese[:9] + "又" + chinese[9:], chinese[::-1], "ภาษาไทย", "ภาษาไทย", "日本", "日本人"]
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string")
    gone = linededup.dedup_lines(docs).filter("n_removed > 0")
    assert sorted(r.doc_id for r in gone.collect()) == [1, 3, 6, 13, 14, 17]


# --- 5: quality --------------------------------------------------------------------

def test_a_repeated_id_stays_within_the_sample(spark, monkeypatch):
    docs = spark.range(400).select(F.when(F.col("id") < 300, 1).otherwise(F.col("id")).cast("long").alias("doc_id"),
                                   F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    labels = docs.select("doc_id").distinct().select("doc_id", (F.col("doc_id") % 2).alias("label"))
    monkeypatch.setattr(quality, "train", lambda texts, labels, seed: (len(texts), len(labels)))
    assert quality.fit(docs, labels, max_docs=101, windows=3) == (303, 303)  # all ids, each once


# --- 6: near duplicates ------------------------------------------------------------

def test_rows_without_words_link_with_nothing(spark):
    more = [(20, ""), (21, " \n"), (22, " \n"), (7, ""), (23, "ab"), (24, "\x1c"), (25, "\x1c"), (26, "\u00a0"), (27, "\u00a0")]
    docs = odd_docs(spark).unionByName(spark.createDataFrame(
        [(i, t, None, None, None, 1, "x", 2, None, 3) for i, t in more], SCHEMA))
    got = set(rows(jaccard.near_duplicates(docs), "doc_id", "n_shingles", "component_id"))
    assert {(4, 0, 4), (20, 0, 20), (21, 0, 21), (22, 0, 22), (7, 0, 7)} <= got
    assert {(23, 1, 7), (25, 1, 24), (27, 1, 26)} <= got
    kept = [r.doc_id for r in jaccard.keep_first(docs).select("doc_id").collect()]
    assert {4, 20, 21, 22} <= set(kept) and not {23, 25, 27} & set(kept)


# --- components --------------------------------------------------------------------

def test_chains_in_any_order_settle(spark):
    rng = random.Random(4)
    edges = []
    for start, size in ((0, 3000), (10000, 700), (20000, 40)):
        ids = list(range(start, start + size))
        rng.shuffle(ids)
        edges += zip(ids, ids[1:])
    rng.shuffle(edges)
    got = rows(components(spark.createDataFrame(edges, "a long, b long")), "node", "component")
    assert got == sorted(((n, start) for start, size in ((0, 3000), (10000, 700), (20000, 40))
                          for n in range(start, start + size)), key=str)


# --- 1, 8: tokens ------------------------------------------------------------------

SPECIAL = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y, z", "<|ENDOFTEXT|> c", "a <|endoftext|>. <|startoftext|> c"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_added_tokens_as_the_library_reads_them(spark, name):
    tok = Tokenizer.from_file(tokenizer_path(name))
    added = [t.content for t in tok.get_added_tokens_decoder().values()]
    texts = SPECIAL + [f"the {a} end. {a}{a}\nof {a.upper()}" for a in added[:20]] + ["plain text, no marks"]
    want = [tok.encode(t, add_special_tokens=False).ids for t in texts]
    enc = SegmentEncoder(tokenizer_path(name))
    assert [np.frombuffer(x, enc.dtype).tolist() for x in enc.encode(texts)] == want
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = rows(tokenbin.round_trip(docs, tokenizer_path(name)), "doc_id", "start", "n_tokens")
    starts = np.cumsum([0] + [len(x) + 1 for x in want]).tolist()
    assert got == sorted(((i, s, len(x) + 1) for i, (s, x) in enumerate(zip(starts, want))), key=str)
