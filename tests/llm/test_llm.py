"""The training-data operators: SQL and brute-force comparisons, round trips, held-out
accuracy, and the stated results of odd inputs."""

import glob
import hashlib
import os
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cloudcost.llm import (chat, crosspolytope, jaccard, langid, linededup, packing, quality, queries, substrings,
                           suffix, tokenbin, winnow)
from cloudcost.llm.components import components
from cloudcost.llm.tokens import SegmentEncoder, encoder, tokenizer_path

SMALL, MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
LONG = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore "
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, g int, row_key string, k int, gone string, row int"


def odd_docs(spark):
    """Nulls everywhere, empty and long texts, ties, repeated rows, clashing columns."""
    texts = [(1, LONG * 3), (2, LONG * 3), (2, LONG * 3), (3, None), (4, ""), (5, "   \n\n\t"), (None, LONG * 3),
             (None, None), (6, LONG * 400 + "end"), (7, "ab"), (7, "cd ef"), (8, LONG.upper() * 3), (9, "é ñ ü ß 日本語\x00 ok")]
    return spark.createDataFrame([(i, t, None, None, None, 1, "x", 2, None, 3) for i, t in texts], SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


# --- against SQL -------------------------------------------------------------------

@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    con = duckdb.connect()
    for p in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    cur = con.execute(queries.oracle_sql()[name])
    cols = sorted(d[0] for d in cur.description)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({queries.oracle_sql()[name]})").fetchall()
    assert rows(queries.queries()[name](spark, SMALL), *cols) == sorted(want, key=str)


# --- 1: shards ---------------------------------------------------------------------

def test_elias_fano():
    rng = np.random.default_rng(0)
    for n, top in ((1, 1), (5, 3), (700, 10), (5000, 1 << 40), (3000, 1 << 33)):
        values = np.sort(rng.integers(0, top, n))
        ef, end = tokenbin.EliasFano.frombytes(b"xx" + tokenbin.EliasFano.of(values).tobytes(), 2)
        assert np.array_equal(ef.get(np.arange(n)), values)
        assert (end - 2) * 8 <= n * (3 + max(1, top // n).bit_length()) + 700 + 13 * 8
    assert tokenbin.EliasFano.of(np.zeros(0, np.uint64)).n == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_segments_encode_like_whole_texts(name):
    enc = SegmentEncoder(tokenizer_path(name))
    rng = random.Random(3)
    parts = ["a", "Der", "thé", " ", "  ", "\n", "\n\n", ", ", ". ", ".\n", "'s", "12", "***", "|", " |", "<|endoftext|>",
             "İ", "Σ", "\x01", "\t", "\x1c", "_", ",", "…", "é", "日本"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(3000)] + [None, LONG * 50]
    assert enc.encode(texts) == enc._ids([t or "" for t in texts])


def brute_tokens(docs, name, end):
    enc = encoder(tokenizer_path(name))
    data = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    for r in data:
        ids = enc.tok.encode(r.text or "", add_special_tokens=False).ids + [end]
        yield r.doc_id, np.array(ids, "<u4")


def test_shards_round_trip(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want, at = [], 0
    for d, ids in brute_tokens(docs, "byte_bpe_50k.json", 2):
        want.append((d, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    got = tokenbin.round_trip(docs, tokenizer_path("byte_bpe_50k.json"), shard_ids=5000)
    assert rows(got, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=str)
    assert got.select("part", "shard").distinct().count() > 8


def test_shards_of_odd_rows(spark):
    got = tokenbin.round_trip(odd_docs(spark), tokenizer_path("byte_bpe_50k.json"))
    r = sorted(got.collect(), key=lambda x: x.start)
    assert len(r) == 13 and [x.start for x in r] == np.cumsum([0] + [x.n_tokens for x in r])[:-1].tolist()
    assert [x.doc_id for x in r] == [None, None, 1, 2, 2, 3, 4, 5, 6, 7, 7, 8, 9]
    assert [x.n_tokens for x in r if x.doc_id in (3, 4)] == [1, 1]
    assert tokenbin.round_trip(no_docs(spark), tokenizer_path("byte_bpe_50k.json")).count() == 0


# --- 2: lines ----------------------------------------------------------------------

def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def test_lines_against_brute_force(spark):
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(300)]
    lines = [" ".join(rng.choices(words, k=rng.randint(3, 60))) for _ in range(40)]
    for x in list(lines):
        for _ in range(4):  # copies with a changed word or other punctuation
            y = list(x.split())
            y[rng.randrange(len(y))] += rng.choice(["", "x", "zz"])
            lines.append(" ".join(y).replace(" ", rng.choice([" ", ", "])).capitalize())
    rng.shuffle(lines)
    docs = spark.createDataFrame([(i // 5, "\n".join(lines[i:i + 5])) for i in range(0, len(lines), 5)], "doc_id long, text string")
    found = rows(linededup.removed_lines(docs), "doc_id", "line_no")

    place = [(i // 5, i % 5) for i in range(len(lines))]
    own = ["".join(c if c.isalnum() else " " for c in x.lower()).split() for x in lines]
    root = list(range(len(lines)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    near = 0
    for i, a in enumerate(own):
        for j, b in enumerate(own[:i]):
            if edit(a, b) <= int(max(len(a), len(b)) * (1 - linededup.SIMILARITY) + 1e-9):
                near += a != b
                root[max(top(i), top(j))] = min(top(i), top(j))
    want = sorted((place[i] for i in range(len(lines)) if top(i) != i), key=str)
    assert near > 10 and found == want
    dedup = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in linededup.dedup_lines(docs).collect()}
    for d in {p[0] for p in place}:
        kept = [lines[i] for i, p in enumerate(place) if p[0] == d and top(i) == i]
        assert dedup[d] == (5, 5 - len(kept), "\n".join(kept))


def test_lines_of_odd_rows(spark):
    got = {(r.doc_id, r.text): r for r in linededup.dedup_lines(odd_docs(spark)).collect()}
    assert got[(3, None)].n_lines == 0 and got[(4, "")].n_lines == 1 and got[(None, None)].n_removed == 0
    assert got[(5, "   \n\n\t")].n_removed == 0 and (1, LONG * 3) in got and (2, "") in got and (8, "") in got and (None, "") in got
    kept = linededup.clean(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "4", "5", "6", "7", "7", "9", "None"]
    assert linededup.dedup_lines(no_docs(spark)).count() == 0


# --- 3: substrings -----------------------------------------------------------------

def test_suffix_array():
    rng = np.random.default_rng(0)
    for _ in range(200):
        t = np.concatenate([rng.integers(1, rng.integers(2, 6), rng.integers(1, 60)), [0]])
        assert suffix.suffix_array(t).tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())


def brute_repeats(docs):
    """[(doc_id, text bytes)] -> removed masks."""
    first = {}
    for d, t in docs:
        for p in range(len(t) - 49):
            first[t[p:p + 50]] = min(first.get(t[p:p + 50], d), d)
    out = []
    for d, t in docs:
        mask = np.zeros(len(t), bool)
        for p in range(len(t) - 49):
            if first[t[p:p + 50]] < d:
                mask[p:p + 50] = True
        out.append(mask)
    return out


@pytest.mark.parametrize("hot", [8, 0])
def test_substrings_against_brute_force(spark, hot):
    rng = random.Random(5)
    shared = ["".join(rng.choices("abcd ", k=n)) for n in (49, 50, 51, 80, 300)]
    texts = []
    for i in range(60):
        parts = ["".join(rng.choices("abcdé ", k=rng.randint(0, 90))) for _ in range(4)]
        texts.append(rng.choice(shared).join(parts[:2]) + rng.choice(shared) + "x" * rng.choice([0, 120]) + parts[3])
    texts += texts[:7] + ["x" * 200, "", "é" * 30]
    docs = [(i // 2, t.encode()) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(d, t.decode()) for d, t in docs], "doc_id long, text string")
    want = sorted(((d, len(t), int(m.sum()), bytes(np.frombuffer(t, np.uint8)[~m])) for (d, t), m in
                   zip(docs, brute_repeats(docs))), key=str)
    got = substrings.remove_repeats(df, hot=hot)
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, bytes(r.kept)) for r in got.collect()), key=str) == want


def test_substrings_of_odd_rows(spark):
    got = {(r.doc_id, r.n_bytes): r for r in substrings.remove_repeats(odd_docs(spark)).collect()}
    size = len(LONG * 3)
    assert got[(1, size)].n_removed == 0 and got[(2, size)].n_removed == size and got[(2, size)].n_spans == 1
    assert got[(None, size)].n_removed == size and got[(8, size)].n_removed == 0
    assert got[(3, 0)].kept_sha256 == hashlib.sha256(b"").hexdigest() and got[(7, 2)].n_removed == 0
    # the long text is later than both: its runs stand in documents 1 and 2, its end stands nowhere else
    long = got[(6, len(LONG * 400) + 3)]
    assert long.kept == b"end" and long.n_spans == 1 and long.n_removed == len(LONG * 400)
    assert substrings.remove_repeats(no_docs(spark)).count() == 0


# --- 4: decontamination ------------------------------------------------------------

def test_short_items_and_edges(spark):
    words = [f"w{i}" for i in range(40)]
    docs = spark.createDataFrame([(1, " ".join(words[:30])), (2, "x " + " ".join(words[5:14]) + " y"), (3, "W1, w2!"),
                                  (4, None), (5, "nothing here"), (5, "w1 w2"), (None, "w1 w2 zz")], "doc_id long, text string")
    items = spark.createDataFrame([("10", " ".join(words[3:20])), ("9", "w1 W2"), ("9", None), (None, "here"), ("8", "")],
                                  "item_id string, text string")
    # the item without an id hits document 5 and is not listed
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in winnow.report(docs, items).collect()), key=str)
    assert got == sorted([(1, 30, 19, ["10", "9"]), (2, 11, 0, []), (3, 2, 2, ["9"]), (4, 0, 0, []), (5, 2, 1, []),
                          (5, 2, 2, ["9"]), (None, 3, 2, ["9"])], key=str)
    assert rows(winnow.clean(docs, items).filter("doc_id in (2, 4)"), "doc_id") == [(2,), (4,)]
    assert winnow.report(docs, items.limit(0)).filter("n_hit > 0").count() == 0
    assert winnow.report(no_docs(spark), items).count() == 0
    odd = odd_docs(spark)
    assert winnow.clean(odd, spark.createDataFrame([("1", LONG)], "item_id string, text string")).columns == odd.columns


# --- 5, 7: networks ----------------------------------------------------------------

def test_quality_held_out(spark):
    got = queries.op5_byte_cnn(spark, MID)
    labels = spark.read.parquet(f"{MID}/labels.parquet")
    r = got.filter("held_out").join(labels, "doc_id").collect()
    assert len(r) > 80 and np.mean([x.predicted == x.quality for x in r]) >= 0.9
    assert got.count() == 1000 and got.filter("score < 0 or score > 1 or predicted <> int(score >= 0.5)").count() == 0


def numeric_gradient(f, p, i, eps=1e-3):
    old = p.flat[i]
    p.flat[i] = old + eps
    up = f()
    p.flat[i] = old - eps
    down = f()
    p.flat[i] = old
    return (up - down) / (2 * eps)


def test_gradients():
    rng = np.random.default_rng(2)
    net = langid.Network.start(["a", "b", "c"], 1)
    for d in (net.forward, net.backward):
        for k, v in vars(d).items():
            setattr(d, k, v.astype(np.float64))
    codes, y = rng.integers(0, 20, (langid.LENGTH, 6)).astype(np.int16), np.array([0, 1, 2, 0, 1, 2])

    def loss():
        p = langid._position_probabilities(net, langid._run(net.forward, codes)[0], langid._run(net.backward, codes[::-1])[0][::-1])
        return -np.log(p[:, np.arange(6), y]).mean()
    grads = langid._gradients(net, codes, y)
    for p, g in zip(net.params(), grads):
        for i in rng.choice(p.size, min(4, p.size), replace=False):
            assert abs(numeric_gradient(loss, p, i) - g.flat[i]) < 2e-3
    q = quality.Network.start(3)
    codes, y = rng.integers(0, 40, (5, quality.WINDOW)).astype(np.int16), np.array([0, 1, 1, 0, 1], np.float32)
    flat = codes.astype(np.uint8).ravel()

    def log_loss():
        s = quality.score_texts(q, flat, np.arange(6) * quality.WINDOW)
        return -np.mean(np.where(y == 1, np.log(s), np.log(1 - s)))
    base = log_loss()
    for p, g in zip(q.params(), quality._gradients(q, codes, y)):
        p -= 0.003 * g / max(1e-9, np.abs(g).max())
    assert log_loss() < base


def test_scores_do_not_depend_on_neighbours():
    q = quality.Network.start(4)
    texts = [b"", b"a", LONG.encode() * 7, b"%%% x" * 9, b"q" * 128, b"z" * 122]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    together = quality.score_texts(q, np.frombuffer(b"".join(texts), np.uint8), offsets)
    alone = [quality.score_texts(q, np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-6)


def test_languages_held_out(spark):
    got = queries.op7_bigru_langid(spark, MID)
    docs = spark.read.parquet(f"{MID}/documents.parquet").select("doc_id", "lang")
    r = got.filter("held_out").join(docs, "doc_id").collect()
    assert np.mean([x.lang_pred == x.lang for x in r]) >= 0.95
    assert got.count() == 1000 and got.filter("score < 0 or score > 1").count() == 0


def test_networks_of_odd_rows(spark):
    odd = odd_docs(spark)
    labels = spark.createDataFrame([(1, 1), (1, None), (7, 0), (None, 1), (77, 1)], "doc_id long, label int")
    net = quality.fit(odd, labels)
    assert quality.score(odd, net).filter("score between 0 and 1").count() == 13
    assert {r.score for r in quality.score(odd, quality.fit(odd, labels.limit(0))).collect()} == {0.5}
    assert quality.score(no_docs(spark), net).count() == 0 and quality.keep_good(odd, net).columns == odd.columns
    assert {r.lang_pred for r in langid.identify(odd, langid.fit(odd)).collect()} == {"und"}
    learned = langid.fit(odd.withColumn("lang", F.when(F.col("doc_id") == 1, "la")))
    got = {(r.doc_id, r.lang_pred, r.score > 0) for r in langid.identify(odd, learned).collect()}
    assert (3, "und", False) in got and (5, "und", False) in got and (1, "la", True) in got
    assert langid.identify(no_docs(spark), learned).count() == 0


# --- 6: near duplicates ------------------------------------------------------------

def brute_components(docs):
    sets = {}
    for d, t in docs:
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").split()
        sets.setdefault(d, []).append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    ids = sorted(sets)
    root = {d: d for d in ids}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                lo, hi = sorted((top(a), top(b)))
                root[hi] = lo
    return {d: top(d) for d in ids}


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(500)]
    docs = []
    for _ in range(15):
        base = rng.choices(words, k=rng.randint(4, 120))
        for _ in range(rng.randint(1, 9)):
            own = list(base)
            for _ in range(rng.randint(0, 1 + len(base) // 18)):
                own[rng.randrange(len(own))] = rng.choice(words)
            docs.append(" ".join(own) if rng.random() < 0.7 else " ".join(own).upper())
    passage = " ".join(rng.choices(words, k=60))
    docs += [passage + " " + " ".join(rng.choices(words, k=k)) for k in (10, 12, 15, 20, 25, 30, 60, 100) for _ in range(4)]
    docs += docs[:9] + [passage]
    rng.shuffle(docs)
    data = list(enumerate(docs))
    got = jaccard.near_duplicates(spark.createDataFrame(data, "doc_id long, text string"))
    want = brute_components(data)
    assert {r.doc_id: r.component_id for r in got.collect()} == want
    assert 10 < len(set(want.values())) < len(docs) - 20


def test_large_group_of_near_copies_is_not_expanded(spark):
    rng = random.Random(2)
    base = [f"v{i}" for i in range(100)]
    docs = []
    for i in range(400):
        own = list(base)
        for p in rng.sample(range(100), 2):
            own[p] = f"u{rng.randrange(10 ** 6)}"
        docs.append((i, " ".join(own)))
    got = jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r.component_id for r in got.collect()} == {0}


def test_near_duplicates_of_odd_rows(spark):
    got = jaccard.near_duplicates(odd_docs(spark))
    r = rows(got, "doc_id", "component_id")
    assert (2, 1) in r and (8, 1) in r and (3, 3) in r and (None, None) in r and len(r) == 13
    assert (6, 1) in r and (7, 7) in r  # the long text repeats document 1: nearly the same set of shingles
    kept = jaccard.keep_first(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns and kept.filter("doc_id in (2, 8)").count() == 0
    assert jaccard.near_duplicates(no_docs(spark)).count() == 0


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}


# --- 8: packing --------------------------------------------------------------------

def test_packing(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    stream, docs_ids = [], {}
    for d, ids in brute_tokens(docs, "word_bpe_49k.json", 1):
        docs_ids[d] = ids
        stream.append(ids)
    whole = np.concatenate(stream)
    got = packing.pack(docs, tokenizer_path("word_bpe_49k.json")).collect()
    assert sum(r.length for r in got) == len(whole)
    for r in got:
        at = r.sequence_id * 2048 + r.offset
        piece = whole[at:at + r.length]
        assert r.offset + r.length <= 2048 and r.doc_tokens == len(docs_ids[r.doc_id])
        assert np.array_equal(piece, docs_ids[r.doc_id][r.start:r.start + r.length])
        assert zlib.crc32(piece.astype("<u4").tobytes()) == r.ids_crc32


def test_packing_of_odd_rows(spark):
    got = packing.pack(odd_docs(spark), tokenizer_path("word_bpe_49k.json"), length=64).collect()
    at = 0
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.sequence_id * 64 + r.offset == at
        at += r.length
    assert len({r.doc_id for r in got}) == 10
    assert packing.pack(no_docs(spark), tokenizer_path("word_bpe_49k.json")).count() == 0


# --- 9: neighbours -----------------------------------------------------------------

def brute_nearest(data, pick, k=5):
    ids = np.array([i for i, _ in data])
    x = np.array([v for _, v in data], np.float64)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in np.flatnonzero(pick(ids)):
        s = x @ x[q]
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[q]][:k]
        out[int(ids[q])] = [(int(ids[j]), s[j]) for j in order]
    return out


@pytest.mark.parametrize("kind,n,d", [("few", 4, 64), ("one", 1, 64), ("random", 3000, 768), ("clusters", 6000, 768), ("equal", 900, 64)])
def test_every_query_finds_five_or_all(spark, kind, n, d):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(n, d))
    if kind == "clusters":
        x = rng.normal(size=(n // 10, d))[rng.integers(0, n // 10, n)] + 0.5 * x
    if kind == "equal":  # a third of all rows on one axis
        x[: n // 3] = x[0]
    data = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").repartition(4)
    step = max(1, n // 60)
    want = brute_nearest(data, lambda i: i % step == 0)
    found = {}
    for r in crosspolytope.nearest(df, lambda i: i % step == 0).collect():
        found.setdefault(r.query_id, {})[r.rank] = r.vec_id
    assert set(found) == {q for q in want if want[q]}
    assert all(sorted(f) == list(range(1, min(5, n - 1) + 1)) for f in found.values())
    if kind == "equal":
        assert all(found[q][1] == (1 if q == 0 else 0) for q in found if q < n // 3)
    elif n > 1:
        hits = sum(v in {w for w, _ in want[q]} for q, f in found.items() for v in f.values())
        assert hits / sum(len(w) for w in want.values()) >= 0.9


@pytest.mark.parametrize("sf", [MID, "/root/testdata/sf0.1"])
def test_recall(spark, sf):
    data = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute_nearest(data, lambda i: i % 50 == 0)
    got = queries.op9_cross_polytope(spark, sf).collect()
    assert all(sorted(r.rank for r in got if r.query_id == q) == [1, 2, 3, 4, 5] for q in want)
    hits = sum((r.vec_id, ) in {(v,) for v, _ in want[r.query_id]} for r in got)
    assert hits / sum(map(len, want.values())) >= 0.9
    scores = {(q, v): s for q, x in want.items() for v, s in x}
    assert all(abs(scores[(r.query_id, r.vec_id)] - r.score) < 1e-12 for r in got if (r.query_id, r.vec_id) in scores)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    v = [(0, [1.0, 0.0, 0.0]), (1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (3, [0.0, 0.0, 0.0]), (4, None), (5, [nan, 1.0, 0.0]),
         (6, [inf, 0.0, 1.0]), (7, [1.0, None, 0.0]), (8, [1.0, 0.0]), (9, [0.0, 1.0, 0.0]), (9, [0.0, 1.0, 0.0]), (None, [1.0, 1.0, 1.0]), (10, [])]
    df = spark.createDataFrame(v, "vec_id long, embedding array<float>").withColumn("t", F.lit(1)).withColumn("axis", F.lit(1))
    got = rows(crosspolytope.nearest(df, lambda i: i % 9 == 0, probes=8), "query_id", "rank", "vec_id", "score")
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 9, 0.0), (9, 1, 0, 0.0), (9, 2, 1, 0.0), (9, 3, 2, 0.0)]
    assert crosspolytope.nearest(df.limit(0), lambda i: i >= 0).count() == 0


# --- 10: chat ----------------------------------------------------------------------

def test_parts_and_round_trip(spark):
    nasty = "<|end|> <|turn:user|>\x1bl| |> \x1b <\x1b| <|image:0|>"
    turns = [(1, 1, "assistant", [("text", "see ", None), ("image", "s3/a.png", 85), ("text", nasty, None), ("video", "v", None)]),
             (1, 0, "user", [("audio", "b.wav", 7), ("document", "c.pdf", 30), ("text", None, None)]),
             (1, 1, "assistant", None), (2, None, None, []), (None, 3, "a|>b", [("text", "x", None)])]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, parts array<struct<kind:string,body:string,tokens:long>>")
    df = df.withColumn("ts", F.lit(1)).withColumn("att", F.lit(2))
    out = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    one = out[1]
    assert [(a.slot, a.kind, a.ref, a.tokens) for a in one.attachments] == [
        (0, "audio", "b.wav", 7), (1, "document", "c.pdf", 30), (2, "image", "s3/a.png", 85), (3, "document", "v", 0)]
    assert one.expanded_tokens == 122 and len(one.turns) == 3
    assert one.loss_texts == ["", "see <|image:2|>" + nasty + "<|document:3|>"]
    assert [(t.role, t.text) for t in out[2].turns] == [("", "")] and [(t.role, t.text) for t in out[None].turns] == [("a|>b", "x")]
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_pipeline_against_stage_by_stage_brute_force(spark, tmp_path):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = corpus_pipeline.quality_stage(spark, docs, SMALL)
    assert out.schema == docs.schema and 0 < out.count() <= docs.count()
    lines = corpus_pipeline.line_stage(spark, out, SMALL)
    assert lines.dtypes == docs.dtypes
    seen = set()
    for r in lines.collect():
        assert r.n_chars == len(r.text)
        own = [n for n in (" ".join("".join(c if c.isalnum() else " " for c in x.lower()).split()) for x in r.text.split("\n"))
               if n.count(" ") >= 2]
        assert not seen & set(own) and len(own) == len(set(own))
        seen |= set(own)
    near = corpus_pipeline.near_duplicate_stage(spark, lines, SMALL)
    data = [(r.doc_id, r.text) for r in lines.collect()]
    assert sorted(r.doc_id for r in near.collect()) == sorted(set(brute_components(data).values()))
    clean = corpus_pipeline.benchmark_stage(spark, near, SMALL)
    bad = {r.doc_id for r in winnow.report(near, spark.read.parquet(f"{SMALL}/benchmark.parquet")).filter("n_hit > 0").collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in near.collect()} - bad
    packed = corpus_pipeline.packing_stage(spark, clean, SMALL).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in clean.collect()}
