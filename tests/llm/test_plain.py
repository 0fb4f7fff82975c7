"""Networks against plain forward passes, byte by byte; memory of very long texts; the
pipeline on odd rows."""

import math
import tracemalloc

import numpy as np
import pytest

from cloudcost.llm import langid, quality, repeats, substrings
from tests.llm.test_llm import LONG, SMALL, no_docs, odd_docs

TEXTS = [b"", b"a", b"short text, two lines\nof it", LONG.encode() * 3, "é日本語 ok\x00".encode() * 20, b"q" * 256, b"z" * 250, b"%x" * 700]


def plain_quality(net, text):
    """The score of one text by loops: positions, halves, chunks."""
    halves = max(2, -(-(len(text) + quality.WIDTH - quality.STEP) // quality.HALF))
    codes = list(text) + [quality.PAD] * (halves * quality.HALF - len(text))
    tops = np.full((halves, quality.FILTERS), -np.inf)
    for p in range(0, len(codes) - quality.WIDTH + 1, quality.STEP):
        seen = np.concatenate([net.embed[c] for c in codes[p:p + quality.WIDTH]])
        tops[p // quality.HALF] = np.maximum(tops[p // quality.HALF], seen @ net.conv)
    hidden = []
    for i in range(halves - 1):
        pooled = np.maximum(np.maximum(tops[i], tops[i + 1]) + net.conv_b, 0)
        hidden.append(np.maximum(pooled @ net.dense + net.dense_b, 0))
    return 1 / (1 + math.exp(-float(np.mean(hidden, axis=0) @ net.out + net.out_b[0])))


def joined(texts):
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])


@pytest.mark.parametrize("block", [quality.BLOCK, 3])
def test_quality_scores_are_those_of_a_plain_pass(monkeypatch, block):
    monkeypatch.setattr(quality, "BLOCK", block)
    net = quality.Network.start(11)
    rng = np.random.default_rng(0)
    for p in net.params():
        p += rng.normal(0, 0.2, p.shape).astype(np.float32)
    got = quality.score_texts(net, *joined(TEXTS))
    assert np.allclose(got, [plain_quality(net, t) for t in TEXTS], atol=1e-5) and np.ptp(got) > 1e-3


def plain_languages(net, text):
    """Mean probabilities over the bytes of a text, one byte and one gate after the other."""
    def states(d, codes):
        h, out = np.zeros(langid.STATE), []
        for c in codes:
            x = d.inp[c].astype(float)
            gates = np.clip((x[:2 * langid.STATE] + h @ d.gates) / 4 + 0.5, 0, 1)
            z, r = gates[:langid.STATE], gates[langid.STATE:]
            a = x[2 * langid.STATE:] + (r * h) @ d.cand
            h = h + z * (a / (1 + np.abs(a)) - h)
            out.append(h)
        return out
    total = np.zeros(len(net.langs))
    for at in range(0, len(text), langid.LENGTH):
        codes = list(text[at:at + langid.LENGTH])
        codes += [langid.PAD] * (langid.LENGTH - len(codes))
        ahead, back = states(net.forward, codes), states(net.backward, codes[::-1])[::-1]
        for c, f, b in zip(codes, ahead, back):
            if c != langid.PAD:
                e = np.exp(f @ net.out[:langid.STATE] + b @ net.out[langid.STATE:] + net.out_b)
                total += e / e.sum()
    return total / max(total.sum(), 1e-12)


def test_languages_are_those_of_a_plain_pass():
    net = langid.Network.start(["de", "en", "fr"], 4)
    got = langid.predict_texts(net, *joined(TEXTS))
    assert np.allclose(got, [plain_languages(net, t) for t in TEXTS], atol=1e-4) and np.ptp(got) > 1e-2


def peak(f):
    tracemalloc.start()
    try:
        f()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_a_very_long_text_takes_bounded_memory():
    data = np.random.default_rng(1).integers(32, 120, 50_000_000).astype(np.uint8)
    whole = np.array([0, len(data)])
    assert peak(lambda: quality.score_texts(quality.Network.start(1), data, whole)) < 500
    assert peak(lambda: substrings.anchors(data, whole)) < 500


def test_long_data_have_the_same_anchors_in_pieces(monkeypatch):
    rng = np.random.default_rng(5)
    data = rng.integers(97, 101, 30000).astype(np.uint8)
    offsets = np.array([0, 7, 7, 12000, 12049, 30000])
    monkeypatch.setattr(substrings, "PIECE", 1000)

    def strings_of(found):
        return {p: (r, h) for r, lo, hi, h in zip(*(x.tolist() for x in found)) for p in range(lo, hi - substrings.LENGTH + 1)}
    assert strings_of(substrings.anchors(data, offsets)) == strings_of(substrings._anchors(data, offsets))


def test_anchors_are_dealt_evenly():
    data = np.random.default_rng(9).integers(97, 123, 400_000, dtype=np.uint8)
    found = np.sort(substrings.anchors(data, np.array([0, len(data)]))[3])
    counts = np.diff(repeats._ranges(found, 16))
    assert counts.sum() == len(found) and counts.max() < 1.5 * counts.mean()  # smallest hashes alone: 13 times


def test_removed_substrings_of_a_text_in_pieces(spark):
    rng = np.random.default_rng(6)
    shared = bytes(rng.integers(97, 123, 300).astype(np.uint8))
    body = [bytes(rng.integers(97, 123, n).astype(np.uint8)) for n in (1_200_000, 1_400_000, 900)]
    long = body[0] + shared + body[1] + shared[:80]
    docs = [(1, shared), (2, long), (3, body[2] + long[1_048_500:1_048_900])]
    df = spark.createDataFrame([(i, t.decode()) for i, t in docs], "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in substrings.remove_repeats(df, with_bytes=False).collect()}
    assert got == {1: (0, 0), 2: (380, 2), 3: (400, 1)}


# --- pipeline ----------------------------------------------------------------------

def test_stages_take_odd_and_empty_tables(spark):
    import corpus_pipeline
    for docs in (odd_docs(spark), no_docs(spark)):
        at = docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, at, SMALL)
            assert out.dtypes == docs.dtypes, name  # extra columns with clashing names stay
            kept = out.collect()
            assert len(kept) <= at.count()
            at = spark.createDataFrame(kept, docs.schema)
        ids = [r.doc_id for r in at.collect()]
        assert 3 not in ids or [r.text for r in at.collect() if r.doc_id == 3] == [None]
        packed = corpus_pipeline.packing_stage(spark, at, SMALL)
        assert {r.doc_id for r in packed.collect()} == set(ids)


def test_packing_after_all_stages_holds_every_kept_token(spark):
    import corpus_pipeline
    from cloudcost.llm.tokens import encoder, tokenizer_path
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").filter("doc_id < 60")  # a fixture of its own, not the query
    at = docs
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        before = {r.doc_id: r.text for r in at.collect()}
        at = spark.createDataFrame(stage(spark, at, SMALL).collect(), docs.schema)
        assert {r.doc_id for r in at.collect()} <= set(before)
    tok = encoder(tokenizer_path("word_bpe_49k.json")).tok
    want = {r.doc_id: len(tok.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in at.collect()}
    pieces = corpus_pipeline.packing_stage(spark, at, SMALL).collect()
    assert {d: sum(p.length for p in pieces if p.doc_id == d) for d in want} == want
    ends = sorted((p.sequence_id * 2048 + p.offset, p.length) for p in pieces)
    assert all(a + n == b for (a, n), (b, _) in zip(ends, ends[1:])) and ends[0][0] == 0


