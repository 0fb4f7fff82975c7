"""Language identification: a bidirectional gated recurrent network over bytes.

Texts are cut into windows of ``LENGTH`` bytes; all windows of a slice advance together,
one byte a step, forwards and backwards. Both states of a position give a probability
for each language; a document's probabilities are the mean over all its bytes. Gates
use a clipped line instead of the logistic function and the candidate state x / (1 +
|x|), in training and use alike.

Training is backpropagation through time in numpy on the driver, on a bounded sample:
``WINDOWS`` windows from each of the ``max_docs`` rows with the smallest hash of their
id, at places that the hash chooses.

Cases: a text that is null or has no letter is ``und`` with score 0; repeated rows are
labelled one by one; rows with a null language teach nothing; without any such row
every language is ``und``; ties go to the first language in order; an empty table gives
no rows. Texts of any length are processed whole. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, slices, strings

STATE, LENGTH, PAD = 8, 64, 256
MAX_DOCS, WINDOWS, EPOCHS, BATCH = 2500, 3, 8, 200
UNKNOWN = "und"


@dataclass
class Direction:
    """Input tables (one row a byte) and recurrent weights of the gates z, r and the
    candidate."""
    inp: np.ndarray       # 257, 3 * STATE
    gates: np.ndarray     # STATE, 2 * STATE
    cand: np.ndarray      # STATE, STATE


@dataclass
class Network:
    langs: list[str]
    forward: Direction
    backward: Direction
    out: np.ndarray       # 2 * STATE, languages
    out_b: np.ndarray

    @classmethod
    def start(cls, langs: list[str], seed: int) -> "Network":
        rng = np.random.default_rng(seed)

        def normal(*shape, scale):
            return rng.normal(0, scale, shape).astype(np.float32)

        def direction():
            return Direction(normal(257, 3 * STATE, scale=0.5), normal(STATE, 2 * STATE, scale=0.4),
                             normal(STATE, STATE, scale=0.4))
        return cls(langs, direction(), direction(), normal(2 * STATE, len(langs), scale=0.3),
                   np.zeros(len(langs), np.float32))

    def params(self) -> list[np.ndarray]:
        return [*vars(self.forward).values(), *vars(self.backward).values(), self.out, self.out_b]


def _gate(x: np.ndarray) -> np.ndarray:
    x = x * np.float32(0.25)
    x += np.float32(0.5)
    return np.clip(x, 0, 1, out=x)


def _run(d: Direction, codes: np.ndarray, keep: bool = False):
    """States after every step (steps, windows, STATE); ``codes`` is (steps, windows).
    With ``keep`` also what backpropagation needs."""
    steps, n = codes.shape
    h = np.zeros((n, STATE), np.float32)
    states = np.empty((steps, n, STATE), np.float32)
    trace = []
    for s in range(steps):
        x = d.inp[codes[s]]
        zr = _gate(x[:, :2 * STATE] + h @ d.gates)
        z, r = zr[:, :STATE], zr[:, STATE:]
        rh = r * h
        a = x[:, 2 * STATE:] + rh @ d.cand
        c = a / (1 + np.abs(a))
        new = h + z * (c - h)
        if keep:
            trace.append((h, zr, rh, a, c))
        h = new
        states[s] = h
    return states, trace


def _back(d: Direction, codes: np.ndarray, trace: list, d_states: np.ndarray) -> list[np.ndarray]:
    g = [np.zeros_like(p) for p in vars(d).values()]
    d_h = np.zeros_like(d_states[0])
    for s in range(len(codes) - 1, -1, -1):
        h, zr, rh, a, c = trace[s]
        z, r = zr[:, :STATE], zr[:, STATE:]
        d_new = d_h + d_states[s]
        d_c = d_new * z
        d_a = d_c / np.square(1 + np.abs(a))
        d_rh = d_a @ d.cand.T
        open_gate = ((zr > 0) & (zr < 1)) * np.float32(0.25)
        d_zr = np.concatenate([d_new * (c - h), d_rh * h], axis=1) * open_gate
        g[1] += h.T @ d_zr
        g[2] += rh.T @ d_a
        np.add.at(g[0], codes[s], np.concatenate([d_zr, d_a], axis=1))
        d_h = d_new * (1 - z) + d_rh * r + d_zr @ d.gates.T
    return g


def _position_probabilities(net: Network, forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
    logits = forward @ net.out[:STATE] + backward @ net.out[STATE:] + net.out_b
    logits -= logits.max(-1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(-1, keepdims=True)
    return logits


def _gradients(net: Network, codes: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """``codes`` (steps, windows); the loss is the mean over positions that hold a byte."""
    fs, ft = _run(net.forward, codes, True)
    bs, bt = _run(net.backward, codes[::-1], True)
    bs = bs[::-1]
    p = _position_probabilities(net, fs, bs)
    real = (codes != PAD).astype(np.float32)
    p[:, np.arange(len(y)), y] -= 1
    p *= (real / max(real.sum(), 1))[..., None]
    flat = p.reshape(-1, len(net.langs))
    d_out = np.concatenate([fs.reshape(-1, STATE).T @ flat, bs.reshape(-1, STATE).T @ flat])
    return [*_back(net.forward, codes, ft, p @ net.out[:STATE].T),
            *_back(net.backward, codes[::-1], bt, (p @ net.out[STATE:].T)[::-1]), d_out, flat.sum(0)]


def train(texts: list[bytes], langs: list[str], seed: int = 7, epochs: int = EPOCHS) -> Network | None:
    """Adam on labelled windows."""
    if not texts:
        return None
    net, rng = Network.start(sorted(set(langs)), seed), np.random.default_rng(seed)
    codes = np.full((LENGTH, len(texts)), PAD, np.int16)
    for i, t in enumerate(texts):
        raw = np.frombuffer(t[:LENGTH], np.uint8)
        codes[:len(raw), i] = raw
    y = np.array([net.langs.index(x) for x in langs])
    first = [np.zeros_like(p) for p in net.params()]
    second = [np.zeros_like(p) for p in net.params()]
    step, total = 0, max(epochs * -(-len(y) // BATCH), 150)
    while step < total:
        order = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            pick = order[at:at + BATCH]
            step += 1
            rate = 0.02 * (1 - step / (total + 1)) + 2e-4
            for p, g, a, b in zip(net.params(), _gradients(net, codes[:, pick], y[pick]), first, second):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
            if step >= total:
                break
    return net


def fit(docs: DataFrame, max_docs: int = MAX_DOCS, windows: int = WINDOWS, seed: int = 7) -> Network | None:
    """Learn from ``docs(doc_id, text, lang)``; at most ``max_docs * windows * LENGTH``
    characters reach the driver."""
    room = F.greatest(F.char_length("text") - LENGTH + 1, F.lit(1))
    pieces = F.array(*[F.substring("text", (F.pmod(F.xxhash64("doc_id", F.lit(w)), room) + 1).cast("int"), F.lit(LENGTH))
                       for w in range(windows)])
    known = docs.filter("doc_id is not null and lang is not null and text is not null").select(
        "doc_id", "lang", pieces.alias("pieces"), F.col("text").rlike(r"\p{L}").alias("lettered"))
    rows = bounded_sample(known, max_docs, ["doc_id", "lang"]).filter("lettered").collect()
    rows.sort(key=lambda r: (r.doc_id, r.lang, r.pieces))
    return train([p.encode() for r in rows for p in r.pieces], [r.lang for r in rows for _ in r.pieces], seed)


def predict_texts(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean position probabilities of every text (texts, languages)."""
    sizes = np.diff(offsets)
    count = np.maximum(1, -(-sizes // LENGTH))
    begin = np.concatenate([[0], np.cumsum(count)])
    codes = np.full(int(begin[-1]) * LENGTH, PAD, np.int16)
    codes[np.repeat(begin[:-1] * LENGTH - offsets[:-1], sizes) + np.arange(len(data))] = data
    codes = codes.reshape(-1, LENGTH).T
    total = np.zeros((codes.shape[1], len(net.langs)))
    for at in range(0, codes.shape[1], 4096):
        part = np.ascontiguousarray(codes[:, at:at + 4096])
        p = _position_probabilities(net, _run(net.forward, part)[0], _run(net.backward, part[::-1])[0][::-1])
        total[at:at + 4096] = np.einsum("swl,sw->wl", p, (part != PAD).astype(np.float32))
    sums = np.add.reduceat(total, begin[:-1], axis=0)
    return sums / np.maximum(sums.sum(1, keepdims=True), 1e-12)


def identify(docs: DataFrame, net: Network | None) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, lang_pred, score``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, limit=1 << 19):
                known = np.asarray(piece.column("lettered").to_pylist(), bool) & (net is not None)
                lang = [UNKNOWN] * piece.num_rows
                score = np.zeros(piece.num_rows)
                if known.any():
                    p = predict_texts(net, *strings(piece.column("text")))
                    best = p.argmax(1)
                    lang = [net.langs[b] if k else UNKNOWN for b, k in zip(best, known)]
                    score = np.where(known, p.max(1), 0.0)
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(lang, pa.string()), pa.array(score)],
                                                 names=["doc_id", "lang_pred", "score"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered"))
            .mapInArrow(run, "doc_id long, lang_pred string, score double"))
