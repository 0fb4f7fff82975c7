"""Quality classifier: a byte-level convolutional network in numpy.

Bytes get learned vectors; filters of ``WIDTH`` bytes slide over the whole text in
steps of ``STEP``. The text is covered by chunks of ``2 * HALF`` bytes that overlap by
half; in each chunk every filter keeps its maximum, a small dense layer looks at the
maxima, and the mean over all chunks gives one probability. A text of any length is
scored whole, many texts in one array.

``fit`` learns on the driver from a bounded sample: the ``max_docs`` labelled rows with
the smallest hash of their id, ``windows`` pieces of at most ``WINDOW`` characters from
each; the hash chooses their places, and the length of every second one, so that short
texts are learned too. ``score`` runs where the texts are.

Cases: null and empty texts are scored as a text of padding; repeated rows are scored
one by one; rows with a null label teach nothing; without any labelled row the score is
0.5 everywhere; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, slices, strings

EMBED, WIDTH, STEP, FILTERS, HIDDEN = 6, 8, 2, 32, 16
HALF = 128                    # bytes; a chunk is two halves
WINDOW, SHORT = 512, 160
PAD = 256
BLOCK = 4096                  # halves convolved at once
MAX_DOCS, WINDOWS, EPOCHS, BATCH = 4000, 3, 16, 128


@dataclass
class Network:
    embed: np.ndarray
    conv: np.ndarray
    conv_b: np.ndarray
    dense: np.ndarray
    dense_b: np.ndarray
    out: np.ndarray
    out_b: np.ndarray

    @classmethod
    def start(cls, seed: int) -> "Network":
        rng = np.random.default_rng(seed)

        def normal(*shape, scale):
            return rng.normal(0, scale, shape).astype(np.float32)
        return cls(normal(257, EMBED, scale=0.5), normal(WIDTH * EMBED, FILTERS, scale=0.2), np.zeros(FILTERS, np.float32),
                   normal(FILTERS, HIDDEN, scale=0.3), np.zeros(HIDDEN, np.float32),
                   normal(HIDDEN, scale=0.3), np.zeros(1, np.float32))

    def params(self) -> list[np.ndarray]:
        return [self.embed, self.conv, self.conv_b, self.dense, self.dense_b, self.out, self.out_b]


def _columns(net: Network, codes: np.ndarray) -> np.ndarray:
    """Rows of WIDTH byte vectors at every STEP of a flat code array."""
    x = net.embed[codes]
    view = np.lib.stride_tricks.sliding_window_view(x.reshape(-1), WIDTH * EMBED)[::STEP * EMBED]
    return np.ascontiguousarray(view)


def _probability(logit: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(logit.astype(np.float64), -40, 40)))


def score_texts(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Probability of every text."""
    sizes = np.diff(offsets)
    # each text gets whole halves, two at least, and WIDTH - STEP bytes of padding
    halves = np.maximum(2, -(-(sizes + WIDTH - STEP) // HALF))
    begin = np.concatenate([[0], np.cumsum(halves)]) * HALF
    codes = np.full(int(begin[-1]) + WIDTH, PAD, np.int16)
    for at, lo, hi in zip(begin[:-1].tolist(), offsets[:-1].tolist(), offsets[1:].tolist()):
        codes[at:at + hi - lo] = data[lo:hi]
    cross = (begin[1:, None] // STEP - np.arange(1, (WIDTH - STEP) // STEP + 1)).ravel()
    tops = np.empty((int(begin[-1]) // HALF, FILTERS), np.float32)
    per = HALF // STEP
    for lo in range(0, len(tops), BLOCK):    # of a long text only the pooled halves are held
        hi = min(lo + BLOCK, len(tops))
        z = _columns(net, codes[lo * HALF:hi * HALF + WIDTH])[:(hi - lo) * per] @ net.conv
        z[cross[(cross >= lo * per) & (cross < hi * per)] - lo * per] = -np.inf  # would look into the next text
        tops[lo:hi] = z.reshape(-1, per, FILTERS).max(1)
    chunk = np.maximum(tops[:-1], tops[1:])
    first = np.concatenate([[0], np.cumsum(halves)])
    inner = np.ones(len(tops) - 1, bool)
    inner[first[1:-1] - 1] = False           # pairs of halves of two texts
    hidden = np.maximum(np.maximum(chunk[inner] + net.conv_b, 0) @ net.dense + net.dense_b, 0)
    at = np.concatenate([[0], np.cumsum(halves - 1)])
    mean = np.add.reduceat(hidden.astype(np.float64), at[:-1], axis=0) / (halves - 1)[:, None]
    return _probability(mean @ net.out + net.out_b)


def _gradients(net: Network, codes: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    n, length = codes.shape
    flat = np.concatenate([codes, np.full((n, WIDTH), PAD, codes.dtype)], axis=1)
    per = (length + WIDTH) // STEP
    cols = _columns(net, np.append(flat.ravel(), [PAD] * WIDTH))[:n * per].reshape(n, per, -1)[:, :length // STEP]
    z = (cols.reshape(-1, WIDTH * EMBED) @ net.conv).reshape(n, length // HALF, HALF // STEP, FILTERS)
    where = z.argmax(2)
    tops = np.take_along_axis(z, where[:, :, None], 2)[:, :, 0]
    where = where + (np.arange(length // HALF) * (HALF // STEP))[None, :, None]
    right = tops[:, 1:] > tops[:, :-1]
    best = np.where(right, tops[:, 1:], tops[:, :-1])
    where = np.where(right, where[:, 1:], where[:, :-1])
    m = np.maximum(best + net.conv_b, 0)
    h = np.maximum(m @ net.dense + net.dense_b, 0)
    chunks = h.shape[1]
    mean = h.mean(1)
    d_logit = ((_probability(mean @ net.out + net.out_b) - y) / n).astype(np.float32)
    d_h = (d_logit[:, None] * net.out)[:, None, :] / chunks * (h > 0)
    d_m = (d_h @ net.dense.T) * (m > 0)
    rows = np.arange(n)[:, None, None]
    used = cols[rows, where]                                     # n, chunks, filters, width * embed
    d_conv = np.einsum("ncfk,ncf->kf", used, d_m)
    d_embed = np.zeros_like(net.embed)
    spots = flat[rows[..., None], where[..., None] * STEP + np.arange(WIDTH)]
    np.add.at(d_embed, spots, (d_m[..., None] * net.conv.T).reshape(*d_m.shape, WIDTH, EMBED))
    return [d_embed, d_conv, d_m.sum((0, 1)), np.einsum("ncf,nch->fh", m, d_h), d_h.sum((0, 1)),
            mean.T @ d_logit, d_logit.sum(keepdims=True)]


def _codes(texts: list[str]) -> np.ndarray:
    out = np.full((len(texts), WINDOW), PAD, np.int16)
    for i, t in enumerate(texts):
        raw = np.frombuffer(t.encode()[:WINDOW], np.uint8)
        out[i, :len(raw)] = raw
    return out


def train(texts: list[str], labels: list[int], seed: int = 5, epochs: int = EPOCHS) -> Network | None:
    """Adam on windows of labelled texts."""
    if not texts:
        return None
    net, rng = Network.start(seed), np.random.default_rng(seed)
    codes, y = _codes(texts), np.array(labels, np.float32)
    first = [np.zeros_like(p) for p in net.params()]
    second = [np.zeros_like(p) for p in net.params()]
    step = 0
    total = max(epochs * -(-len(y) // BATCH), 400)
    while step < total:
        order = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            pick = order[at:at + BATCH]
            step += 1
            rate = 0.01 * (1 - step / (total + 1)) + 1e-4
            for p, g, a, b in zip(net.params(), _gradients(net, codes[pick], y[pick]), first, second):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
            if step >= total:
                break
    return net


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, windows: int = WINDOWS, seed: int = 5) -> Network | None:
    """Learn from ``labels(doc_id, label)`` and the texts of at most ``max_docs`` of its
    rows (ids by hash); at most ``max_docs * windows * WINDOW`` characters reach the driver.
    Of the documents that repeat an id one stands for it (the one with the least pieces)."""
    chosen = bounded_sample(labels.filter("doc_id is not null and label is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label")), max_docs, ["doc_id", "label"])
    def piece(w):
        size = F.lit(WINDOW) if w % 2 == 0 else (F.pmod(F.xxhash64("doc_id", F.lit(-w)), F.lit(SHORT)) + 16).cast("int")
        room = F.greatest(F.char_length("text") - size + 1, F.lit(1))
        return F.substring("text", (F.pmod(F.xxhash64("doc_id", F.lit(w)), room) + 1).cast("int"), size)

    pieces = F.array(*[piece(w) for w in range(windows)])
    # chosen ids and labels are bounded by max_docs, and so are the groups
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
            .join(F.broadcast(chosen), "doc_id").select("doc_id", "label", pieces.alias("pieces"))
            .groupBy("doc_id", "label").agg(F.min("pieces").alias("pieces")).collect())
    rows.sort(key=lambda r: (r.doc_id, r.label, r.pieces))
    return train([p for r in rows for p in r.pieces], [r.label for r in rows for _ in r.pieces], seed)


def score(docs: DataFrame, net: Network | None) -> DataFrame:
    """``docs`` columns ``doc_id, text`` -> ``doc_id, score``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, limit=1 << 19):
                s = score_texts(net, *strings(piece.column("text"))) if net else np.full(piece.num_rows, 0.5)
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(s)], names=["doc_id", "score"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, score double"))


def keep_good(docs: DataFrame, net: Network | None, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches ``threshold``."""
    names = docs.columns
    kind = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, limit=1 << 19):
                s = score_texts(net, *strings(piece.column("text"))) if net else np.full(piece.num_rows, 0.5)
                kept = piece.filter(pa.array(s >= threshold))
                if kept.num_rows:
                    yield kept.select(names)

    return docs.mapInArrow(run, kind)
