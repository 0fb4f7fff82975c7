"""Benchmark decontamination by winnowing.

Words are runs of digits, letters a-z and non-ASCII characters after lower-casing A-Z.
A benchmark item's windows are its runs of ``SPAN`` (10) words; an item of fewer words
is one window. Winnowing hashes every run of ``GRAM`` words and keeps the smallest hash
of each ``SPAN - GRAM + 1`` neighbouring runs (the last on ties). The choice depends on
the window's words alone, so a span of ``SPAN`` or more words that a document shares
with an item leaves the same kept hash, at the same place in the span, on both sides:
none is missed. Items shorter than ``SPAN`` are looked up by the hash of all their
words, at every position of the documents.

Document fingerprints meet the benchmark's in a shuffle join (Spark broadcasts the
benchmark's side only below its own size threshold). Before that, a bitmap of fixed
size over the benchmark's hashes drops fingerprints that cannot match; a larger
benchmark only makes it let more through. Every match carries the words around it, and
the join keeps a window only if its words are equal, so the result is exact.

Cases: null texts have no words; repeated rows are documents of their own (rows equal
in id and text share their result); items without id mark words but are not listed;
a repeated item id counts once; empty tables give no hits. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, gram_hashes, range_hashes, separators, slices, strings, word_ranges, written

GRAM, SPAN = 5, 10
REACH = SPAN - GRAM          # words a window can have before its kept run
BITS = 1 << 20
SEP = separators([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])

_HITS = "array<struct<fp:bigint,pos:int,before:int,words:array<string>>>"
_HIT_TYPE = pa.list_(pa.struct([("fp", pa.int64()), ("pos", pa.int32()), ("before", pa.int32()),
                                ("words", pa.list_(pa.string()))]))


def kept_runs(grams: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """Positions of the kept runs. ``valid[i]``: SPAN words from i lie in one text."""
    width = SPAN - GRAM + 1
    n = len(grams) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best = grams[:n].copy()
    at = np.zeros(n, np.int64)
    for j in range(1, width):
        later = grams[j:j + n]
        take = later <= best
        best[take] = later[take]
        at[take] = j
    starts = np.flatnonzero(valid[:n])
    return np.unique(starts + at[starts])


class _Slice:
    """Words of a slice of texts."""

    def __init__(self, column):
        data, offsets = strings(column)
        self.data = LOWER[data]
        self.starts, self.ends, self.first = word_ranges(self.data, offsets, SEP)
        self.hashes = range_hashes(self.data, self.starts, self.ends)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)
        self.last = np.repeat(self.first[1:], self.counts)  # end of each word's text, in words

    def words(self, lo: int, hi: int) -> list[str]:
        return [self.data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(self.starts[lo:hi], self.ends[lo:hi])]

    def spans(self) -> tuple[np.ndarray, np.ndarray]:
        """Kept runs: their first word and hash."""
        grams = gram_hashes(self.hashes, GRAM)
        at = np.arange(len(grams))
        pos = kept_runs(grams, at + SPAN <= self.last[:len(grams)])
        return pos, grams[pos]

    def hits(self, pos: np.ndarray, fps: np.ndarray, around: bool, size: int) -> list[tuple]:
        """(row, hit) with the words a window around the run can have."""
        out = []
        for p, h in zip(pos.tolist(), fps.tolist()):
            d = self.doc[p]
            lo = max(p - REACH, int(self.first[d])) if around else p
            hi = min(p + SPAN, int(self.first[d + 1])) if around else p + size
            out.append((int(d), {"fp": h - (1 << 64) if h >= 1 << 63 else h, "pos": p - int(self.first[d]),
                                 "before": p - lo, "words": self.words(lo, hi)}))
        return out


def _per_row(hits: list[tuple], rows: int) -> list[list]:
    out: list[list] = [[] for _ in range(rows)]
    for d, h in hits:
        out[d].append(h)
    return out


def _item_hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch):
            s = _Slice(piece.column("text"))
            hits = s.hits(*s.spans(), True, 0)
            for m in range(1, SPAN):
                own = np.flatnonzero(s.counts == m)
                pos = s.first[:-1][own]
                if len(pos):
                    hits += s.hits(pos, gram_hashes(s.hashes, m)[pos], False, m)
            yield pa.RecordBatch.from_arrays(
                [piece.column("item_id"), pa.array(np.minimum(s.counts, SPAN).astype(np.int32)),
                 pa.array(_per_row(hits, len(s.counts)), _HIT_TYPE)], names=["item_id", "span", "hits"])


def _doc_hits(bitmap: bytes, short: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap, np.uint8)

        def known(fps: np.ndarray) -> np.ndarray:
            low = fps & np.uint64(BITS - 1)
            return (bits[(low >> np.uint64(3)).astype(np.int64)] >> (low & np.uint64(7)).astype(np.uint8)) & 1 == 1

        for batch in batches:
            for piece in slices(batch):
                s = _Slice(piece.column("text"))
                pos, fps = s.spans()
                keep = known(fps)
                hits = s.hits(pos[keep], fps[keep], True, 0)
                for m in short:
                    fps = gram_hashes(s.hashes, m)
                    at = np.arange(len(fps))
                    pos = np.flatnonzero((at + m <= s.last[:len(fps)]) & known(fps))
                    hits += s.hits(pos, fps[pos], False, m)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), piece.column("row_key"), pa.array(s.counts.astype(np.int64)),
                     pa.array(_per_row(hits, len(s.counts)), _HIT_TYPE)], names=["doc_id", "row_key", "n_words", "hits"])

    return run


def scan(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(documents, hits)``: ``doc_id, row_key, n_words`` of every row, and
    ``doc_id, row_key, start, span, item_id`` of every occurrence of a window
    (``start`` in words). Both inputs have an id and a ``text``."""
    fps = written(items.select(F.col("item_id").cast("string").alias("item_id"), "text")
                  .mapInArrow(_item_hits, f"item_id string, span int, hits {_HITS}")
                  .select("item_id", "span", F.explode("hits").alias("h"))
                  .select("item_id", "span", F.col("h.fp").alias("fp"), F.col("h.before").alias("i_before"),
                          F.col("h.words").alias("i_words")).distinct(), "item-prints")
    # at most BITS and SPAN numbers, whatever the size of the benchmark
    slots = [r.b for r in fps.select(F.col("fp").bitwiseAND(BITS - 1).alias("b")).distinct().collect()]
    bitmap = np.zeros(BITS // 8, np.uint8)
    np.bitwise_or.at(bitmap, np.array(slots, np.int64) >> 3, (1 << (np.array(slots, np.int64) & 7)).astype(np.uint8))
    short = sorted(r.span for r in fps.filter(F.col("span") < SPAN).select("span").distinct().collect())
    # the row key tells rows of one id apart
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.xxhash64(F.col("doc_id").cast("long"), "text").alias("row_key"))
    done = written(rows.mapInArrow(_doc_hits(bitmap.tobytes(), short),
                                   f"doc_id long, row_key long, n_words long, hits {_HITS}"), "doc-prints")
    met = (done.select("doc_id", "row_key", F.explode("hits").alias("h"))
           .select("doc_id", "row_key", F.col("h.fp").alias("fp"), F.col("h.pos").alias("pos"),
                   F.col("h.before").alias("d_before"), F.col("h.words").alias("d_words"))
           .join(fps, "fp"))

    def same(shift):
        """The item's window that begins ``shift`` words before the run is the document's."""
        def window(words, before):
            return F.slice(F.col(words), F.col(before) - shift + 1, F.col("span"))
        return ((F.col("d_before") >= shift) & (F.col("i_before") >= shift)
                & (F.size("d_words") - F.col("d_before") + shift >= F.col("span"))
                & (F.size("i_words") - F.col("i_before") + shift >= F.col("span"))
                & F.when((F.col("d_before") >= shift) & (F.col("i_before") >= shift),
                         window("d_words", "d_before") == window("i_words", "i_before")).otherwise(False))

    shifts = F.filter(F.array(*[F.when(same(F.lit(j)), F.lit(j)) for j in range(REACH + 1)]), lambda x: x.isNotNull())
    hits = (met.select("doc_id", "row_key", "pos", "span", "item_id", F.explode(shifts).alias("shift"))
            .select("doc_id", "row_key", (F.col("pos") - F.col("shift")).alias("start"), "span", "item_id").distinct())
    return done.select("doc_id", "row_key", "n_words"), hits


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: ``doc_id, row_key, n_words, n_hit, items array<string>`` (ids of the
    items with an occurring window, sorted as strings)."""
    rows, hits = scan(docs, items)
    hits = written(hits, "window-hits")
    words = (hits.select("doc_id", "row_key", F.explode(F.sequence("start", F.col("start") + F.col("span") - 1)).alias("w"))
             .distinct().groupBy("doc_id", "row_key").agg(F.count("*").alias("n_hit")))
    named = (hits.select("doc_id", "row_key", "item_id").distinct().groupBy("doc_id", "row_key")
             .agg(F.array_sort(F.collect_list("item_id")).alias("items")))
    both = words.alias("a").join(named.alias("b"), F.expr("a.row_key = b.row_key and a.doc_id <=> b.doc_id")).select(
        F.col("a.row_key").alias("k"), F.col("a.doc_id").alias("d"), "n_hit", "items")
    return (rows.join(both, F.expr("row_key = k and doc_id <=> d"), "left")
            .select("doc_id", "row_key", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no window of any item."""
    _, hits = scan(docs, items)
    bad = hits.select("doc_id", "row_key").distinct()
    rows = docs.select(F.struct("*").alias("row"))  # whatever the columns are called
    doc_id = F.col("row.doc_id").cast("long")
    return rows.join(bad, (F.xxhash64(doc_id, "row.text") == bad.row_key) & doc_id.eqNullSafe(bad.doc_id),
                     "left_anti").select("row.*")
