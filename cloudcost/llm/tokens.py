"""Encoding of whole texts with a public tokenizer file, by white-space segments.

Both supported files start a new piece at a single space between two other characters
and between a letter and a comma or full stop that white space follows. A text may be
cut there, and equal segments have equal ids. Each Python worker keeps the ids of up
to ``MEMO`` segments; only segments it has not seen are encoded, all those of a slice
in a few calls. The result is the library's own encoding of the whole text (tests
compare them); texts where a cut is not safe, and those that hold the string of an added
token such as ``<|endoftext|>``, which becomes that token, are encoded whole.
"""

from __future__ import annotations

import os
import re
from itertools import islice

import numpy as np

MEMO = 1_500_000  # about 130 bytes each
CALL = 1000  # segments joined in one text
_LOADED: dict[str, "SegmentEncoder"] = {}
# a comma or full stop before white space that no letter stands before; the capital I with
# a dot becomes a letter and a mark in lower case
_NO_LETTER = re.compile(r"[,.](?<![^\W\d_İ].)[ \n]")
_MARKS = {"\x01": ",", "\x02": "."}


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _safe(x: str) -> bool:
    """Only single spaces and newlines, inside, and none of the marks used below."""
    words = x.split()
    gaps = len(words) - 1
    return (gaps == x.count(" ") + x.count("\n") and len("".join(words)) + gaps == len(x)
            and "\x01" not in x and "\x02" not in x and "\x03" not in x)


def _plain(segment: str) -> str:
    """The text a segment key stands for: ``\\x01``, ``\\x02`` are a comma or full stop
    after a letter, ``\\x03X`` is ``.\\nX``, everything else follows a space."""
    if segment in _MARKS:
        return _MARKS[segment]
    return ".\n" + segment[1:] if segment[0] == "\x03" else " " + segment


class SegmentEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        # the strings of added tokens, which the library finds in a text before all else
        self.added = tuple({x for t in self.tok.get_added_tokens_decoder().values() for x in (t.content, t.content.lower())})
        # a character without case that all of them hold
        common = set.intersection(*map(set, self.added)) if self.added else set()
        self.added_mark = min((c for c in common if c.lower() == c.upper()), default="")
        self.dtype = np.dtype("<u2") if self.tok.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        bar = self.tok.encode(" |", add_special_tokens=False).ids
        self.bar = bar[0] if len(bar) == 1 else None
        # a tokenizer that lower-cases anyway has fewer different segments in lower case
        self.lower = '"Lowercase"' in self.tok.to_str().split('"pre_tokenizer"')[0]
        self.memo: dict[str, bytes] = {}

    def _holds_added(self, x: str) -> bool:
        if self.added_mark and self.added_mark not in x:
            return False
        low = x.lower()
        return any(a in x or a in low for a in self.added)

    def _ids(self, texts: list[str]) -> list[bytes]:
        enc = self.tok.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in enc]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text as little-endian bytes of ``dtype``; null is empty."""
        segments: list[list[str] | None] = []
        whole: list[str] = []
        for x in texts:
            if not x:
                segments.append(None)
                whole.append("")
            elif not _safe(x) or self._holds_added(x):
                segments.append(None)
                whole.append(x)
            else:
                if self.lower and "Σ" not in x and "İ" not in x:
                    x = x.lower()
                if not _NO_LETTER.search(x):
                    x = x.replace(", ", " \x01 ").replace(". ", " \x02 ").replace(".\n", " \x03")
                segments.append(x.split(" "))
        # the first segment follows no space
        whole += [s[0] for s in segments if s]
        done = self._ids(whole)
        heads = iter(done[len(done) - sum(s is not None for s in segments):])
        rest = iter(done)
        # most texts hold nothing new: their segments are looked up once
        tails, open_, get = [b""] * len(segments), [], self.memo.__getitem__
        for i, s in enumerate(segments):
            if s:
                try:
                    tails[i] = b"".join(map(get, islice(s, 1, None)))
                except KeyError:
                    open_.append(i)
        if open_:
            wanted = set().union(*(islice(segments[i], 1, None) for i in open_))
            new = wanted.difference(self.memo)
            if len(self.memo) + len(new) > MEMO:  # results never depend on what is remembered
                self.memo = {}
                new = wanted
            self._remember(list(new))
            get = self.memo.__getitem__
            for i in open_:
                tails[i] = b"".join(map(get, islice(segments[i], 1, None)))
        return [next(rest) if s is None else next(heads) + tail for s, tail in zip(segments, tails)]

    def _remember(self, fresh: list[str]) -> None:
        """Encode new segments, joined by a bar that is one id; marked segments, and
        those of a call in which a segment holds a bar or newline itself, go alone."""
        joined, owners = [], []
        alone = fresh if self.bar is None else [s for s in fresh if s[0] < "\x04"]
        if alone is not fresh:
            fresh = [s for s in fresh if s[0] >= "\x04"]
            for at in range(0, len(fresh), CALL):
                part = fresh[at:at + CALL]
                text = " " + " | ".join(part) + " |"
                if text.count("|") != len(part) or "\n" in text:
                    alone += [s for s in part if "|" in s or "\n" in s]
                    part = [s for s in part if "|" not in s and "\n" not in s]
                    text = " " + " | ".join(part) + " |"
                if part:
                    joined.append(text)
                    owners.append(part)
        if alone:
            self.memo.update(zip(alone, self._ids([_plain(s) for s in alone])))
        w = self.dtype.itemsize
        for part, e in zip(owners, self.tok.encode_batch_fast(joined, add_special_tokens=False) if joined else ()):
            ids = np.array(e.ids, self.dtype)
            cuts = np.flatnonzero(ids == self.bar) * w
            if len(cuts) != len(part):
                raise ValueError("a joined segment did not come apart")
            raw = ids.tobytes()
            starts = np.concatenate([[0], cuts[:-1] + w]).tolist()
            self.memo.update(zip(part, [raw[a:b] for a, b in zip(starts, cuts.tolist())]))


def encoder(path: str) -> SegmentEncoder:
    """The encoder of this Python worker for a tokenizer file."""
    if path not in _LOADED:
        _LOADED[path] = SegmentEncoder(path)
    return _LOADED[path]
