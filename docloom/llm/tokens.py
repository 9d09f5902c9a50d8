"""Word-end BPE ids of whole texts, fast where words come again.

The vocabulary's pre-tokenizer never lets a token cross white space, so a text's ids are the ids of
its white-space chunks in order. Chunks are looked up in a bounded cache; only new ones are encoded.
The file of the vocabulary is a parameter; nothing is trained.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa

from docloom.llm.words import Spans, Table, buffers, spread

#: Letters, then marks that the pre-tokenizer puts into one token of their own.
_PLAIN = re.compile(r"([a-zß-öø-ÿ]+)([.,;:!?$%&*#|]*)")
#: The usual reversible byte alphabet: printable bytes stand for themselves, the others follow from 256.
_KEEP = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE = {b: chr(b) for b in _KEEP} | {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(_KEEP)))}


class ChunkIds:
    """Ids of texts. ``most`` bounds the chunks that are kept; when full they are dropped, which changes no result."""

    def __init__(self, path: str, most_bits: int = 21):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model, self.most_bits = self.tokenizer.model, most_bits
        self.lowers = "Lowercase" in (repr(self.tokenizer.normalizer) if self.tokenizer.normalizer else "")
        self._clear()

    def _clear(self) -> None:
        self.table, self.parts = Table(most_bits=self.most_bits), {}
        self.ids, self.used = np.zeros(1 << 16, "<u4"), 0
        self.begin, self.count, self.known = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), 0

    def _ids(self, chunk: str) -> tuple[int, ...]:
        m = _PLAIN.fullmatch(chunk.lower()) if self.lowers else None
        if m is None:
            return tuple(self.tokenizer.encode(chunk, add_special_tokens=False).ids)
        return self._part(m[1]) + self._part(m[2]) if m[2] else self._part(m[1])

    def _part(self, part: str) -> tuple[int, ...]:
        ids = self.parts.get(part)
        if ids is None:
            if len(self.parts) >= 150_000:
                self.parts.clear()
            word = part if part.isascii() else "".join(map(_BYTE.__getitem__, part.encode()))
            self.parts[part] = ids = tuple(x.id for x in self.model.tokenize(word))
        return ids

    def _learn(self, spans: Spans, h: np.ndarray, absent: np.ndarray) -> None:
        new, at = np.unique(h[absent], return_index=True)
        at, data = absent[at], spans.data
        found = [self._ids(data[a:b].tobytes().decode()) for a, b in zip(spans.starts[at].tolist(), spans.ends[at].tolist())]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), "<u4", int(counts.sum()))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        while self.known + len(found) > len(self.begin):
            self.begin, self.count = (np.concatenate((x, np.zeros_like(x))) for x in (self.begin, self.count))
        self.ids[self.used : self.used + len(flat)] = flat
        to = slice(self.known, self.known + len(found))
        self.begin[to], self.count[to] = self.used + np.cumsum(counts) - counts, counts
        self.table.put(new, np.arange(self.known, self.known + len(found), dtype=np.int32))
        self.used, self.known = self.used + len(flat), self.known + len(found)

    def batch(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text of an Arrow column, in order; null: none."""
        for _, data, offsets in buffers(column):
            if self.table.full():
                self._clear()
            spans = Spans(data, offsets)
            h = spans.hashes(folded=self.lowers) | np.uint64(1)
            word = self.table.get(h)
            if (absent := np.flatnonzero(word < 0)).size:
                self._learn(spans, h, absent)
                word = self.table.get(h)
            counts = self.count[word]
            flat = self.ids[spread(self.begin[word], counts)]
            bounds = np.concatenate(([0], np.cumsum(counts)))[spans.first]
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                yield flat[a:b]

    def encode(self, text: str) -> np.ndarray:
        return next(self.batch(pa.array([text], pa.string())))


_ready: dict[str, ChunkIds] = {}


def encoder(path: str) -> ChunkIds:
    """One encoder for each vocabulary file and Python worker."""
    if path not in _ready:
        _ready[path] = ChunkIds(path)
    return _ready[path]
