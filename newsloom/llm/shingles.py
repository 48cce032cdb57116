"""Word shingles of whole texts as sorted sets of 64-bit hashes, by array operations over the texts' bytes."""

from __future__ import annotations

import numpy as np

from newsloom.llm.quality import mix

_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


class Shingler:
    """Cuts texts at ASCII blanks, lower-cases A-Z, and hashes every run of ``width`` words.

    A text with fewer words is one shingle, its whole sequence; without words it has none.
    """

    def __init__(self, width: int = 5, blank: np.ndarray | None = None):
        self.width = width
        if blank is None:
            blank = np.zeros(256, bool)
            blank[[32, *range(9, 14)]] = True
        self.blank = blank  # of every byte, whether it parts words
        rng = np.random.default_rng(1)
        byte = rng.integers(0, 2**64, 256, np.uint64, endpoint=False) | np.uint64(1)
        byte[65:91] = byte[97:123]
        self.byte = byte
        self._grow(1 << 12)

    def _grow(self, n: int) -> None:
        up, down = np.ones(n + 1, np.uint64), np.ones(n + 1, np.uint64)
        up[1:], down[1:] = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 2**64))
        self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words, one text after the other, and how many each text has."""
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        codes = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
        ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)
        if len(codes) >= len(self.up):
            self._grow(2 * len(codes))
        blank = self.blank[codes]
        begin = np.flatnonzero(~blank & np.r_[True, blank[:-1]])
        stop = np.flatnonzero(blank & np.r_[False, ~blank[:-1]])
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(self.byte[codes] * self.up[: len(codes)], out=sums[1:])
        return mix((sums[stop] - sums[begin]) * self.down[begin]), np.bincount(np.searchsorted(ends, begin, "right"), minlength=len(texts)).astype(np.int64)

    def runs(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all shingles in the order of the text, repeated ones too, and how many each text has."""
        words, counts = self.words(texts)
        w, n = self.width, len(words)
        full = np.zeros(max(0, n - w + 1), np.uint64)
        for k in range(w):
            full = full * _STEP + words[k : n - w + 1 + k] if n >= w else full
        doc = np.repeat(np.arange(len(texts)), counts)
        inside = doc[: len(full)] == doc[w - 1 :] if n >= w else np.zeros(0, bool)
        out, owner = mix(full[inside]), doc[: len(full)][inside]
        short = np.flatnonzero((counts > 0) & (counts < w))
        if len(short):
            begin = np.cumsum(counts) - counts
            extra = np.array([self._short(words[begin[i] : begin[i] + counts[i]]) for i in short], np.uint64)
            out, owner = np.r_[out, extra], np.r_[owner, short]
            by = np.argsort(owner, kind="stable")
            out, owner = out[by], owner[by]
        return out, np.bincount(owner, minlength=len(texts)).astype(np.int64)

    def _short(self, words: np.ndarray) -> np.uint64:
        value = np.array([len(words)], np.uint64)
        for w in words:
            value = value * _STEP + w
        return mix(value)[0]

    def sets(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Each text's distinct shingles in ascending order, and how many it has."""
        runs, counts = self.runs(texts)
        ends = np.cumsum(counts)
        for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True):
            runs[a:b].sort()
        doc = np.repeat(np.arange(len(texts)), counts)
        keep = np.ones(len(runs), bool)
        keep[1:] = (runs[1:] != runs[:-1]) | (doc[1:] != doc[:-1])
        return runs[keep], np.bincount(doc[keep], minlength=len(texts)).astype(np.int64)
