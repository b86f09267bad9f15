"""Word shingles as 63-bit hashes, from Arrow string columns without a Python loop over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# The white space bytes, and the multipliers of the splitmix64 finaliser.
BLANK_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
BLOCK = 1 << 18  # bytes looked at together; some 15 MB of numbers about them


def mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * MIX_1
        x = (x ^ (x >> np.uint64(27))) * MIX_2
        return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        steps = np.full(n, base % 2**64, np.uint64)
        steps[0] = 1
        return np.cumprod(steps, dtype=np.uint64)


class Words:
    """Hashes of the words of byte strings: runs without white space, A-Z lower-cased."""

    def __init__(self) -> None:
        lower = np.arange(256)
        lower[65:91] += 32
        self.value = mixed(lower.astype(np.uint64) + np.uint64(1))
        self.blank = np.isin(np.arange(256), BLANK_BYTES)
        self.up, self.down = np.empty(0, np.uint64), np.empty(0, np.uint64)

    def of(self, data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash and document of every word of ``data``; document k is edges[k]:edges[k + 1]."""
        if len(data) + 1 > len(self.up):
            n = len(data) + BLOCK
            self.up, self.down = powers(BASE, n), powers(pow(BASE, -1, 2**64), n)
        inside = ~self.blank[data]
        first = np.ones(len(data) + 1, bool)  # a document's border is a word's border
        first[1:-1] = ~inside[:-1]
        first[edges] = True
        last = np.ones(len(data) + 1, bool)
        last[1:-1] = ~inside[1:]
        last[edges] = True
        starts = np.flatnonzero(inside & first[:-1])
        ends = np.flatnonzero(inside & last[1:]) + 1
        with np.errstate(over="ignore"):
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(self.value[data] * self.up[: len(data)], out=sums[1:])
            own = (sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64)
        return mixed(own), np.searchsorted(edges, starts, side="right") - 1


def pieces(data: np.ndarray, lo: int, hi: int, blank: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts lo:hi into blocks that end at white space, so that no word is cut."""
    while hi - lo > BLOCK:
        at = lo + BLOCK
        while at < hi and not blank[data[at]]:
            at += 1
        yield lo, at
        lo = at
    yield lo, hi


def shingled(hashes: np.ndarray, width: int) -> np.ndarray:
    """The distinct shingles of one document as 63-bit numbers, sorted; with fewer words, all words as one."""
    n = min(width, len(hashes))
    if not n:
        return np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        total = np.full(len(hashes) - n + 1, n, np.uint64)
        for k, factor in enumerate(powers(BASE, width + 1)[1 : n + 1]):
            total += hashes[k : len(hashes) - n + 1 + k] * factor
    return np.unique((mixed(total) >> np.uint64(1)).astype(np.int64))


def documents(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The shingles of every text, in order. Memory: one block, and the word hashes of one group of texts."""
    words = Words()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    edges = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    k = 0
    while k < len(texts):
        stop = max(k + 1, int(np.searchsorted(edges, edges[k] + BLOCK, side="right")) - 1)
        stop = min(stop, len(texts))
        if stop > k + 1 or edges[stop] - edges[k] <= BLOCK:
            own, owner = words.of(data[edges[k] : edges[stop]], edges[k : stop + 1] - edges[k])
            cuts = np.searchsorted(owner, np.arange(stop - k + 1))
            for i in range(stop - k):
                yield shingled(own[cuts[i] : cuts[i + 1]], width)
        else:
            parts = [words.of(data[a:b], np.array([0, b - a]))[0] for a, b in pieces(data, edges[k], edges[stop], words.blank)]
            yield shingled(np.concatenate(parts), width)
        k = stop
