"""Word shingles of whole batches of texts at once, as 64-bit hashes.

A-Z are lower-cased, words are runs of bytes other than space and \\t\\n\\v\\f\\r (which are never
part of a longer UTF-8 character). A text of fewer words than a shingle is one shingle as a whole.
"""

from __future__ import annotations

import numpy as np

WORDS = 5
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BYTE = np.random.Generator(np.random.PCG64(7)).integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_SLICE = 1 << 16


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit number over all of them."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[:1] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, _SLICE), _powers(_INVERSE, _SLICE)


def span_hashes(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span; the spans ascend and do not overlap."""
    hashes = np.zeros(len(start), dtype=np.uint64)
    low = 0
    while low < len(start):  # by slices of text, as the powers of a place are tabled
        at = start[low]
        high = max(low + 1, int(np.searchsorted(end, at + _SLICE, "right")))
        part = _BYTE[text[at : end[high - 1]]]
        if len(part) > _SLICE:  # one span longer than a slice
            sums = np.sum(part * _powers(_BASE, len(part)), keepdims=True)
        else:
            total = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum(part * _UP[: len(part)], out=total[1:])
            s = start[low:high] - at
            sums = (total[end[low:high] - at] - total[s]) * _DOWN[s]
        hashes[low:high] = sums + (end[low:high] - start[low:high]).astype(np.uint64)
        low = high
    return mix(hashes)


def lowered(text: np.ndarray) -> np.ndarray:
    return _LOWER[text]


def word_spans(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word of ``text``, which begins and ends with a space."""
    space = _SPACE[text]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    return edges[::2], edges[1::2]


class ShingleSets:
    """The set of each text: ``hashes`` holds them end to end, ascending within a text."""

    def __init__(self, texts: list[bytes], words: int = WORDS):
        text = lowered(np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8))
        first = np.cumsum([1] + [len(t) + 1 for t in texts], dtype=np.int64)
        start, end = word_spans(text)
        word = span_hashes(text, start, end)
        doc = np.searchsorted(first, start, "right") - 1
        many = np.bincount(doc, minlength=len(texts))
        hashes = np.zeros(max(0, len(word) - words + 1), dtype=np.uint64)
        for i in range(words):
            hashes = mix(hashes * np.uint64(_BASE) + word[i : len(word) - words + 1 + i])
        whole = np.flatnonzero(doc[: len(hashes)] == doc[words - 1 :]) if len(hashes) else np.zeros(0, int)
        hashes, owner = hashes[whole], doc[whole]
        few = np.flatnonzero((many > 0) & (many < words))
        if len(few):
            begin = np.searchsorted(doc, few)
            extra = np.zeros(len(few), dtype=np.uint64)
            for i in range(words - 1):
                there = i < many[few]
                extra[there] = mix(extra[there] * np.uint64(_BASE) + word[begin[there] + i])
            hashes = np.append(hashes, mix(extra + many[few].astype(np.uint64)))
            owner = np.append(owner, few)
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        new = np.ones(len(hashes), dtype=bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        self.hashes, self.owner = hashes[new], owner[new]
        self.size = np.bincount(self.owner, minlength=len(texts)).astype(np.int64)
        self.start = np.cumsum(self.size) - self.size

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.start[i] : self.start[i] + self.size[i]]

    def sums(self, seed: int) -> np.ndarray:
        """A fingerprint of each whole set."""
        total = np.zeros(len(self.size), dtype=np.uint64)
        np.add.at(total, self.owner, mix(self.hashes + np.uint64(seed)))
        return mix(total + self.size.astype(np.uint64))
