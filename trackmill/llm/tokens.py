"""Token ids of whole batches of texts, encoded piece by piece.

A public tokenizer never joins characters over certain borders. Texts are cut there, all of a
batch at once, and pieces are known by a 64-bit hash: the tokenizer encodes only those not met
before, and the ids of the others are copied from a table of bounded size.
"""

from __future__ import annotations

import os
from bisect import bisect_right
from functools import cache
from itertools import accumulate

import numpy as np

from trackmill.llm.shingles import lowered, span_hashes

KNOWN_PIECES = 1_500_000
KNOWN_IDS = 6_000_000
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[*range(9, 14), *range(28, 33)]] = True
# the last two bytes of the white space beyond ASCII: C2 85, C2 A0, 9A 80, 80 80..8A, 80 A8, ...
_WHITE_LAST = np.zeros(256, dtype=bool)
_WHITE_LAST[[*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = True
_WHITE_BEFORE = np.zeros(256, dtype=bool)
_WHITE_BEFORE[[0xC2, 0x80, 0x81, 0x9A]] = True
_GAP = np.zeros(256, dtype=bool)
_GAP[[*range(9, 14), 32]] = True
_GAPS = "\t\n\v\f\r "
_WORD = np.zeros(256, dtype=bool)
_WORD[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True
# an apostrophe may belong to the letters after it ('s, 'll)
_MARK = np.zeros(256, dtype=bool)
_MARK[list(b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~')] = True


def _end_to_end(found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids in one array, and how many each list has."""
    count = np.array([len(x) for x in found], dtype=np.int64)
    return np.fromiter((n for x in found for n in x), dtype=np.uint32, count=int(count.sum())), count


class PieceEncoder:
    """Encodes with one tokenizer file.

    ``joined``: the tokenizer keeps the space before a word with the word (byte-level BPE). A
    piece then starts at white space after something that is not white, and between an ASCII
    letter and a mark, on either side, but not after an apostrophe. Otherwise the tokenizer
    drops white space and case: pieces are the words between spaces, tabs and line ends, and
    A-Z are lower-cased.
    """

    def __init__(self, file: str, joined: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.encode_special_tokens = True
        self.joined = joined
        # byte-level tokens have a character for each byte
        spelled = self.tokenizer.get_vocab()
        self.n_bytes = np.zeros(max(spelled.values()) + 1, dtype=np.int64)
        self.n_bytes[list(spelled.values())] = [len(s) for s in spelled]
        self._clear()

    def _clear(self) -> None:
        self.hashes = np.zeros(0, dtype=np.uint64)  # ascending
        self.first = np.zeros(0, dtype=np.int64)
        self.count = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(1 << 16, dtype=np.uint32)
        self.used = 0

    def _cut(self, text: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of all pieces; ``begins`` are the starts of the texts that are not empty."""
        if self.joined:
            before, earlier = text[:-1], np.append(np.uint8(0), text[:-2])
            white = _WHITE[before] | (_WHITE_LAST[before] & _WHITE_BEFORE[earlier])
            starts = np.zeros(len(text), dtype=bool)
            after = text[1:]
            starts[1:] = (_GAP[after] & ~white) | (_WORD[before] & _MARK[after]) | (_MARK[before] & _WORD[after])
            starts[begins] = True
            start = np.flatnonzero(starts)
            return start, np.append(start[1:], len(text))
        gap = (text == 32) | (text == 10) | (text == 9)
        starts = ~gap
        starts[1:] &= gap[:-1]
        starts[begins] = ~gap[begins]
        ends = ~gap
        ends[:-1] &= gap[1:]
        ends[begins[1:] - 1] = ~gap[begins[1:] - 1]
        return np.flatnonzero(starts), np.flatnonzero(ends) + 1

    def _of_words(self, words: list[str]) -> tuple[list[int], np.ndarray, np.ndarray]:
        """Words may follow each other, so they are encoded as texts of a thousand."""
        found: list[list[int]] = [[] for _ in words]
        for at in range(0, len(words), 1000):
            part = words[at : at + 1000]
            starts = list(accumulate((len(w) + 1 for w in part), initial=0))
            one = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            for number, (start, _) in zip(one.ids, one.offsets):
                found[at + bisect_right(starts, start) - 1].append(number)
        return list(range(len(words))), *_end_to_end(found)

    def _of_pieces(self, pieces: list[str]) -> tuple[list[int], np.ndarray, np.ndarray]:
        """Texts of a thousand pieces, told apart by the bytes of their ids; a line end goes before words without a gap."""
        row, alone = [], []
        for i, p in enumerate(pieces):
            (alone if p[-1].isspace() or (p[0].isspace() and p[0] not in _GAPS) else row).append(i)
        ends = self.tokenizer.encode_batch_fast([pieces[i] for i in alone], add_special_tokens=False)
        ids, count = _end_to_end([one.ids for one in ends])
        ids, count = [ids], [count]
        for at in range(0, len(row), 1000):
            part = [pieces[i] if pieces[i][0] in _GAPS else "\n" + pieces[i] for i in row[at : at + 1000]]
            one = np.array(self.tokenizer.encode_batch_fast(["".join(part)], add_special_tokens=False)[0].ids, dtype=np.uint32)
            starts = np.cumsum([0, *(len(p.encode()) for p in part)])
            stops = np.cumsum(self.n_bytes[one])
            owner = np.searchsorted(starts, stops - self.n_bytes[one], "right") - 1
            put = np.array([pieces[i][0] not in _GAPS for i in row[at : at + 1000]])
            own = ~(put[owner] & (stops - self.n_bytes[one] == starts[owner]))
            ids.append(one[own])
            count.append(np.bincount(owner[own], minlength=len(part)))
        return alone + row, np.concatenate(ids), np.concatenate(count)

    def _learn(self, pieces: list[str], hashes: np.ndarray) -> None:
        named, new, count = self._of_pieces(pieces) if self.joined else self._of_words(pieces)
        first = self.used + np.cumsum(count) - count
        while self.used + len(new) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(new)] = new
        self.used += len(new)
        hashes = np.concatenate([self.hashes, hashes[named]])
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.first = np.concatenate([self.first, first])[order]
        self.count = np.concatenate([self.count, count])[order]

    def _some(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        text = np.frombuffer(b"".join(texts), np.uint8)
        if not len(text):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        if not self.joined:
            text = lowered(text)
        lengths = np.array([len(t) for t in texts])
        ends = np.cumsum(lengths)
        start, end = self._cut(text, (ends - lengths)[lengths > 0])
        hashes = span_hashes(text, start, end)
        distinct, where, which = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, distinct)
        known = np.zeros(len(distinct), dtype=bool)
        known[at < len(self.hashes)] = self.hashes[at[at < len(self.hashes)]] == distinct[at < len(self.hashes)]
        if not known.all():
            if len(self.hashes) + np.sum(~known) > KNOWN_PIECES or self.used > KNOWN_IDS:
                known[:] = False  # the table starts anew
                self._clear()
            spell = text.tobytes()
            new = np.flatnonzero(~known)
            pieces = [spell[start[i] : end[i]].decode() for i in where[new]]
            self._learn(pieces, distinct[new])
            at = np.searchsorted(self.hashes, distinct)
        count = self.count[at][which]
        stop = np.cumsum(count)
        take = np.repeat(self.first[at][which] - (stop - count), count)
        ids = self.ids[take + np.arange(len(take))]
        # pieces of a text end where the text ends
        total = np.append(0, stop)[np.searchsorted(start, ends)]
        return ids, np.diff(total, prepend=0)

    def encode_all(self, texts: list[bytes], most_bytes: int = 2 << 20) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and how many each has."""
        ids, counts, part, size = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)], [], 0
        for text in [*texts, None]:
            if part and (text is None or size + len(text) > most_bytes):
                found = self._some(part)
                ids.append(found[0]), counts.append(found[1])
                part, size = [], 0
            if text is not None:
                part.append(text)
                size += len(text)
        return np.concatenate(ids), np.concatenate(counts)

    def documents(self, texts: list[bytes], end: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode_all``, with the id ``end`` after every text."""
        ids, counts = self.encode_all(texts)
        stops = np.cumsum(counts)
        return np.insert(ids, stops, end), counts + 1


@cache
def encoder(file: str, joined: bool) -> PieceEncoder:
    """One encoder for each Python worker: Spark reuses workers, so its table lasts over tasks."""
    return PieceEncoder(file, joined)
