"""Removal of lines that an earlier line nearly repeats: an exact set-similarity join.

A line is the set of its words (A-Z lower-cased). It is removed if a line before it, by (doc_id,
line number), has a Jaccard similarity of 0.8 or more; all lines are judged on the input.

Words are ordered by rarity, the same order for all lines: by a sketch of counts of fixed size, then by
hash. Two similar lines share a word among the first few of both (prefix filter), where enough words can
follow (positional filter), and differ little in size (length filter); a parity bitmap bounds their
difference. What passes is verified on the whole sets. Equal lines are one line throughout, so a
line that a third of all documents hold is sent once a task.

A bucket names a few earliest candidates for each line and lists further ones, up to a fixed number, or a
smaller one where the pairs of the bucket would not fit into memory. Of lines that the first do not confirm,
those listed are verified too; for lines with still more in a bucket, and for them alone, that bucket is made
again from the texts and all their candidates are verified. Sets are read from the texts that hold them
first; a bitmap of fixed size picks those before they are shuffled.

Defined results: lines without a word stay; a null or empty text has one line without a word; a
null doc_id comes last; rows that repeat a doc_id share line numbers, and equal lines of the same
number stay both; an empty table gives no rows. ``remove_lines`` keeps all columns, whatever their
names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from trackmill.llm.common import batch, pack, partitions, slices, stored, table, unpack, utf8
from trackmill.llm.ngram_join import _dealt, sql
from trackmill.llm.shingles import mix, span_hashes, word_spans

CELLS = 1 << 22  # counters of the sketch: a fixed size whatever the input
ID_CELLS = 1 << 25  # and marks of document ids
BLOCKS = 64
OWNERS_AT_ONCE = 256
WORD_BYTES = 64  # longer words are hashed another way
FEW = 3  # candidates of a line that a bucket names at first
LISTED = 1024  # and those that it lists beside them
LEAST = 128  # where so many pairs would not fit
WIDTHS = (1, 2, 4, 8)  # words of a bitmap, for sets of up to so many words and beyond
LONG = (64, 160, 400)
PAIRS_AT_ONCE = 1 << 18
PAIRS_HELD = 1 << 22
NO_ID = np.iinfo(np.int64).max


LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)  # masks of the first n bytes


def _ceil(n: np.ndarray, over: int, under: int) -> np.ndarray:
    return -(-n * over // under)


def _sorted_within(owner: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Keys of up to 56 bits, ascending within their owner; owners ascend. Some owners at a time, each
    named by a byte above its keys, so that plain numbers are sorted."""
    high = np.uint64(56)
    packed = (owner.astype(np.uint64) << high) | keys
    many = int(owner[-1]) + 1 if len(owner) else 0
    edges = np.searchsorted(owner, np.arange(0, many + OWNERS_AT_ONCE, OWNERS_AT_ONCE))
    for low, end in zip(edges[:-1], edges[1:]):
        packed[low:end].sort()
    return packed & ((np.uint64(1) << high) - np.uint64(1))


class Sets:
    """Sets of hashes end to end, none of them empty."""

    def __init__(self, hashes: np.ndarray, owner: np.ndarray, many: int):
        self.hashes, self.owner = hashes, owner
        self.size = np.bincount(owner, minlength=many).astype(np.int64)
        self.start = np.cumsum(self.size) - self.size

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.start[i] : self.start[i] + self.size[i]]


def _word_hashes(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """56-bit hashes of the words of a text that begins and ends with a space, and where they start."""
    start, end = word_spans(text)
    size = end - start
    eights = np.ndarray(len(text), "<u8", buffer=text.tobytes() + bytes(8), strides=(1,))  # from any byte on
    left = np.clip(size, 0, 8).astype(np.uint64)
    hashes = mix((eights[start] & LOW_BYTES[left]) + size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    long = np.flatnonzero((size > 8) & (size <= WORD_BYTES))
    at = 8
    while len(long):
        left = np.minimum(size[long] - at, 8)
        hashes[long] = mix(hashes[long] + (eights[start[long] + at] & LOW_BYTES[left]))
        at += 8
        long = long[size[long] > at]
    longest = np.flatnonzero(size > WORD_BYTES)
    if len(longest):
        hashes[longest] = mix(span_hashes(text, start[longest], end[longest]))
    return hashes >> np.uint64(8), start


class Lines:
    """The lines with words of a batch, or of those only the lines with a word of given cells: owner
    document, number, set, and a name for the set."""

    def __init__(self, doc_ids: list, texts: list[bytes], cells: np.ndarray | None = None):
        # bytes.lower changes A-Z alone
        text = np.frombuffer((b"\n" + b"\n".join(texts) + b"\n").lower(), np.uint8)
        breaks = np.flatnonzero(text == 10)
        hashes, start = _word_hashes(text)
        line = np.searchsorted(breaks, start) - 1
        if cells is not None:
            wanted = np.zeros(len(breaks), dtype=bool)
            wanted[line[cells[hashes % np.uint64(CELLS)]]] = True
            hashes, line = hashes[wanted[line]], line[wanted[line]]
        change = np.append(True, line[1:] != line[:-1])[: len(line)]
        some, owner = line[change], np.cumsum(change) - 1
        # a word that a line repeats counts once
        hashes = _sorted_within(owner, hashes)
        new = np.append(True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1]))[: len(hashes)]
        self.sets = Sets(hashes[new], owner[new], len(some))
        first = np.cumsum([0] + [t.count(b"\n") + 1 for t in texts])
        self.doc = np.searchsorted(first, some, "right") - 1
        self.id = np.array([NO_ID if d is None else d for d in doc_ids], dtype=np.int64)[self.doc]
        self.number = some - first[self.doc]
        sums = mix(self.sets.hashes + np.uint64(3))
        total = np.add.reduceat(sums, self.sets.start) if len(some) else sums
        self.name = mix(total + self.sets.size.astype(np.uint64))

    def by_name(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the lines by name, the first line of each first, and where each name begins."""
        order = np.lexsort((self.number, self.id, self.name))
        name = self.name[order]
        return order, np.flatnonzero(np.append(True, name[1:] != name[:-1])[: len(order)])

    def earliest(self) -> np.ndarray:
        """Places of the first line of each name."""
        order, first = self.by_name()
        return np.sort(order[first])


# --- how rare words are ------------------------------------------------------------------------


def _packed(values: np.ndarray) -> bytes:
    """First bytes of all values, then second ones: most of the upper bytes are zero or equal."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def _unpacked(blob: bytes, kind: np.dtype) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(kind.itemsize, -1).T).view(kind).reshape(-1)


SKETCH = pa.schema([("block", pa.int64()), ("cells", pa.binary()), ("counts", pa.binary())])
PLACE = pa.struct([("doc_id", pa.int64()), ("line", pa.int64())])
READ = pa.schema([("name", pa.int64()), ("places", pa.list_(PLACE)), *SKETCH])
READ_SQL = f"name long, places array<struct<doc_id: long, line: long>>, {sql(SKETCH)}"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of two kinds, as the texts are cut once for both: the places of each line, equal lines of a
    slice together, and the counts of words."""
    cells = np.zeros(CELLS, dtype=np.int64)
    for rows in slices(batches):
        lines = Lines(rows["doc_id"].to_pylist(), list(utf8(rows["text"])))
        order, first = lines.by_name()
        chosen = np.zeros(len(lines.name), dtype=bool)
        chosen[order[first]] = True
        words = lines.sets.hashes[chosen[lines.sets.owner]]
        cells += np.bincount((words % np.uint64(CELLS)).astype(np.int64), minlength=CELLS)
        places = pa.StructArray.from_arrays([pa.array(lines.id[order]), pa.array(lines.number[order])], fields=list(PLACE))
        offsets = pa.array(np.append(first, len(order)), pa.int32())
        none = {f.name: pa.nulls(len(first), f.type) for f in SKETCH}
        names = lines.name[order[first]].view(np.int64)
        yield batch(READ, name=names, places=pa.ListArray.from_arrays(offsets, places), **none)
    for block, part in enumerate(cells.reshape(BLOCKS, -1)):
        used = part > 0
        if used.any():
            values = {"cells": [np.packbits(used).tobytes()], "counts": [_packed(part[used].astype("<u4"))]}
            yield batch(READ, name=[None], places=[None], block=[block], **values)


def _add_blocks(rows: pa.Table) -> pa.Table:
    total = np.zeros(CELLS // BLOCKS, dtype=np.int64)
    for cells, counts in zip(rows["cells"].to_pylist(), rows["counts"].to_pylist()):
        total[np.unpackbits(np.frombuffer(cells, np.uint8)).astype(bool)] += _unpacked(counts, np.dtype("<u4"))
    # two digits and an exponent order words well enough in a byte
    steps = np.minimum(255, np.where(total < 16, total, 16 + np.log2(np.maximum(total, 16) / 16) * 12))
    found = {"block": rows["block"].to_pylist()[:1], "cells": [b""], "counts": [pack(steps, "u1")]}
    return pa.table(found, schema=SKETCH)


def rarity(counted: DataFrame) -> np.ndarray:
    """One byte a cell, ascending with the count: CELLS bytes on the driver, at any scale."""
    rows = counted.groupBy("block").applyInArrow(_add_blocks, sql(SKETCH)).collect()
    out = np.zeros(CELLS, dtype=np.uint8)
    each = CELLS // BLOCKS
    for row in rows:
        out[row["block"] * each : (row["block"] + 1) * each] = np.frombuffer(bytes(row["counts"]), np.uint8)
    return out


# --- candidates --------------------------------------------------------------------------------

ENTRY = np.dtype([("word", "<u4"), ("name", "<u8"), ("id", "<i8"), ("line", "<i4"), ("n", "<i4"), ("at", "<i4")])
ENTRIES = pa.schema([("bucket", pa.int64()), ("entries", pa.binary()), ("bits", pa.binary())])
CANDIDATES = pa.schema(
    [
        ("bucket", pa.int64()),
        ("name", pa.int64()),
        ("id", pa.int64()),
        ("other", pa.int64()),
        ("other_id", pa.int64()),
        ("listed", pa.binary()),  # further candidates in the bucket and then their ids, on one row of the line
        ("over", pa.bool_()),  # and those are not all
        ("words", pa.binary()),  # if so: the line's words in the bucket
    ]
)


def _widths(n: np.ndarray) -> np.ndarray:
    return np.array(WIDTHS)[np.searchsorted(LONG, n)]


def _bitmaps(sets: Sets, words: int) -> np.ndarray:
    """Parities of the elements by bit, in ``words`` numbers a set; two sets differ in as many elements at
    least as their bitmaps differ in bits."""
    bit = sets.hashes >> np.uint64(7)
    place, one = (bit >> np.uint64(6)) % np.uint64(words), np.uint64(1) << (bit & np.uint64(63))
    out = np.zeros((len(sets.size), words), dtype=np.uint64)
    for k in range(words if len(out) else 0):
        out[:, k] = np.bitwise_xor.reduceat(np.where(place == k, one, np.uint64(0)), sets.start)
    return out


def _folded(bits: np.ndarray) -> np.ndarray:
    """Bitmaps of half the width."""
    half = bits.shape[1] // 2
    return bits[:, :half] ^ bits[:, half:]


def _some(sets: Sets, chosen: np.ndarray) -> Sets:
    new = np.cumsum(chosen) - 1
    use = chosen[sets.owner]
    return Sets(sets.hashes[use], new[sets.owner[use]], int(chosen.sum()))


def _entries(
    lines: Lines, chosen: np.ndarray, rank: np.ndarray, buckets: int, cells: np.ndarray | None
) -> Iterator[pa.RecordBatch]:
    sets, which = _some(lines.sets, chosen), np.flatnonzero(chosen)
    if not len(which):
        return
    # the order is that of 48 bits of a hash, which is one order for all sets even where those are equal
    rarest = rank[sets.hashes % np.uint64(CELLS)].astype(np.uint64) << np.uint64(48)
    word, owner = _sorted_within(sets.owner, rarest | (sets.hashes & np.uint64((1 << 48) - 1))), sets.owner
    at = np.arange(len(word)) - sets.start[owner]
    front = np.flatnonzero(at < (sets.size - _ceil(sets.size, 4, 5) + 1)[owner])
    use = word[front] >> np.uint64(48) > 1  # nothing else has a word that was counted once
    if cells is not None:  # only words of these cells
        use &= cells[word[front] % np.uint64(CELLS)]
    word, owner, at = word[front[use]], owner[front[use]], at[front[use]]
    word &= np.uint64((1 << 48) - 1)
    e = np.zeros(len(word), dtype=ENTRY)
    e["word"], e["n"], e["at"] = word & np.uint64(0xFFFFFFFF), sets.size[owner], at
    for name, values in (("name", lines.name), ("id", lines.id), ("line", lines.number)):
        e[name] = values[which][owner]
    # the bitmaps of all lines end to end
    width = _widths(sets.size)
    start = np.cumsum(width) - width
    bits = np.zeros(width.sum(), dtype=np.uint64)
    for words in WIDTHS:
        chosen = width == words
        if chosen.any():
            bits[start[chosen, None] + np.arange(words)] = _bitmaps(_some(sets, chosen), words)
    found = {"bucket": [], "entries": [], "bits": []}
    for bucket, part in _dealt(word, buckets):
        own = owner[part]  # lines in order, as an order by rarity keeps them so
        many = width[own]
        end = np.cumsum(many)
        found["bucket"].append(bucket)
        found["entries"].append(_packed(e[part]))
        found["bits"].append(pack(bits[np.arange(end[-1]) + np.repeat(start[own] - end + many, many)]))
    yield batch(ENTRIES, **found)


def _send_entries(rank: np.ndarray, buckets: int, cells: np.ndarray | None = None):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            lines = Lines(rows["doc_id"].to_pylist(), list(utf8(rows["text"])), cells)
            chosen = np.zeros(len(lines.name), dtype=bool)
            chosen[lines.earliest()] = True
            yield from _entries(lines, chosen, rank, buckets, cells)

    return send


def _gathered(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The entries of a bucket by word and size, one for each word and set; words of one entry are left
    out. All bitmaps, and where that of each entry begins."""
    e = np.concatenate([_unpacked(x, ENTRY) for x in rows["entries"].to_pylist()])
    bits = np.frombuffer(b"".join(rows["bits"].to_pylist()), "<u8")
    width = _widths(e["n"])
    start = np.cumsum(width) - width
    order = np.argsort(e["word"])
    word = e["word"][order]
    same = word[1:] == word[:-1]
    order = order[np.append(False, same) | np.append(same, False)] if len(order) else order
    key = (e["word"][order].astype(np.uint64) << np.uint64(32)) | e["n"][order].astype(np.uint64)
    order = order[np.lexsort((e["name"][order], key))]
    word, name = e["word"][order], e["name"][order]
    new = np.append(True, (word[1:] != word[:-1]) | (name[1:] != name[:-1]))[: len(order)]
    # of equal lines the earliest
    again = np.flatnonzero(~new | np.append(~new[1:], False))
    copies = order[again]
    order[again] = copies[np.lexsort((e["line"][copies], e["id"][copies], np.cumsum(new)[again]))]
    order = order[new]
    return e[order], bits, start[order]


class Bucket:
    """Pairs of similar size and bitmap among the lines that have a word in common."""

    def __init__(self, rows: pa.Table):
        self.e, bits, start = _gathered(rows)
        self.n = self.e["n"].astype(np.int64)
        self.at = self.e["at"].astype(np.int64)
        # a bitmap in every width that it has, by width: whose, where, and the bitmaps
        self.bits, width, wider = [], _widths(self.n), None
        for words in reversed(WIDTHS):
            there = width >= words
            place = np.cumsum(there) - 1
            level = np.zeros((int(there.sum()), words), dtype=np.uint64)
            own = width[there] == words
            level[own] = bits[start[there][own, None] + np.arange(words)]
            if wider is not None:
                level[~own] = _folded(wider)
            self.bits.insert(0, (there, place, level))
            wider = level
        # the lines, by age
        _, first, self.line = np.unique(self.e["name"], return_index=True, return_inverse=True)
        own = self.e[first]
        oldest = np.lexsort((own["name"], own["line"], own["id"]))
        self.oldest, self.names = oldest, own["name"][oldest].view(np.int64)
        self.age = np.empty(len(own), dtype=np.int64)
        self.age[oldest] = np.arange(len(own))
        self.age = self.age[self.line]
        self.when = (own["id"][oldest], own["line"][oldest])

    def _reach(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The entries that may be the smaller set of a pair, and for each entry the first and last of them
        that are of its word, not larger, and not too small."""
        word = self.e["word"]
        of = np.cumsum(np.append(False, word[1:] != word[:-1])[: len(word)]) << np.int64(32)
        key = of + self.n
        smaller = np.flatnonzero(self.at <= self.n - _ceil(self.n, 8, 9))
        low = np.searchsorted(key, of + _ceil(self.n, 4, 5))
        return smaller, np.searchsorted(smaller, low), np.searchsorted(smaller, np.arange(len(word)))

    def _pass(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs that the positional filter and the bitmaps leave; the set of ``x`` is the larger."""
        nx, ny = self.n[x], self.n[y]
        needed = _ceil(nx + ny, 4, 9)
        ok = np.minimum(nx - self.at[x], ny - self.at[y]) >= needed
        x, y, most = x[ok], y[ok], ((nx + ny) - 2 * needed)[ok]
        for there, place, bits in self.bits:
            both = np.flatnonzero(there[x] & there[y])
            apart = np.bitwise_count(bits[place[x[both]]] ^ bits[place[y[both]]]).sum(axis=1)
            ok = np.ones(len(x), dtype=bool)
            ok[both] = apart <= most[both]
            x, y, most = x[ok], y[ok], most[ok]
        return x, y

    def _cut(self, pairs: list[np.ndarray], most: int | None) -> np.ndarray:
        """Pairs once each, by line and age of the candidate, of each line the ``most`` earliest."""
        found = np.unique(np.concatenate([np.zeros(0, dtype=np.int64), *pairs]))
        if most is None or not len(found):
            return found
        line = found // len(self.names)
        start = np.flatnonzero(np.append(True, line[1:] != line[:-1]))
        many = np.diff(np.append(start, len(found)))
        return found[np.arange(len(found)) - np.repeat(start, many) < most]

    def pairs(self, only: np.ndarray | None, most: int | None, least: int = 0) -> tuple[np.ndarray, np.ndarray, int | None]:
        """Later and earlier line, as places by age; of a line the ``most`` earliest, or fewer, but ``least``,
        where those are too many to hold. How many that are in the end."""
        asked = np.ones(len(self.names), dtype=bool) if only is None else np.isin(self.names, only)
        smaller, low, high = self._reach()
        reach = np.maximum(high - low, 0)
        ends = np.cumsum(reach)
        out, held, at = [], 0, 0
        while at < len(reach):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS_AT_ONCE)))
            own = np.arange(at, min(to, len(reach)))
            x = np.repeat(own, reach[own])
            y = smaller[np.arange(len(x)) - np.repeat(np.cumsum(reach[own]) - reach[own], reach[own]) + low[x]]
            x, y = self._pass(x, y)
            later, earlier = np.maximum(self.age[x], self.age[y]), np.minimum(self.age[x], self.age[y])
            # texts with one id may have different lines of one number: neither is before the other
            apart = (self.when[0][later] != self.when[0][earlier]) | (self.when[1][later] != self.when[1][earlier])
            keep = asked[later] & apart
            out.append(later[keep] * len(self.names) + earlier[keep])
            held += len(out[-1])
            if most is not None and held > PAIRS_HELD:
                out = [self._cut(out, most)]
                while len(out[0]) > PAIRS_HELD // 2 and most > least:
                    most = max(least, most // 2)
                    out = [self._cut(out, most)]
                held = len(out[0])
            at = to
        return *np.divmod(self._cut(out, most), max(1, len(self.names))), most


def _name_candidates(few: int, most: int, least: int):
    """In a bucket: a few earliest candidates of each line, and a list of further ones."""

    def named(rows: pa.Table) -> pa.Table:
        bucket = Bucket(rows)
        later, earlier, held = bucket.pairs(None, few + most + 1, few + min(most, least) + 1)
        listed = held - few - 1
        start = np.flatnonzero(np.append(True, later[1:] != later[:-1])[: len(later)])
        many = np.diff(np.append(start, len(later)))
        nth = np.arange(len(later)) - np.repeat(start, many)
        kept = nth < few
        lists, words = np.full(len(later), None, dtype=object), np.full(len(later), None, dtype=object)
        ids = bucket.when[0]
        for at, n in zip(start[many > few], many[many > few]):
            further = earlier[at + few : at + min(n, few + listed)]
            lists[at] = pack(np.append(bucket.names[further], ids[further]), "<i8")
        full = start[many > few + listed]
        own = np.argsort(bucket.age, kind="stable")
        for at in full:
            low, high = np.searchsorted(bucket.age, [later[at], later[at] + 1], sorter=own)
            words[at] = pack(bucket.e["word"][own[low:high]])
        return pa.table(
            {
                "bucket": np.full(int(kept.sum()), rows["bucket"][0].as_py()),
                "name": bucket.names[later[kept]],
                "id": ids[later[kept]],
                "other": bucket.names[earlier[kept]],
                "other_id": ids[earlier[kept]],
                "listed": pa.array(lists[kept].tolist(), pa.binary()),
                "over": np.repeat(many > few + listed, many)[kept],
                "words": pa.array(words[kept].tolist(), pa.binary()),
            },
            schema=CANDIDATES,
        )

    return named


NAMED = pa.schema([("name", pa.int64()), ("id", pa.int64()), ("other", pa.int64()), ("other_id", pa.int64())])


def _all_candidates(key, rows: pa.Table, asked: pa.Table) -> pa.Table:
    if not (rows.num_rows and asked.num_rows):
        return NAMED.empty_table()
    bucket = Bucket(rows)
    later, earlier, _ = bucket.pairs(asked["name"].to_numpy(), None)
    names, ids = bucket.names, bucket.when[0]
    return pa.table(
        {"name": names[later], "id": ids[later], "other": names[earlier], "other_id": ids[earlier]}, schema=NAMED
    )


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        lists = [unpack(x, "<i8").reshape(2, -1) for x in rows["listed"].to_pylist()]
        others = np.concatenate([np.zeros((2, 0), np.int64), *lists], axis=1)
        names, ids = (np.repeat(rows[c].to_numpy(), [x.shape[1] for x in lists]) for c in ("name", "id"))
        yield batch(NAMED, name=names, id=ids, other=others[0], other_id=others[1])


MAP = pa.schema([("block", pa.int64()), ("bits", pa.binary())])


def _marks(cells: int, hashes: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    used = np.zeros(cells, dtype=bool)
    for some in hashes:
        used[some % np.uint64(cells)] = True
    for block, part in enumerate(used.reshape(BLOCKS, -1)):
        if part.any():
            yield batch(MAP, block=[block], bits=[np.packbits(part).tobytes()])


def _mark_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _marks(CELLS, (unpack(words) for rows in batches for words in rows["words"].to_pylist()))


def _mark_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _marks(ID_CELLS, (mix(rows["doc_id"].to_numpy().view(np.uint64)) for rows in batches))


def _join_cells(rows: pa.Table) -> pa.Table:
    bits = np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in rows["bits"].to_pylist()])
    return pa.table({"block": rows["block"].to_pylist()[:1], "bits": [bits.tobytes()]}, schema=MAP)


def _marked(marks: DataFrame, cells: int) -> np.ndarray:
    """Which cells have a mark: a bit each on the driver, at any scale."""
    out = np.zeros((BLOCKS, cells // BLOCKS // 8), dtype=np.uint8)
    for row in marks.groupBy("block").applyInArrow(_join_cells, sql(MAP)).collect():
        out[row["block"]] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return out.reshape(-1)


def _cells(words: DataFrame) -> np.ndarray:
    """Which cells the words fall in."""
    return np.unpackbits(_marked(words.mapInArrow(_mark_words, sql(MAP)), CELLS)).astype(bool)


def _with_ids(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts whose doc_id is in ``ids``, and few others: what is not wanted is not shuffled."""
    bits = texts.sparkSession.sparkContext.broadcast(_marked(ids.select("doc_id").mapInArrow(_mark_ids, sql(MAP)), ID_CELLS))

    @F.pandas_udf("boolean")
    def wanted(doc_id: pd.Series) -> pd.Series:
        cell = mix(doc_id.to_numpy().view(np.uint64)) % np.uint64(ID_CELLS)
        byte = bits.value[(cell >> np.uint64(3)).astype(np.int64)]
        return pd.Series((byte << (cell & np.uint64(7)).astype(np.uint8) & 128) > 0)

    return texts.filter(wanted("doc_id"))


# --- verification --------------------------------------------------------------------------------

SETS = pa.schema([("name", pa.int64()), ("words", pa.binary())])


def _wanted_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in slices(batches):
        lines = Lines(rows["doc_id"].to_pylist(), list(utf8(rows["text"])))
        names = [np.array(n, dtype=np.int64).view(np.uint64) for n in rows["names"].to_pylist()]
        wanted = np.concatenate([np.zeros(0, np.uint64), *names])
        places = lines.earliest()
        places = places[np.isin(lines.name[places], wanted)]
        yield batch(
            SETS,
            name=lines.name[places].view(np.int64),
            words=[pack(lines.sets.of(i)) for i in places],
        )


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        sides = [[unpack(x) for x in rows[c].to_pylist()] for c in ("words", "other_words")]
        n, m = (np.array([len(x) for x in side], dtype=np.int64) for side in sides)
        words = np.concatenate([np.zeros(0, np.uint64), *sides[0], *sides[1]])
        pair = np.concatenate([np.repeat(np.arange(len(n)), n), np.repeat(np.arange(len(m)), m)])
        order = np.lexsort((words, pair))
        words, pair = words[order], pair[order]
        twice = (words[1:] == words[:-1]) & (pair[1:] == pair[:-1])  # a set holds a word once
        common = np.bincount(pair[1:][twice], minlength=len(n))
        yield rows.select(["name"]).filter(pa.array(5 * common >= 4 * (n + m - common), pa.bool_()))


def _sets_of(texts: DataFrame, places: DataFrame) -> DataFrame:
    """Sets of the lines named in ``places``, each read from the document that holds it first."""
    # merged, as after a broadcast join the Python of both sides would run in one task, with a worker each
    joined = _with_ids(texts, places).alias("t").join(places.alias("p").hint("merge"), F.expr("t.doc_id <=> p.doc_id"))
    return joined.select("t.doc_id", "t.text", "p.names").mapInArrow(_wanted_sets, sql(SETS))


def _similar(candidates: DataFrame, texts: DataFrame) -> DataFrame:
    """name of each line that is similar to a candidate."""
    pairs = stored(candidates.select(*NAMED.names).distinct())
    named = pairs.select("name", "id").unionAll(pairs.select("other", "other_id"))
    places = stored(named.groupBy(F.col("id").alias("doc_id")).agg(F.collect_set("name").alias("names")))
    sets = stored(_sets_of(texts, places).dropDuplicates(["name"]))
    others = sets.select(F.col("name").alias("other"), F.col("words").alias("other_words"))
    met = pairs.select("name", "other").join(sets, "name").join(others, "other")
    return stored(met.mapInArrow(_confirm, "name long").distinct())


def removed_lines(docs: DataFrame) -> DataFrame:
    """doc_id, line, name: each line to remove (line numbers from 0)."""
    buckets = partitions(docs.sparkSession)
    # a null doc_id is last: the largest number stands for it
    texts = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "text")
    read = stored(texts.mapInArrow(_read, READ_SQL))
    rank = rarity(read.filter("block is not null").select("block", "cells", "counts"))
    lines = read.filter("name is not null").select("name", "places")
    first = stored(lines.groupBy("name").agg(F.min(F.col("places")[0]).alias("at")).select("name", "at.*"))
    found = stored(
        texts.mapInArrow(_send_entries(rank, buckets), sql(ENTRIES))
        .groupBy("bucket")
        .applyInArrow(_name_candidates(FEW, LISTED, LEAST), sql(CANDIDATES))
    )
    repeats = _similar(found, texts)
    left = stored(found.filter("listed is not null").join(repeats, "name", "left_anti"))
    if not left.isEmpty():
        new = _similar(left.select("name", "id", "listed").mapInArrow(_listed, sql(NAMED)), texts)
        repeats = repeats.unionAll(new)
        left = stored(left.filter("over").join(new, "name", "left_anti").select("bucket", "name", "words"))
        if not left.isEmpty():
            entries = texts.mapInArrow(_send_entries(rank, buckets, _cells(left.select("words"))), sql(ENTRIES))
            asked = left.select("bucket", "name")
            rest = entries.groupBy("bucket").cogroup(asked.groupBy("bucket")).applyInArrow(_all_candidates, sql(NAMED))
            repeats = repeats.unionAll(_similar(rest, texts))
    fate = first.join(repeats.withColumn("repeats", F.lit(True)), "name", "left").select(
        "name", F.struct("doc_id", "line").alias("first"), "repeats"
    )
    # equal lines of a slice are one row until it is known which of them go
    gone = lines.join(fate, "name").filter("repeats or size(places) > 1 or places[0] > first")
    gone = gone.select("name", "first", "repeats", F.explode("places").alias("at")).filter("repeats or at > first")
    return gone.select(F.nullif("at.doc_id", F.lit(NO_ID)).alias("doc_id"), "at.line", "name")


def remove_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the remaining lines as text, rows and columns as they were."""
    gone = removed_lines(docs).groupBy(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id")).agg(
        F.collect_list("line").alias("lines"), F.collect_list("name").alias("names")
    )  # one list for each document, of its own lines
    gone = gone.select(F.col("doc_id").alias("_gone_id"), F.col("lines").alias("_gone_lines"), F.col("names").alias("_gone_names"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            kept = []
            for doc_id, text, numbers, names in zip(*(rows[c].to_pylist() for c in ("doc_id", "text", *drop[1:]))):
                if not numbers or text is None:
                    kept.append(text)
                    continue
                lines = Lines([doc_id], [text.encode()])
                own = {int(n): int(i) for n, i in zip(lines.number, lines.name.view(np.int64))}
                lost = {n for n, i in zip(numbers, names) if own.get(n) == i}
                kept.append("\n".join(x for n, x in enumerate(text.split("\n")) if n not in lost))
            out = rows.drop_columns(drop)
            yield out.set_column(out.schema.get_field_index("text"), "text", pa.array(kept, pa.string()))

    drop = ["_gone_id", "_gone_lines", "_gone_names"]
    own = F.coalesce(docs["doc_id"], F.lit(NO_ID)) == gone["_gone_id"]
    return docs.join(gone, own, "left").mapInArrow(cut, docs.schema)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_removed, removed: numbers of the lines that go, of documents that lose any."""
    gone = removed_lines(table(spark, sf_dir, "documents"))
    return gone.groupBy("doc_id").agg(
        F.count("*").alias("n_removed"), F.array_sort(F.collect_list("line")).alias("removed")
    )
