"""Best-fit packing by bin completion.

Documents become token pieces of at most ``capacity`` ids. Only the histogram of piece lengths,
``capacity`` numbers whatever the input, reaches the driver, where branch and bound picks fillings
and how often each is used. Pieces then find their place by their rank among the pieces of
their length, a lookup in every task.

Defined results: a null or empty text is one piece that holds the end id alone; rows that repeat
are packed once each; a null doc_id stays null; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from trackmill.llm.common import batch, partitions, stored, table, utf8
from trackmill.llm.tokens import encoder

CAPACITY = 2048
END = 0  # the id after every document
#: Nodes that the search may open. A first complete solution takes one a length at most.
NODES = 3000


PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
    ]
)


def token_pieces(docs: DataFrame, file: str, joined: bool, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every text's ids with the end id, cut to pieces."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            ids, n = encoder(file, joined).documents(list(utf8(rows["text"])), END)
            ends = np.cumsum(n)
            pieces = -(-n // capacity)
            doc = np.repeat(np.arange(len(n)), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(capacity, n[doc] - start)
            low = (ends - n)[doc] + start
            blob = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(blob[4 * a : 4 * b]) for a, b in zip(low.tolist(), (low + length).tolist())]
            yield batch(
                PIECES,
                doc_id=rows["doc_id"].cast(pa.int64()).take(pa.array(doc)),
                piece=piece,
                start=start,
                length=length,
                ids_crc32=crc,
            )

    return docs.select("doc_id", "text").mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


# --- the search, over the histogram of lengths -----------------------------------------------

Filling = tuple[tuple[int, int], ...]  # (length, how many of it), longest first


def _filling(lengths: list[int]) -> Filling:
    return tuple((n, lengths.count(n)) for n in sorted(set(lengths), reverse=True))


def best_fit_filling(counts: np.ndarray, largest: int, capacity: int) -> list[int]:
    """The longest piece that still fits, again and again."""
    lengths, room, used = [largest], capacity - largest, {largest: 1}
    while room:
        fitting = np.flatnonzero(counts[: room + 1])[::-1]
        n = next((int(n) for n in fitting if counts[n] > used.get(int(n), 0)), 0)
        if not n:
            break
        used[n] = used.get(n, 0) + 1
        lengths.append(n)
        room -= n
    return lengths


def _smeared(bits: int, by: int) -> int:
    """``bits``, each moved up by 0 to ``by``."""
    width = 1
    while width <= by:
        step = min(width, by + 1 - width)
        bits |= bits << step
        width += step
    return bits


class Completions:
    """The undominated fillings around the largest piece, the fullest first, one at a time.

    A filling is dominated if an available piece could take the place of some of its pieces that
    are no longer together, or the place of none: what is taken out fits wherever that piece lay.
    Totals descend; those of a total start with the longest pieces. Only what ``sums`` says can be
    completed is begun, so nothing is left out but what is dominated.
    """

    def __init__(self, counts: np.ndarray, largest: int, capacity: int):
        self.counts, self.largest, self.room = counts, largest, capacity - largest

    @cached_property
    def left(self) -> dict[int, int]:
        """How many there are of each length that fits beside the largest piece."""
        left = self.counts[: self.room + 1].tolist()
        if self.largest <= self.room:
            left[self.largest] -= 1
        return {n: many for n, many in enumerate(left) if n and many}

    @cached_property
    def lengths(self) -> list[int]:
        return sorted(self.left)

    @cached_property
    def available(self) -> int:
        return sum(1 << n for n in self.lengths)

    @cached_property
    def sums(self) -> list[int]:
        """The totals that the first i lengths can make, as bits."""
        full = (1 << self.room + 1) - 1
        sums = [1]
        for n in self.lengths:
            total, many, step = sums[-1], min(self.left[n], self.room // n), 1
            while many:
                step = min(step, many)
                total |= total << n * step & full
                many, step = many - step, 2 * step
            sums.append(total)
        return sums

    def rest(self) -> None:
        """Free the tables while other nodes are searched; they are built anew after it."""
        for name in ("left", "lengths", "available", "sums"):
            self.__dict__.pop(name, None)

    def _dominated(self, one: int, more: int, spare: int, unused: int) -> bool:
        """Whether a piece among ``unused`` can take the place of others; ``one`` and ``more`` hold
        the totals of single pieces and of several, ``spare`` is the room left."""
        # in place of several no shorter, in place of one or none longer, by the room left at most
        reach = _smeared(more, spare) | (_smeared(1 | one, spare - 1) << 1 if spare else 0)
        return bool(reach & unused)

    def _extend(self, high: int, rest: int, chosen: Filling, one: int, more: int, spent: int, spare: int) -> Iterator:
        if not rest:
            yield None if self._dominated(one, more, spare, self.available & ~spent) else chosen
            return
        for i in range(min(high, bisect_right(self.lengths, rest)) - 1, -1, -1):
            n = self.lengths[i]
            if not self.sums[i + 1] >> rest & 1:
                return
            for k in range(min(self.left[n], rest // n), 0, -1):
                if not self.sums[i] >> (rest - k * n) & 1:
                    continue
                several = more
                for copies in range(k):
                    several |= (one | several | (1 << n if copies else 0)) << n
                used_up = spent | (1 << n if k == self.left[n] else 0)
                above = (self.available & ~used_up) >> n << n
                if self._dominated(one | 1 << n, several, spare, above):
                    yield None
                    continue
                yield from self._extend(i, rest - k * n, (*chosen, (n, k)), one | 1 << n, several, used_up, spare)

    def fillings(self, enough: Callable[[int], bool]) -> Iterator[Filling | None]:
        """Fillings; None for each one that was begun and found dominated; as long as the total
        is ``enough``."""
        for total in range(self.room, -1, -1):
            spare = self.room - total
            if not enough(self.largest + total):
                return
            if sum(n * self.left[n] for n in self.lengths[: bisect_right(self.lengths, spare)]) > total:
                return  # of the pieces that fit the room left some are always unused
            if self.sums[-1] >> total & 1:
                for found in self._extend(len(self.lengths), total, (), 0, 0, 0, spare):
                    yield found if found is None else self._around(found)

    def _around(self, found: Filling) -> Filling:
        if found and found[0][0] == self.largest:
            return ((self.largest, found[0][1] + 1), *found[1:])
        return ((self.largest, 1), *found)


@dataclass
class Plan:
    """Fillings with how often each is used."""

    steps: list[tuple[Filling, int]] = field(default_factory=list)

    @property
    def sequences(self) -> int:
        return sum(times for _, times in self.steps)


def _times(counts: np.ndarray, filling: Filling) -> int:
    """How often the pieces left make the filling."""
    return min(int(counts[n]) // k for n, k in filling)


def _apply(counts: np.ndarray, filling: Filling, times: int) -> np.ndarray:
    """The pieces then left, up to the longest length there is: a path holds these of every node."""
    left = counts.copy()
    for n, k in filling:
        left[n] -= times * k
    return left[: np.flatnonzero(left)[-1] + 1].copy() if left.any() else left[:0].copy()


def _greedy(counts: np.ndarray, capacity: int, choose) -> Plan:
    plan, counts = Plan(), counts.copy()
    while counts.any():
        filling = choose(counts, int(np.flatnonzero(counts)[-1]), capacity)
        times = _times(counts, filling)
        counts = _apply(counts, filling, times)
        plan.steps.append((filling, times))
    return plan


#: Ways a node is tried in at first; the last search tries all, with the nodes that are left.
WIDTHS = (2, 4, None)


def _children(
    counts: np.ndarray, ways: Completions, enough: Callable[[int], bool], width: int | None
) -> Iterator[tuple[Filling, int] | None]:
    """Every filling as often as the pieces allow, then less often; None as in ``Completions``.

    The best fit comes second. With ``width`` only so many fillings, and none less often.
    """
    fit = _filling(best_fit_filling(counts, ways.largest, ways.largest + ways.room))
    tried, again = 0, False
    for filling in ways.fillings(enough):
        if filling is None or tried and filling == fit:
            yield None
            continue
        times = _times(counts, filling)
        tried, again = tried + 1, again or times > 1
        yield filling, times
        if tried == 1 and filling != fit:
            tried, times = 2, _times(counts, fit)
            again |= times > 1
            yield fit, times
        if width and tried >= width:
            return
    for filling in ways.fillings(enough) if again and not width else ():
        yield from ((filling, t) for t in range(_times(counts, filling) - 1, 0, -1)) if filling else [None]


def search(counts: np.ndarray, capacity: int = CAPACITY, nodes: int = NODES) -> Plan:
    """Fewest sequences found for ``counts[length]`` pieces of each length.

    The best-fit solution is the first incumbent. Depth first, every node fills around the largest
    piece left; a node is cut when the room wasted so far, with the pieces left, already needs as
    many sequences as the incumbent. Searches with few fillings a node come first, as they differ
    early; the last has all undominated ones. The search ends at the volume bound, which no packing
    beats, or after ``nodes`` nodes; a filling begun and found dominated is one, too.
    """
    sizes = np.arange(len(counts))
    bound = -(-int((counts * sizes).sum()) // capacity)
    incumbent = _greedy(counts, capacity, lambda *a: _filling(best_fit_filling(*a)))
    best, opened = incumbent.sequences, 0
    path: list[tuple[Filling, int]] = []
    stack: list[tuple] = []  # of each node on the path: pieces left, sequences used, ways, children

    def open_node(left: np.ndarray, used: int, width: int | None) -> None:
        remaining = int((left * sizes[: len(left)]).sum())

        def enough(total: int) -> bool:
            return used + 1 - (total - remaining) // capacity < best

        if stack:
            stack[-1][2].rest()
        ways = Completions(left, int(np.flatnonzero(left)[-1]), capacity)
        stack.append((left, used, ways, _children(left, ways, enough, width)))

    share = max(nodes // len(WIDTHS), 3 * int((counts > 0).sum()) // 2)  # nodes down to a first solution
    for i, width in enumerate(WIDTHS, 1):
        stack.clear()
        most = min(nodes, share * i) if width else nodes
        if best > bound:
            open_node(counts, 0, width)
        while stack and best > bound and opened < most:
            left, used, ways, children = stack[-1]
            child = next(children, False)
            if child is False:
                stack.pop()
                continue
            opened += 1
            if child is None:
                continue
            after = _apply(left, *child)
            # the room wasted so far may cost a sequence already
            if used + child[1] - (-int((after * sizes[: len(after)]).sum()) // capacity) >= best:
                continue
            path[len(stack) - 1 :] = [child]
            if after.any():
                open_node(after, used + child[1], width)
            else:
                incumbent = Plan(list(path))
                best = incumbent.sequences
    return incumbent


# --- placing the pieces ------------------------------------------------------------------------


def _lookup(plan: Plan, capacity: int) -> dict[str, np.ndarray]:
    """For each length and first rank: where the pieces from that rank on lie."""
    rows, rank, sequence = [], np.zeros(capacity + 1, dtype=np.int64), 0
    for filling, times in plan.steps:
        offset = 0
        for n, k in filling:
            rows.append((n, rank[n], sequence, k, offset))
            rank[n] += times * k
            offset += n * k
        sequence += times
    columns = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5).T
    return dict(zip(("length", "rank", "sequence", "each", "offset"), columns))


def _ranked(pieces: DataFrame, slices: int) -> DataFrame:
    """``rank``: 0, 1, ... among the pieces of a length, without gathering a length in one task."""
    sliced = pieces.withColumn("slice", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(slices)))
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy("length", "slice")
        .agg(F.count("*").alias("n"))
        .select("length", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    )
    within = Window.partitionBy("length", "slice").orderBy("doc_id", "piece", "ids_crc32")
    return (
        sliced.withColumn("own", F.row_number().over(within) - 1)
        .join(offsets, ["length", "slice"])
        .withColumn("rank", F.col("earlier") + F.col("own"))
        .drop("slice", "earlier", "own")
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """``pieces`` with sequence_id and offset. ``pieces`` is read twice: pass a stored table."""
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in pieces.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[length] = n
    at = _lookup(search(counts, capacity, nodes), capacity)
    shift = int(at["rank"].max(initial=0)) + int(counts.max()) + 1
    keys = at["length"] * shift + at["rank"]

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            rank, length = rows.pop("rank").to_numpy(), rows["length"].to_numpy()
            i = np.searchsorted(keys, length * shift + rank, "right") - 1
            turn, copy = np.divmod(rank - at["rank"][i], at["each"][i])
            rows["sequence_id"] = at["sequence"][i] + turn
            rows["offset"] = at["offset"][i] + copy * length
            yield rows.astype({"doc_id": "Int64"})

    spark = pieces.sparkSession
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, rank long"
    ranked = _ranked(pieces, partitions(spark)).selectExpr(
        *[f"cast({c.split()[0]} as {c.split()[1]}) as {c.split()[0]}" for c in schema.split(", ")]
    )
    result = schema.replace("rank long", "sequence_id long, offset long")
    return ranked.mapInPandas(placed, result)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    file = public_tokenizers.path("word_bpe_49k.json")
    return pack(stored(token_pieces(table(spark, sf_dir, "documents"), file, joined=False)))
