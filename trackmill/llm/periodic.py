"""Periodic runs of words: stretches that repeat themselves at least four times over.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are equal), at
least ``max(6, 4 * q)`` words long, that no neighbouring word extends with period ``q``.

Method: an online sparse diagonal DP. Words are taken in order. Each earlier occurrence of a word,
``lag`` words back, adds one to the match length of that lag's diagonal; a diagonal without such an
occurrence ends, and one that ends with sufficient length is a run. Only occurrences exist, so
only active lags cost anything. Three things keep it small and lose nothing:

* No diagonal shorter than five matches can be a run, so an occurrence counts only where the four
  words behind agree too (words are compared as five-word keys, and lengths begin at five).
* Words are taken in slices with a bounded number of occurrences. What lives from one slice to the
  next is the match length of each active lag.
* Inside a run already known, with period ``q``, diagonals at multiples of ``q`` that lie within it are
  the run itself over again, and are not followed.

A run is also found at multiples of its period; the smallest period with equal ends is the run's own.

Defined results: words are ``[^\\x20\\x09-\\x0D]+`` of the whole text, by their exact bytes (the keys
of five words are 64-bit hashes); a text that is null or has no words has no runs and an empty
collapsed text; every row gives one row, also repeated ones and those with a null doc_id; an empty
table gives none; other columns are ignored. One document is in memory at a time, with a few
numbers a word.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from trackmill.llm.common import CRC_SQL, slices, table, utf8
from trackmill.llm.shingles import mix

LEAST_WORDS = 6
LEAST_REPEATS = 4
_KEY = 5  # matches that every run's diagonal has: max(6 - q, 3 * q) for the smallest q
OCCURRENCES = 1_000_000
_AHEAD = 1 << 16
RUNS_DDL = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
Prepare = Callable[[int | None, list[bytes]], list[bytes]]


def _needed(lag: np.ndarray) -> np.ndarray:
    """Matches that a diagonal needs."""
    return np.maximum(LEAST_WORDS - lag, (LEAST_REPEATS - 1) * lag)


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of keys that occur more than once, ordered by key and place, and their keys' numbers."""
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    place = np.flatnonzero(twice[at] == keys)
    group = at[place]
    order = np.argsort(group, kind="stable")
    return place[order], group[order]


class Diagonals:
    """The DP over the words of a batch of documents, laid end to end."""

    def __init__(self, words: np.ndarray, first: np.ndarray, count: np.ndarray, most: int = OCCURRENCES):
        self.words, self.first, self.count, self.most = words, first, count, most
        self.found: list[np.ndarray] = []

    def runs(self) -> np.ndarray:
        """(start, end, period) of all runs, by start, then period, in places of the batch."""
        doc = np.repeat(np.arange(len(self.count)), self.count)
        n = len(self.words) - _KEY + 1
        if n < 1:
            return np.zeros((0, 3), np.int64)
        whole = np.flatnonzero(doc[:n] == doc[_KEY - 1 :])
        keys = mix(doc[whole].astype(np.uint64) + np.uint64(1))
        for i in range(_KEY):
            keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + self.words[whole + i].astype(np.uint64))
        place, group = _repeated(keys)
        if not len(place):
            return np.zeros((0, 3), np.int64)
        place = whole[place]
        # a lag beyond a quarter of the document cannot be a run's period
        self._follow(place, group, self.first[doc[place]], self.count[doc[place]] // LEAST_REPEATS, doc)
        runs = np.concatenate(self.found) if self.found else np.zeros((0, 3), np.int64)
        runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
        own = np.ones(len(runs), dtype=bool)
        own[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
        runs = runs[own]
        return runs[np.lexsort((runs[:, 2], runs[:, 0]))]

    def _follow(self, place, group, first, longest, doc) -> None:
        span = len(self.words) + 1
        self.code = group * span + place  # ascending: a key's places follow each other
        low = np.searchsorted(self.code, group * span + np.maximum(place - longest, first))
        order = np.argsort(place, kind="stable")
        self.place, self.group = place[order], group[order]
        # occurrences of each place's key to look at: two stretches of ``code``
        self.low, self.high = low[order], order.copy()
        self.low_near, self.high_near = np.zeros_like(order), np.zeros_like(order)
        self.period, self.start = np.zeros_like(order), np.zeros_like(order)  # of a run known to go on
        lags, lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = 0
        while at < len(order):
            part = slice(at, at + _AHEAD)
            far, near = self.high[part] - self.low[part], self.high_near[part] - self.low_near[part]
            to = at + max(1, int(np.searchsorted(np.cumsum(far + near), self.most, "right")))
            part = slice(at, min(to, at + _AHEAD, len(order)))
            at = part.stop
            far, near = far[: part.stop - part.start], near[: part.stop - part.start]
            begins, many = np.append(self.low[part], self.low_near[part]), np.append(far, near)
            row = np.repeat(np.tile(np.arange(part.start, part.stop), 2), many)
            stops = np.cumsum(many)
            i, j = self.place[row], place[np.repeat(begins - (stops - many), many) + np.arange(len(row))]
            lag, q = i - j, self.period[row]
            if q.any():
                again = (q > 0) & (j >= self.start[row])
                again[again] = lag[again] % q[again] == 0
                i, lag = i[~again], lag[~again]
            border = int(self.place[at]) if at < len(order) else span
            lags, lengths = self._extend(i, lag, lags, lengths, int(self.place[part.start]), border)
            if len(lags):
                lags, lengths = self._know(lags, lengths, border, doc)

    def _extend(self, i, lag, lags, lengths, begin, border):
        """Match lengths after the occurrences of one slice; what ends sufficiently long is noted.

        ``lags`` are the active ones, which matched at the place before ``begin``.
        """
        order = np.lexsort((i, lag))
        i, lag = i[order], lag[order]
        new = np.ones(len(i), dtype=bool)
        new[1:] = (lag[1:] != lag[:-1]) | (i[1:] != i[:-1] + 1)
        head = np.flatnonzero(new)
        length = np.diff(np.append(head, len(i)))
        head_i, head_lag = i[head], lag[head]
        goes_on = np.flatnonzero(head_i == begin)
        alive = np.zeros(len(lags), dtype=bool)
        if len(lags) and len(goes_on):
            where = np.minimum(np.searchsorted(lags, head_lag[goes_on]), len(lags) - 1)
            same = lags[where] == head_lag[goes_on]
            alive[where[same]] = True
            length[goes_on[same]] += lengths[where[same]]
        self._note(np.full((~alive).sum(), begin - 1), lags[~alive], lengths[~alive])
        last = head_i + np.diff(np.append(head, len(i))) - 1
        open_still = last == border - 1
        self._note(last[~open_still], head_lag[~open_still], length[~open_still])
        return head_lag[open_still], length[open_still]  # by lag, as sorted above

    def _note(self, last: np.ndarray, lag: np.ndarray, keys: np.ndarray) -> None:
        """Diagonals of ``keys`` five-word matches that end at ``last``, if they suffice."""
        matches = keys + _KEY - 1
        enough = np.flatnonzero(matches >= _needed(lag))
        if len(enough):
            end = last[enough] + _KEY
            start = end - matches[enough] - lag[enough]
            self.found.append(np.stack([start, end, lag[enough]], axis=1))

    def _know(self, lags, lengths, border, doc):
        """Note the runs that are certain at a border, up to their end, and follow them no longer.

        Between a run's first and last period only few other diagonals can matter: those of smaller
        lags, and those of a longer run that shares less than both periods with this one, so that
        it holds a word of this run's first or last period.
        """
        kept = np.ones(len(lags), dtype=bool)
        for x in np.flatnonzero(lengths + _KEY - 1 >= _needed(lags)):
            if not kept[x]:
                continue
            q = int(lags[x])
            start = border - int(lengths[x]) - q
            end = self._end(border - 1 + _KEY, q, int(self.first[doc[border - 1]] + self.count[doc[border - 1]]))
            inside = np.arange(*np.searchsorted(self.place, [border, end]))
            if self.period[inside].any():  # reaches into another known run: followed to its end instead
                continue
            self.found.append(np.array([[start, end, q]]))
            kept &= (lags < q) | (lags % q != 0) | (border - 1 - lags < start)
            self.period[inside], self.start[inside] = q, start
            middle = inside[self.place[inside] < end - q - _KEY]
            base = self.group[middle] * (len(self.words) + 1)
            near = np.searchsorted(self.code, base + np.maximum(self.place[middle] - q + 1, start + q))
            self.low_near[middle] = np.maximum(near, self.low[middle])
            self.high_near[middle] = np.maximum(self.high[middle], self.low_near[middle])
            self.high[middle] = np.maximum(np.searchsorted(self.code, base + start + q), self.low[middle])
        return lags[kept], lengths[kept]

    def _end(self, at: int, q: int, last: int) -> int:
        """Where the words from ``at`` on cease to equal those ``q`` before, at ``last`` the latest."""
        while at < last:
            stop = min(at + _AHEAD, last)
            differs = np.flatnonzero(self.words[at:stop] != self.words[at - q : stop - q])
            if len(differs):
                return at + int(differs[0])
            at = stop
        return last


def _found(batches: Iterator[pa.RecordBatch], schema: pa.Schema, prepare: Prepare | None) -> Iterator[pa.RecordBatch]:
    for rows in slices(batches):
        ids = rows["doc_id"].to_pylist()
        texts = [t.split() for t in utf8(rows["text"])]
        if prepare is not None:
            texts = [prepare(d, t) for d, t in zip(ids, texts)]
        number: dict[bytes, int] = {}
        count = np.array([len(t) for t in texts], dtype=np.int64)
        words = np.fromiter((number.setdefault(w, len(number)) for t in texts for w in t), np.int64, count.sum())
        ends = np.cumsum(count)
        first = ends - count
        runs = Diagonals(words, first, count).runs()
        # words after the first period of a run go
        gone = np.zeros(len(words) + 1, np.int64)
        np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
        np.add.at(gone, runs[:, 1], -1)
        gone = np.cumsum(gone)[:-1] > 0
        owner = np.searchsorted(ends, runs[:, 0], "right")
        collapsed = [b" ".join(t) for t in texts]
        for d in np.unique(owner):
            stays = ~gone[first[d] : ends[d]]
            collapsed[d] = b" ".join([w for w, s in zip(texts[d], stays) if s])
        parts = [runs[:, 0] - first[owner], runs[:, 1] - runs[:, 0], runs[:, 2]]
        each = pa.StructArray.from_arrays([pa.array(p) for p in parts], names=["start", "length", "period"])
        offsets = np.append(0, np.cumsum(np.bincount(owner, minlength=len(texts)))).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                rows["doc_id"].cast(pa.int64()),
                pa.array(count),
                pa.ListArray.from_arrays(pa.array(offsets), each).cast(schema.field("runs").type),
                pa.array(collapsed, pa.binary()).cast(pa.string()),
            ],
            schema=schema,
        )


def find_runs(docs: DataFrame, prepare: Prepare | None = None) -> DataFrame:
    """Per document its number of words, its runs by start and period, and the text without repeats.

    ``collapsed`` keeps each run's first period and the words outside runs, joined by one space.
    ``prepare`` may change the words of a document before they are looked at. Documents need nothing
    of each other, so there is no shuffle.
    """
    types = {"start": pa.int64(), "length": pa.int64(), "period": pa.int64()}
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_words", pa.int64()),
        ("runs", pa.list_(pa.struct(list(types.items())))), ("collapsed", pa.string()),
    ])
    return docs.select("doc_id", "text").mapInArrow(lambda b: _found(b, schema, prepare), RUNS_DDL)


def made_periodic(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of the query's test: in every tenth document a repeated stretch takes the end."""
    if doc_id is None or not words:
        return words
    tens, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if rest:
        return words
    a = tens % len(words)
    size = len(words) - a
    p = 1 + size // (3 + tens % 8)
    return words[:a] + (words[a : a + p] * (size // p + 1))[:size]


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(table(spark, sf_dir, "documents"), made_periodic)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.withColumn("best", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.col2")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.col3")).alias("period"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
    milli = F.floor(F.lit(1000) * F.col("length") / F.col("period")).cast("long")
    return best.withColumn("exponent_milli", milli)


OP11_SQL = f"""
with {CRC_SQL}, split as (
    select d.doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w, h
    from documents d left join crc on d.doc_id = crc.doc_id
), sized as (
    select doc_id, w, len(w) as n, h % 10 = 0 and len(w) > 0 as made, (h // 10) % nullif(len(w), 0) as a, 3 + (h // 10) % 8 as k
    from split
), texts as (
    select doc_id, n, case when made
        then list_transform(range(n), lambda i: w[1 + case when i < a then i else a + (i - a) % (1 + (n - a) // k) end])
        else w end as w
    from sized
), words as (
    select doc_id, n, unnest(w) as word, unnest(range(n)) as i from texts
), diagonal as (
    select x.doc_id, x.i - y.i as q, x.i, x.i - row_number() over (partition by x.doc_id, x.i - y.i order by x.i) as island
    from words x join words y on x.doc_id = y.doc_id and x.word = y.word and x.i > y.i and x.i - y.i <= x.n // 4
), run as (
    select doc_id, start, length, min(q) as period from (
        select doc_id, q, min(i) - q as start, count(*) + q as length from diagonal group by doc_id, q, island
        having count(*) + q >= greatest(6, 4 * q)
    ) group by doc_id, start, length
), listed as (
    select doc_id, count(*) as n_runs,
           string_agg(concat(start, ',', length, ',', period, chr(10)), '' order by start, period) as lines,
           arg_min({{'s': start, 'l': length, 'p': period}}, {{'l': -length, 's': start, 'p': period}}) as best
    from run group by doc_id
), kept as (
    select doc_id, string_agg(word, ' ' order by i) as text from words w
    where not exists (select 1 from run r where r.doc_id = w.doc_id and w.i >= r.start + r.period and w.i < r.start + r.length)
    group by doc_id
)
select t.doc_id, coalesce(n_runs, 0) as n_runs, best.s as start, best.l as length, best.p as period,
       cast(floor(1000 * best.l / best.p) as bigint) as exponent_milli,
       sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(kept.text, '')) as collapsed_sha256
from texts t left join listed on t.doc_id = listed.doc_id left join kept on t.doc_id = kept.doc_id
"""
