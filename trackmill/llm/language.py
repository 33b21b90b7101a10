"""Language identification with bit-sliced Bloom filters of n-grams.

Texts become lower-case words of letters between single spaces. Their n-grams are runs of 3 to 5
UTF-8 bytes of that, known exactly: the bytes and their number make one 64-bit number.

Learning: each language's n-grams are counted over all its texts. An n-gram belongs to a language
if it makes up at least ``RATE`` of the language's n-grams and at least ``SHARE`` of its largest rate
in any language. The languages that an n-gram belongs to are the bits of a mask. One table of
``SLOTS`` masks is a Bloom filter for every language at once, bit-sliced: an n-gram's mask is or-ed
into ``HASHES`` slots, and the masks found in them, and-ed, name all languages that contain it.

Prediction: each language's bits over all n-grams of the text are counted, and corrected for false
positives: of ``n`` n-grams ``f * n`` are expected to hit a filter of false positive rate ``f`` by chance,
so ``(count - f * n) / (1 - f)`` are taken to be real. The largest decides, ties by name; the score is
its share of all languages' corrected counts.

Bounds: a language has at most ``1 / RATE`` n-grams in its filter, whatever the size of the corpus, so
``f`` is at most ``(HASHES / RATE / SLOTS) ** HASHES``, 0.3 %, and the table that goes to every task has
``8 * SLOTS`` bytes for every 64 languages (16 MB); more than ``MOST_LANGUAGES`` are refused. Tasks count
n-grams before they are shuffled, so one language or n-gram with most rows moves once per task.

Defined results: a text that is null or has no letter is ``und`` with score 0; one with letters and
no n-gram of any language is the language with the most n-grams, with score 0; with nothing to
learn from everything is ``und``; every row gives one row, also repeated ones and those with a null
doc_id (which teach nothing in the query); an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from trackmill.llm.common import slices, stored, table
from trackmill.llm.shingles import mix

SIZES = (3, 4, 5)
RATE = 1e-5
SHARE = 0.1
SLOT_BITS = 21
SLOTS = 1 << SLOT_BITS
HASHES = 3
MOST_LANGUAGES = 256
#: N-grams that a task counts before it sends them on.
HELD = 2_000_000
NONE = "und"
#: Bytes of text that are looked at together: their n-grams stay in the processor's cache.
AT_ONCE = 1 << 17
#: The bits of every byte.
BITS = np.arange(256)[:, None] >> np.arange(8) & 1


def letters(texts: pa.Array | pa.ChunkedArray) -> pa.Array:
    """Lower-case words of letters, each between single spaces; a null is empty."""
    low = pc.utf8_lower(pc.fill_null(texts, ""))
    return pc.replace_substring_regex(pc.binary_join_element_wise("", low, "", " "), r"[^\p{L}]+", " ")


def ngrams_by_size(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each size, the n-grams of ``letters(...)`` end to end, and how many each text has."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    text = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    lengths = np.diff(offsets)
    left = np.repeat(offsets[1:] - offsets[0], lengths) - np.arange(len(text))  # bytes to the text's end
    value = text.astype(np.uint64)
    grown = value.copy()
    for size in range(2, max(SIZES) + 1):
        grown = (grown[: max(len(text) - size + 1, 0)] << np.uint64(8)) | value[size - 1 :]
        if size in SIZES:
            whole = left[: len(grown)] >= size
            yield grown[whole] | np.uint64(size << 56), np.maximum(lengths - size + 1, 0)


def ngrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of ``letters(...)`` end to end, and how many each text has."""
    grams, many = zip(*ngrams_by_size(texts))
    owners = np.concatenate([np.repeat(np.arange(len(m)), m) for m in many])
    return np.concatenate(grams)[np.argsort(owners, kind="stable")], np.sum(many, axis=0)


def _slots(grams: np.ndarray) -> list[np.ndarray]:
    spread = mix(grams)
    return [((spread >> np.uint64(SLOT_BITS * i)) & np.uint64(SLOTS - 1)).view(np.int64) for i in range(HASHES)]


class _Counts:
    """How often each n-gram was met in each language, up to a bounded number of them."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, number: int, grams: np.ndarray) -> None:
        gram, count = np.unique(grams, return_counts=True)
        self.parts.append((np.full(len(gram), number), gram, count))
        self.held += len(gram)
        if self.held > HELD:
            self.parts = [self.merged()]
            self.held = len(self.parts[0][0])

    def merged(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        language, gram, count = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((gram, language))
        language, gram, count = language[order], gram[order], count[order]
        first = np.flatnonzero(np.append(True, (gram[1:] != gram[:-1]) | (language[1:] != language[:-1])))
        return language[first], gram[first], np.add.reduceat(count, first)


def _counted(batches: Iterator[pa.RecordBatch], number: dict[str, int]) -> Iterator[pa.RecordBatch]:
    counts = _Counts()

    def emit() -> pa.RecordBatch:
        language, gram, count = counts.merged()
        arrays = [pa.array(language.astype(np.int32)), pa.array(gram.view(np.int64)), pa.array(count.astype(np.int64))]
        return pa.RecordBatch.from_arrays(arrays, names=["language", "gram", "n"])

    for rows in slices(batches):
        texts, language = letters(rows["text"]), np.array([number[x] for x in rows["lang"].to_pylist()])
        for one in np.unique(language):
            for grams, _ in ngrams_by_size(texts.filter(pa.array(language == one))):
                if len(grams):
                    counts.add(int(one), grams)
        if counts.held > HELD:  # still, after merging: different n-grams
            yield emit()
            counts = _Counts()
    if counts.parts:
        yield emit()


@dataclass
class Filters:
    """What was learned: names, one table of masks for every 64 languages, and false positive rates."""

    names: list[str]
    tables: list[np.ndarray]
    wrong: np.ndarray
    usual: int

    @cached_property
    def narrow(self) -> list[np.ndarray]:
        """The tables cut to bytes: one for every 8 languages, small enough to stay near the processor."""
        shifts = [divmod(low, 64) for low in range(0, len(self.names), 8)]
        return [(self.tables[t] >> np.uint64(bit)).astype(np.uint8) for t, bit in shifts]

    def counts(self, grams: np.ndarray, many: np.ndarray) -> np.ndarray:
        """How many of each text's n-grams each language's filter holds."""
        found = np.zeros((len(many), 8 * len(self.narrow)), dtype=np.int64)
        slots = _slots(grams)
        filled = np.flatnonzero(many)
        at = np.repeat(np.arange(len(filled)) * 256, many[filled])
        for t, masks in enumerate(self.narrow):
            hit = masks[slots[0]]
            for slot in slots[1:]:
                hit &= masks[slot]
            alike = np.bincount(at + hit, minlength=256 * len(filled)).reshape(-1, 256)
            found[filled, 8 * t : 8 * t + 8] = alike @ BITS
        return found[:, : len(self.names)]

    def decide(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        kept = letters(texts)
        if not self.names:
            return [NONE] * len(kept), np.zeros(len(kept))
        many, counts = np.zeros(len(kept), dtype=np.int64), np.zeros((len(kept), len(self.names)), dtype=np.int64)
        for grams, own in ngrams_by_size(kept):
            many += own
            counts += self.counts(grams, own)
        real = np.maximum((counts - self.wrong * many[:, None]) / (1 - self.wrong), 0)
        best = real.argmax(axis=1)
        total = real.sum(axis=1)
        score = np.divide(real.max(axis=1), total, out=np.zeros(len(many)), where=total > 0)
        best[total == 0] = self.usual
        spoken = pc.not_equal(pc.utf8_trim(kept, " "), "").to_pylist()
        return [self.names[b] if s else NONE for b, s in zip(best, spoken)], np.where(spoken, score, 0.0)


def learn(docs: DataFrame) -> Filters:
    """Filters of the languages of ``docs`` (text, lang); rows without a text or language teach nothing."""
    rows = docs.select("text", "lang").filter("text is not null and lang is not null")
    names = sorted(r[0] for r in rows.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    number = {name: i for i, name in enumerate(names)}
    parts = rows.mapInArrow(lambda b: _counted(b, number), "language int, gram long, n long")
    counts = stored(parts.groupBy("gram", "language").agg(F.sum("n").alias("n")))
    totals = {r["language"]: r["total"] for r in counts.groupBy("language").agg(F.sum("n").alias("total")).collect()}
    if not totals:
        return Filters([], [], np.zeros(0), 0)
    sizes = docs.sparkSession.createDataFrame(sorted(totals.items()), "language int, total long")
    rated = counts.join(F.broadcast(sizes), "language")  # MOST_LANGUAGES rows at most
    rated = rated.select("gram", "language", (F.col("n") / F.col("total")).alias("rate")).filter(F.col("rate") >= RATE)
    largest = rated.groupBy("gram").agg(F.max("rate").alias("largest"))
    members = rated.join(largest, "gram").filter(F.col("rate") >= SHARE * F.col("largest"))
    # at most 1 / RATE n-grams a language
    found = members.select("gram", "language").toArrow()
    gram = found["gram"].to_numpy().view(np.uint64)
    language = found["language"].to_numpy().astype(np.int64)
    tables = [np.zeros(SLOTS, dtype=np.uint64) for _ in range(-(-len(names) // 64))]
    wrong = np.zeros(len(names))
    for i in range(len(names)):
        masks, bit = tables[i // 64], np.uint64(1 << (i % 64))
        for slot in _slots(gram[language == i]):
            masks[slot] |= bit
        wrong[i] = np.mean((masks & bit) != 0) ** HASHES
    return Filters(names, tables, wrong, max(totals, key=lambda x: (totals[x], -x)))


def predict(docs: DataFrame, filters: Filters) -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""
    known = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, AT_ONCE):
            names, score = known.value.decide(rows["text"])
            arrays = [rows["doc_id"].cast(pa.int64()), pa.array(names, pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    filters = learn(docs.filter(~held_out))
    return predict(docs, filters).withColumn("held_out", F.coalesce(held_out, F.lit(False)))
