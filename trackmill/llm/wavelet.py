"""Token ids in shards of wavelet matrices.

A wavelet matrix stores a sequence of ids as one bit-plane for each binary digit, from the
highest down; after each plane the ids with a 0 there go before those with a 1, in order. With
a directory of ones for every block of a plane, one id is read, counted or looked up in a few steps for
each digit, on the compressed form. A shard is one Parquet file (zstd) with a single row: the
planes, the directory, and the documents in ascending doc_id order.

Defined results: a null or empty text holds the end id alone; rows that repeat a doc_id follow
each other, ordered by text; a null doc_id comes first; an empty table gives no shards;
other columns of the input are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from trackmill.llm.common import partitions, shared_folder, table, utf8
from trackmill.llm.tokens import encoder

END = 0  # the id after every document
BLOCK = 512  # bits to an entry of the directory


@dataclass
class WaveletMatrix:
    """A sequence of unsigned ids: planes of bits, zeros in each, ones before each block."""

    n: int
    planes: list[np.ndarray]  # packed bits, lowest bit first
    zeros: list[int]
    ones: list[np.ndarray]

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        digits = max(1, int(ids.max(initial=0)).bit_length())
        row = ids.astype(np.uint16 if digits <= 16 else np.uint32)
        planes, zeros, ones = [], [], []
        for digit in range(digits - 1, -1, -1):
            bit = ((row >> digit) & 1).astype(bool)
            plane = np.packbits(bit, bitorder="little")
            planes.append(plane)
            ones.append(cls._directory(plane))
            # places are faster to take than a mask of random bits
            low = row.take(np.flatnonzero(~bit))
            zeros.append(len(low))
            row = np.concatenate([low, row.take(np.flatnonzero(bit))])
        return cls(len(ids), planes, zeros, ones)

    @staticmethod
    def _directory(plane: np.ndarray) -> np.ndarray:
        counts = np.bitwise_count(plane).astype(np.uint32)
        blocks = np.add.reduceat(counts, np.arange(0, len(plane), BLOCK // 8)) if len(plane) else []
        return np.concatenate([[0], np.cumsum(blocks)]).astype(np.uint32)

    def _rank1(self, level: int, i: int) -> int:
        """Ones before place ``i`` of a plane."""
        block = i // BLOCK
        part = self.planes[level][block * BLOCK // 8 : -(-i // 8)]
        count = int(self.ones[level][block])
        if len(part):
            part = part.copy()
            if i % 8:
                part[-1] &= (1 << i % 8) - 1
            count += int(np.bitwise_count(part).sum())
        return count

    def _select(self, level: int, one: bool, k: int) -> int:
        """Place of the ``k``-th (from 0) one or zero of a plane."""
        ones = self.ones[level].astype(np.int64)
        before = ones if one else np.minimum(np.arange(len(ones)) * BLOCK, self.n) - ones
        block = int(np.searchsorted(before, k, "right")) - 1
        part = self.planes[level][block * BLOCK // 8 : (block + 1) * BLOCK // 8]
        bits = np.unpackbits(part, bitorder="little")
        places = np.flatnonzero(bits == one)
        return block * BLOCK + int(places[k - int(before[block])])

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i // 8]) >> (i % 8) & 1

    def access(self, i: int) -> int:
        """The id at place ``i``."""
        value = 0
        for level, zeros in enumerate(self.zeros):
            bit = self._bit(level, i)
            ones = self._rank1(level, i)
            i = zeros + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, value: int, end: int) -> tuple[int, int]:
        """Where the ``value``s among the first ``end`` ids lie below the last plane."""
        digits = len(self.zeros)
        if value < 0 or value >> digits:
            return 0, 0
        first = 0
        for level, zeros in enumerate(self.zeros):
            a, b = self._rank1(level, first), self._rank1(level, end)
            one = value >> (digits - 1 - level) & 1
            first, end = (zeros + a, zeros + b) if one else (first - a, end - b)
        return first, end

    def rank(self, value: int, end: int) -> int:
        """How often ``value`` occurs in the first ``end`` ids."""
        first, last = self._range(value, end)
        return last - first

    def count(self, value: int) -> int:
        return self.rank(value, self.n)

    def select(self, value: int, k: int) -> int:
        """Place of the ``k``-th (from 0) occurrence of ``value``."""
        first, last = self._range(value, self.n)
        if not 0 <= k < last - first:
            raise IndexError(k)
        i, digits = first + k, len(self.zeros)
        for level in range(digits - 1, -1, -1):
            one = bool(value >> (digits - 1 - level) & 1)
            i = self._select(level, one, i - self.zeros[level] if one else i)
        return i

    def ids(self) -> np.ndarray:
        """All ids in order: the planes undone from the last to the first."""
        row = np.zeros(self.n, dtype=np.uint16 if len(self.zeros) <= 16 else np.uint32)
        for level in range(len(self.zeros) - 1, -1, -1):
            bit = np.unpackbits(self.planes[level], count=self.n, bitorder="little").astype(bool)
            zeros = self.zeros[level]
            up = np.empty_like(row)
            up[~bit] = row[:zeros]
            up[bit] = row[zeros:] | row.dtype.type(1 << (len(self.zeros) - 1 - level))
            row = up
        return row.astype(np.uint32)

    def columns(self) -> dict:
        return {
            "planes": [p.tobytes() for p in self.planes],
            "zeros": self.zeros,
            "ones": [o.tobytes() for o in self.ones],
        }

    @classmethod
    def of(cls, row: dict) -> WaveletMatrix:
        """From a row of a shard file."""
        return cls(
            row["n_tokens"],
            [np.frombuffer(p, np.uint8) for p in row["planes"]],
            list(row["zeros"]),
            [np.frombuffer(o, np.uint32) for o in row["ones"]],
        )


SHARD = pa.schema(
    [
        ("first_id", pa.int64()),
        ("n_docs", pa.int64()),
        ("n_tokens", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("planes", pa.list_(pa.binary())),
        ("zeros", pa.list_(pa.int64())),
        ("ones", pa.list_(pa.binary())),
    ]
)
SHARD_SQL = (
    "first_id long, n_docs long, n_tokens long, doc_ids array<long>, lengths array<long>, "
    "planes array<binary>, zeros array<long>, ones array<binary>"
)


def write_shards(docs: DataFrame, folder: str, file: str, joined: bool) -> None:
    """Encode all texts and write one file for each range of doc_ids."""

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_ids, lengths, parts = [], [], []
        for rows in batches:
            doc_ids += rows["doc_id"].to_pylist()
            ids, counts = encoder(file, joined).documents(list(utf8(rows["text"])), END)
            lengths += counts.tolist()
            # half the memory while a shard is gathered
            parts.append(ids.astype(np.uint16) if ids.max(initial=0) < 1 << 16 else ids)
        if doc_ids:
            matrix = WaveletMatrix.build(np.concatenate(parts))
            row = {
                "first_id": next((i for i in doc_ids if i is not None), None),
                "n_docs": len(doc_ids),
                "n_tokens": matrix.n,
                "doc_ids": doc_ids,
                "lengths": lengths,
                **matrix.columns(),
            }
            yield pa.RecordBatch.from_pylist([row], schema=SHARD)

    (
        docs.select("doc_id", "text")
        .repartitionByRange(partitions(docs.sparkSession), "doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(built, SHARD_SQL)
        .write.option("compression", "zstd")
        .parquet(folder)
    )


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, ids of every document, from the shard files alone."""
    shards = spark.read.parquet(folder)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for row in rows.to_pylist():
                ids = WaveletMatrix.of(row).ids()
                ends = np.cumsum(row["lengths"])
                for at in range(0, len(ends), 1000):
                    lengths = row["lengths"][at : at + 1000]
                    bounds = list(zip(ends[at : at + 1000] - lengths, ends[at : at + 1000]))
                    parts = [ids[a:b].tobytes() for a, b in bounds]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "first_id": pa.array([row["first_id"]] * len(parts), pa.int64()),
                            "doc_id": pa.array(row["doc_ids"][at : at + 1000], pa.int64()),
                            "within": pa.array([int(a) for a, _ in bounds], pa.int64()),
                            "n_tokens": pa.array(lengths, pa.int64()),
                            "ids_crc32": pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                            "ids": pa.array(parts, pa.binary()),
                        }
                    )

    schema = "first_id long, doc_id long, within long, n_tokens long, ids_crc32 long, ids binary"
    # one short row for each shard, so one task adds them up
    order = Window.orderBy(F.col("first_id").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select(
        "first_id", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)).alias("before")
    )
    return (
        shards.mapInArrow(decoded, schema)
        .join(starts.withColumnRenamed("first_id", "shard_id"), F.expr("first_id <=> shard_id"))
        .select("doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32", "ids")
    )


def count_token(spark: SparkSession, folder: str, token: int) -> DataFrame:
    """first_id, n: how often each shard holds ``token``, counted on the compressed planes."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = [(r["first_id"], WaveletMatrix.of(r).count(token)) for r in rows.to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "first_id": pa.array([f for f, _ in found], pa.int64()),
                    "n": pa.array([n for _, n in found], pa.int64()),
                }
            )

    return spark.read.parquet(folder).mapInArrow(counted, "first_id long, n long")


def occurrences(spark: SparkSession, folder: str, token: int) -> DataFrame:
    """doc_id, position: every place of ``token``, found by select on the planes."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for row in rows.to_pylist():
                matrix = WaveletMatrix.of(row)
                places = np.array([matrix.select(token, k) for k in range(matrix.count(token))], int)
                ends = np.cumsum(row["lengths"])
                doc = np.searchsorted(ends, places, "right")
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array([row["doc_ids"][d] for d in doc], pa.int64()),
                        "position": pa.array(
                            [int(p - ends[d] + row["lengths"][d]) for p, d in zip(places, doc)], pa.int64()
                        ),
                    }
                )

    return spark.read.parquet(folder).mapInArrow(found, "doc_id long, position long")


def op2_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = f"{shared_folder(spark)}/wavelet-{uuid.uuid4().hex}"
    file = public_tokenizers.path("byte_bpe_50k.json")
    write_shards(table(spark, sf_dir, "documents"), folder, file, joined=True)
    return read_documents(spark, folder).drop("ids")
