"""Stored tables: parquet folders by blocks of session keys or seasons, switched by a pointer.

One folder per session would mean as many folders as sessions, so a fixed number of consecutive
sessions share a block. A write puts the blocks it changes into a new version folder and touches no
file that is there already. Which version of each block readers see is said by the newest of the
table's numbered pointer files, written last and as a whole: a write that is killed, wherever it
stops, leaves every block as it was. Lost executors cost recomputed tasks.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Collection, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from trackmill.fixed_values import DIMENSION_KEYS
from trackmill.operators.merging import reject_null_keys, replace_by_key, upsert
from trackmill.schemas import columns, nothing, raw_schema
from trackmill.sources.files import children, read_text, remove, write_once

SESSIONS_PER_BLOCK = 1000
BLOCK = "session_block"
SEASON_BLOCK = "season_block"
#: Block -> the version folder that holds it.
Versions = dict[int, str]


def work_folder(spark: SparkSession, fallback: str) -> str:
    """Shared folder for intermediate tables: the cluster's checkpoint folder where it names one.

    ``fallback`` lies under the warehouse. Drivers and executors share both by contract, and a shared
    mount has a plain path, so no scheme is refused.
    """
    return spark.conf.get("spark.checkpoint.dir", None) or fallback


def written(df: DataFrame, folder: str) -> DataFrame:
    """``df`` stored once and read back, so later uses neither recompute nor re-read its sources."""
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Work:
    """Intermediate tables of one run, in a folder of its own that goes when the run is over."""

    PREFIX = "tables-of-run-"

    def __init__(self, spark: SparkSession, warehouse: str):
        self.spark = spark
        self.folder = f"{work_folder(spark, f'{warehouse}/work')}/{self.PREFIX}{uuid.uuid4().hex}"

    def written(self, df: DataFrame) -> DataFrame:
        return written(df, self.folder)

    def __enter__(self) -> Work:
        return self

    def __exit__(self, *_) -> None:
        remove(self.spark, self.folder)


def block_of_session() -> Column:
    return F.floor(F.col("session_key") / SESSIONS_PER_BLOCK).cast("int")


class Pointer:
    """Numbered files of which the newest counts. Numbers, not file times, say which is newest."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def numbers(self) -> list[int]:
        names = [n.removesuffix(".json") for n in children(self.spark, self.folder) if n.endswith(".json")]
        return sorted(int(n) for n in names if n.isdigit())

    def at(self, number: int) -> dict:
        return json.loads(read_text(self.spark, self._file(number)))

    def read(self) -> tuple[int, dict]:
        """The newest number and what it says; 0 and nothing before the first."""
        numbers = self.numbers()
        return (numbers[-1], self.at(numbers[-1])) if numbers else (0, {})

    def move(self, after: int, content: dict) -> None:
        """Say something new, unless someone else did since ``after`` was read."""
        write_once(self.spark, self._file(after + 1), json.dumps(content, sort_keys=True))

    def _file(self, number: int) -> str:
        return f"{self.folder}/{number:012}.json"


class BlockStore:
    """Rows by blocks, each in the version folder of the write that made it."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, block: str = BLOCK):
        self.spark = spark
        self.path = path
        self.schema = schema
        self.block = block

    def write(self, rows: DataFrame, block: Column, order: str | None = None) -> Versions:
        """Store rows beside what is there, and return their blocks. A large block has several files."""
        version = uuid.uuid4().hex
        dealt = rows.withColumn(self.block, block).hint("rebalance", self.block)
        dealt = dealt.sortWithinPartitions(self.block, *([order] if order else []))
        dealt.write.partitionBy(self.block).parquet(f"{self.path}/{version}")
        names = [n for n in children(self.spark, f"{self.path}/{version}") if n.startswith(f"{self.block}=")]
        return {int(n.partition("=")[2]): version for n in names}

    def folder(self, block: int, version: str) -> str:
        return f"{self.path}/{version}/{self.block}={block}"

    def read(self, versions: Mapping[int, str], blocks: Collection[int] | None = None) -> DataFrame:
        """The rows of the blocks, from their named folders: no other is listed."""
        wanted = versions if blocks is None else set(blocks) & set(versions)
        folders = [self.folder(b, versions[b]) for b in sorted(wanted)]
        if not folders:
            return nothing(self.spark, self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def clean(self, used: Collection[Versions], before: int) -> None:
        """Remove the blocks that none of ``used`` names, if written before a time."""
        named = {(b, v) for versions in used for b, v in versions.items()}
        for version, changed in children(self.spark, self.path).items():
            if changed >= before:
                continue
            if not any(v == version for _, v in named):
                remove(self.spark, f"{self.path}/{version}")
                continue
            for name in children(self.spark, f"{self.path}/{version}"):
                block = name.partition("=")[2]
                if block and (int(block), version) not in named:
                    remove(self.spark, f"{self.path}/{version}/{name}")


def as_versions(stored: Mapping[str, str]) -> Versions:
    return {int(block): version for block, version in stored.items()}


class SessionTable:
    """A raw table as stored."""

    def __init__(self, spark: SparkSession, warehouse: str, table: str):
        self.spark = spark
        self.table = table
        self.warehouse = warehouse
        self.path = f"{warehouse}/raw/{table}"
        self.schema = raw_schema(table)
        self.store = BlockStore(spark, f"{self.path}/data", self.schema)
        self.pointer = Pointer(spark, f"{self.path}/pointer")

    def versions(self) -> Versions:
        return as_versions(self.pointer.read()[1])

    def read(self) -> DataFrame:
        return self.store.read(self.versions())

    def blocks_of(self, sessions: DataFrame) -> list[int]:
        """Blocks with these sessions: the driver lists what it writes to in any case."""
        return [row[0] for row in sessions.select(block_of_session()).distinct().collect()]

    def read_blocks(self, blocks: Collection[int]) -> DataFrame:
        return self.store.read(self.versions(), blocks)

    def read_sessions(self, keys: DataFrame) -> DataFrame:
        """The rows of some sessions, from their blocks alone."""
        rows = self.read_blocks(self.blocks_of(keys))
        return rows.join(keys.select("session_key"), "session_key", "left_semi").select(*self.schema.names)

    def _merge(self, batch: DataFrame, merge: Callable[[DataFrame], DataFrame]) -> int:
        counts = batch.groupBy(block_of_session().alias("block")).count().collect()
        if counts:
            number, stored = self.pointer.read()
            versions, blocks = as_versions(stored), {row["block"] for row in counts}
            current = self.store.read(versions, blocks).select(*batch.columns)
            new = self.store.write(merge(current).select(*self.schema.names), block_of_session(), "session_key")
            rest = {b: v for b, v in versions.items() if b not in blocks}
            self.pointer.move(number, {**rest, **new})
        return sum(row["count"] for row in counts)

    def replace_sessions(self, new: DataFrame, work: Work | None = None) -> int:
        """Swap in the new rows of every session that has some; other sessions keep theirs.

        ``new`` is in stored form. Returns the number of rows loaded. With ``work`` the rows are known
        to be stored there already.
        """
        if set(new.columns) != {"id", *columns(self.table), "created_at"}:
            raise ValueError(f"columns do not match table {self.table}: {new.columns}")
        return self._with(new, ["session_key"], work, lambda current, batch: replace_by_key(current, batch, "session_key"))

    def upsert(self, new: DataFrame, work: Work | None = None) -> int:
        """Insert rows or write over those of the same key, keeping their first load time.

        ``new`` is in stored form with one row per key. Returns the number of rows processed.
        """
        keys = DIMENSION_KEYS[self.table]
        return self._with(new, keys, work, lambda current, batch: upsert(current, batch, keys))

    def _with(self, new: DataFrame, keys: list[str], work: Work | None, merge) -> int:
        checked = reject_null_keys(new, keys, self.table)
        if work is not None:
            return self._merge(checked, lambda current: merge(current, checked))
        with Work(self.spark, self.warehouse) as own:
            batch = own.written(checked)
            return self._merge(batch, lambda current: merge(current, batch))

    def clean(self, keep: int) -> None:
        """Remove what none of the last ``keep`` pointers reaches, and the pointers before them."""
        numbers = self.pointer.numbers()
        if not numbers:
            return
        used = [as_versions(self.pointer.at(n)) for n in numbers[-keep:]]
        times = children(self.spark, self.pointer.folder)
        self.store.clean(used, times[f"{numbers[-1]:012}.json"])
        for n in numbers[:-keep]:
            remove(self.spark, f"{self.pointer.folder}/{n:012}.json")
