"""What the operators of this subpackage share."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import TypeVar

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession

from trackmill.sources.tables import work_folder, written

Model = TypeVar("Model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, or one beside the warehouse where none is named (tests)."""
    return work_folder(spark, f"{spark.conf.get('spark.sql.warehouse.dir')}/llm-work")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: survives lost executors, cuts lineage."""
    return written(df, shared_folder(df.sparkSession))


def merged(left: DataFrame, right: DataFrame, on: Column | list[str] | str, how: str = "inner") -> DataFrame:
    """``left`` joined with ``right`` by sorting, whatever Spark takes their sizes for.

    It sizes a table by its compressed files and a list as one number, so that it would gather on the
    driver, to broadcast them, rows of many times its threshold.
    """
    return left.join(right.hint("merge"), on, how)


def partitions(spark: SparkSession) -> int:
    """How many buckets a job deals its rows to: the session's shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fit_in_task(rows: DataFrame, learn: Callable[[pd.DataFrame], Model]) -> Model:
    """``learn`` of all rows, whose number the caller bounds, in one task: the driver gets the model only."""
    names = rows.columns

    def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sample = pd.concat([pd.DataFrame(columns=names), *batches], ignore_index=True)
        yield pd.DataFrame({"model": [pickle.dumps(learn(sample))]})

    found = rows.repartition(1).mapInPandas(fitted, "model binary").collect()
    return pickle.loads(found[0].model) if found else learn(pd.DataFrame(columns=names))


def utf8(texts: pa.ChunkedArray | pa.Array) -> Iterator[bytes]:
    """Each text as UTF-8 bytes; a null is empty."""
    for text in texts:
        yield text.as_buffer().to_pybytes() if text.is_valid else b""


def slices(batches: Iterator[pa.RecordBatch], most_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches with about ``most_bytes`` of text, one text at least."""
    for rows in batches:
        ends = np.cumsum([len(t.as_buffer()) if t.is_valid else 0 for t in rows["text"]])
        low = 0
        while low < rows.num_rows:
            before = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, before + most_bytes, "right")))
            yield rows.slice(low, high - low)
            low = high


def pack(values: np.ndarray, kind: str = "<u8") -> bytes:
    return np.ascontiguousarray(values).astype(kind, copy=False).tobytes()


def unpack(blob: bytes, kind: str = "<u8") -> np.ndarray:
    return np.frombuffer(blob, dtype=kind)


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, type=f.type)
            for f in schema
        ],
        schema=schema,
    )


#: DuckDB: the crc32 of doc_id in decimal, as a common table expression ``crc(doc_id, h)``.
CRC_SQL = """crc as (
    select doc_id, xor(4294967295, list_reduce(
        list_prepend(4294967295, list_transform(string_split(cast(doc_id as varchar), ''), lambda c: cast(ascii(c) as bigint))),
        lambda acc, c: list_reduce(list_prepend(xor(acc, c), range(8)),
            lambda x, i: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end))) as h
    from documents where doc_id is not null
)"""
