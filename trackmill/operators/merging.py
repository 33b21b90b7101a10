"""Keyed upsert and per-key replacement, as pure DataFrame functions.

No side is broadcast by hint. A replacement's keys are broadcast by Spark when their size is known
to be small; an upsert shuffles both sides on the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from trackmill.functions.expressions import all_not_null, any_null
from trackmill.operators.groups import first_per_key


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Skip rows with an incomplete key."""
    return df.filter(all_not_null(keys))


def reject_null_keys(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """Fail the job when a row has an incomplete key; otherwise every row passes."""
    failure = F.raise_error(f"{what}: a record lacks its key ({', '.join(keys)})")
    return df.filter(F.when(any_null(keys), failure.cast("boolean")).otherwise(True))


def latest_in_batch(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the last one of the batch, where ``order`` puts the last first."""
    return first_per_key(df, keys, order)


def upsert(
    current: DataFrame, batch: DataFrame, keys: Sequence[str], keep: Sequence[str] = ("created_at",)
) -> DataFrame:
    """``current`` with the rows of ``batch`` inserted, or written over the row of the same key.

    An overwritten row keeps its first value of the ``keep`` columns. ``batch`` holds one row per
    key. One full join on the key, so each side is read once.
    """
    kept = [c for c in keep if c in current.columns]
    values = [c for c in current.columns if c not in keys]
    old = current.withColumn("_old", F.lit(True))
    new = batch.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in values], F.lit(True).alias("_new"))
    first = {c: F.when(F.col("_old"), F.col(c)).otherwise(F.col(f"_new_{c}")) for c in kept}
    last = {c: F.when(F.col("_new"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in values}
    merged = old.join(new, [*keys], "full")
    return merged.select(*[c if c in keys else {**last, **first}[c].alias(c) for c in current.columns])


def replace_by_key(current: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """All rows of ``new``, plus the rows of ``current`` whose key has no new row."""
    replaced = new.select(key).distinct()
    return current.join(replaced, key, "left_anti").unionByName(new)
