"""One row per group, and ranks inside a group.

All of these reduce on the map side first, so a group that holds a large share of
the rows sends at most one row per task over the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The whole first row of every key by ``order``, which should be total.

    Filtering a row number for 1 makes Spark limit each key both before and after the shuffle.
    """
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_row", number).filter(F.col("_row") == 1).drop("_row")


def least(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per key the smallest tuple of ``columns``, compared left to right.

    Reduced on the map side and with the named columns alone. A buffer of several columns is of no
    fixed width, so Spark aggregates by sorting each task's rows before the shuffle.
    """
    best = F.min(F.struct(*columns)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}") for c in columns])


def greatest(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per key the largest tuple of ``columns``, compared left to right."""
    best = F.max(F.struct(*columns)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}") for c in columns])


def rank_within(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """``rank()`` of ``value`` ascending inside ``keys``: equals share a rank and leave gaps.

    A group is ranked in one task, so reduce it first to a number of rows that does not grow
    with the facts.
    """
    rank = F.rank().over(Window.partitionBy(*keys).orderBy(F.col(value).asc_nulls_last()))
    return df.withColumn(name, rank.cast("bigint"))
