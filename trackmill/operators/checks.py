"""Declarative data checks. Each returns its violations; an empty result is a pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def not_null(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """NULL count of every column that has any, from a single pass over the table."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    return counts.unpivot([], list(names), "column_name", "n_rows").filter("n_rows > 0")


def unique(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keys that occur more than once. A NULL in a single-column key is not a violation."""
    rows = df.filter(F.col(names[0]).isNotNull()) if len(names) == 1 else df
    return (
        rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)
    )


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Non-null child values without a parent, with their row counts.

    Children are counted per value before the join, so a value that fills most of the
    table reaches the join as one row.
    """
    values = child.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    return values.join(parent.select(F.col(field).alias(column)), column, "left_anti")


def accepted_values(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Non-null values outside the accepted ones, with their row counts."""
    return (
        df.filter(~F.col(column).isin(*accepted))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
