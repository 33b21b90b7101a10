"""Column expressions shared by the plans. All are built-in functions, so they stay in codegen."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from trackmill.fixed_values import SECONDS_PER_MINUTE


def rounded(value: Column, digits: int) -> Column:
    """Round half away from zero through a decimal.

    A double mean or sum depends in its last bits on the order Spark added the rows in;
    nine decimals hide that noise, so every cluster size gives the same result.
    """
    return F.round(value.cast("decimal(38,9)"), digits).cast("double")


def all_not_null(names: Iterable[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(n).isNotNull() for n in names))


def any_null(names: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.col(n).isNull() for n in names))


def in_range(name: str, limits: tuple[float, float]) -> Column:
    """Non-null and within both limits, which are included."""
    return F.col(name).isNotNull() & F.col(name).between(*limits)


def outside(name: str, limits: tuple[float, float]) -> Column:
    return (F.col(name) < limits[0]) | (F.col(name) > limits[1])


def first_match(rules: Sequence[tuple[str, Column]], default: str | None = None) -> Column:
    """Label of the first rule that holds, else ``default``."""
    chain = reduce(lambda acc, rule: acc.when(rule[1], rule[0]), rules, F)
    return chain.otherwise(F.lit(default).cast("string"))


def lap_time(seconds: Column) -> Column:
    """``m:ss.mmm``; the seconds part is rounded on its own, so 119.9996 s reads 1:60.000."""
    minutes = F.floor(seconds / SECONDS_PER_MINUTE).cast("int").cast("string")
    rest = F.round(seconds.cast("decimal(38,9)") % F.lit(SECONDS_PER_MINUTE), 3)
    return F.concat(minutes, F.lit(":"), F.lpad(rest.cast("string"), 6, "0"))


def utc_timestamp(text: Column) -> Column:
    """ISO-8601 text as a UTC wall clock; blank is NULL and text without a zone is UTC.

    Goes through epoch microseconds, so the session time zone does not matter.
    Text that is not a timestamp fails the job.
    """

    def sign_at(from_end: int) -> Column:
        return F.substring(text, -from_end, 1).isin("+", "-")

    # a zone is Z, +hh:mm, +hhmm or +hh
    has_zone = text.endswith("Z") | sign_at(6) | sign_at(5) | sign_at(3)
    has_time = text.contains(":")
    instant = (
        F.when(text == "", None)
        .when(has_time & has_zone, text)
        .when(has_time, F.concat(text, F.lit("Z")))
        .otherwise(F.concat(text, F.lit(" 00:00:00Z")))
        .try_cast("timestamp")
    )
    refusal = F.raise_error(F.concat(F.lit("not a timestamp: "), text)).cast("timestamp")
    instant = F.when(text.isNull() | (text == "") | instant.isNotNull(), instant).otherwise(refusal)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)


def truth(text: Column) -> Column:
    """Text of a JSON number or boolean as a flag: non-zero is true, NULL stays NULL."""
    flag = F.coalesce(text.try_cast("double") != 0, text.try_cast("boolean"))
    refusal = F.raise_error(F.concat(F.lit("not a number or flag: "), text)).cast("boolean")
    return F.when(text.isNull() | flag.isNotNull(), flag).otherwise(refusal)
