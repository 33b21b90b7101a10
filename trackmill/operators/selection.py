"""Which sessions a run loads."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F

from trackmill.fixed_values import DEFAULT_SEASONS, FIRST_SEASON, LOOKBACK_DAYS, RUN_MODES
from trackmill.operators.merging import drop_null_keys


def utc_wall_clock(moment: datetime) -> datetime:
    """Without a zone: a time that has one is converted to UTC, one that has none is UTC."""
    return moment if moment.tzinfo is None else moment.astimezone(timezone.utc).replace(tzinfo=None)


def utc_literal(moment: datetime) -> Column:
    return F.lit(utc_wall_clock(moment).isoformat(sep=" ")).cast("timestamp_ntz")


def select_incremental(
    sessions: DataFrame,
    now: datetime,
    lookback_days: int = LOOKBACK_DAYS,
    ended: str = "date_end",
    season: str = "year",
) -> DataFrame:
    """Sessions that ended in the window up to ``now``, both ends included.

    ``ended`` is a UTC wall clock. Only the seasons the window touches are looked at:
    where ``season`` is a landing folder, the other folders are not read.
    """
    now = utc_wall_clock(now)
    start = now - timedelta(days=lookback_days)
    return drop_null_keys(sessions, ["session_key"]).filter(
        F.col(season).between(start.year, now.year)
        & F.col(ended).between(utc_literal(start), utc_literal(now))
    )


def valid_seasons(seasons: object, this_year: int, first: int = FIRST_SEASON) -> list[int]:
    """The seasons sorted and without repeats; anything but a list of known years is refused."""
    if not isinstance(seasons, list) or not seasons:
        raise ValueError("backfill needs a non-empty list of seasons")
    wrong = [s for s in seasons if type(s) is not int or not first <= s <= this_year]
    if wrong:
        raise ValueError(f"not a season between {first} and {this_year}: {wrong}")
    return sorted(set(seasons))


def select_backfill(
    sessions: DataFrame,
    this_year: int,
    seasons: Sequence[int] | None = None,
    first: int = FIRST_SEASON,
    season: str = "year",
) -> DataFrame:
    """Every session of the seasons, finished or not."""
    wanted = valid_seasons(DEFAULT_SEASONS if seasons is None else seasons, this_year, first)
    return drop_null_keys(sessions, ["session_key"]).filter(F.col(season).isin(*wanted))


def seasons_of_run(mode: str, now: datetime, seasons: Sequence[int] | None = None) -> list[int]:
    """The seasons whose sessions a run looks at."""
    if mode not in RUN_MODES:
        raise ValueError(f"unknown run mode: {mode}")
    now = utc_wall_clock(now)
    if mode == "backfill":
        return valid_seasons(DEFAULT_SEASONS if seasons is None else seasons, now.year)
    return list(range((now - timedelta(days=LOOKBACK_DAYS)).year, now.year + 1))


def select_sessions(
    sessions: DataFrame,
    mode: str,
    now: datetime,
    seasons: Sequence[int] | None = None,
    ended: str = "date_end",
    season: str = "year",
) -> DataFrame:
    if mode not in RUN_MODES:
        raise ValueError(f"unknown run mode: {mode}")
    if mode == "backfill":
        return select_backfill(sessions, utc_wall_clock(now).year, seasons, season=season)
    return select_incremental(sessions, now, ended=ended, season=season)


def facts_for_sessions(facts: DataFrame, sessions: DataFrame) -> DataFrame:
    """The rows of the selected sessions, as one join for all of them."""
    return facts.join(sessions.select("session_key"), "session_key", "left_semi")
