"""The analytic tables.

Every fact is reduced to one row per session and driver (or per session) before it meets
another table. The reductions aggregate on the map side, so a session that holds a third of
all rows costs no more shuffle than any other, and the joins only see small rows. Inputs that
share the key (session_key, driver_number) are joined first: they are already partitioned
alike. The filtered sessions come last and Spark broadcasts them when they are small enough.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from trackmill.fixed_values import (
    COUNTED_PIT_SECONDS_BELOW,
    MART_ORDER,
    PODIUM_POSITIONS,
    POINTS_POSITIONS,
    RACE_SESSION_NAME,
    RACE_SESSION_TYPE,
    WINNING_POSITION,
)
from trackmill.functions.expressions import lap_time, rounded
from trackmill.operators.groups import greatest, least, rank_within

ENTRY = ["session_key", "driver_number"]
SECTORS = ["duration_sector_1", "duration_sector_2", "duration_sector_3"]


def race_sessions(sessions: DataFrame) -> DataFrame:
    """Grands prix only: a sprint has the same type but another name."""
    return sessions.filter(
        (F.col("session_type") == RACE_SESSION_TYPE) & (F.col("session_name") == RACE_SESSION_NAME)
    ).select("session_key", "year", "circuit_short_name", "country_name")


def final_positions(positions: DataFrame) -> DataFrame:
    """Last position of every driver in every session.

    Takes cleaned positions with or without their repeats: the newest row of the newest
    timestamp is the same either way, so one aggregation replaces deduplicating first.
    """
    latest = greatest(positions, ENTRY, ["position_timestamp", "id", "position"])
    return latest.select(*ENTRY, F.col("position").alias("final_position"))


def driver_lap_stats(laps: DataFrame) -> DataFrame:
    return laps.groupBy(*ENTRY).agg(
        F.avg("lap_duration").alias("avg_lap_sec"), F.min("lap_duration").alias("best_lap_sec")
    )


def _finish_counts() -> list[Column]:
    finish = F.col("final_position")
    return [
        F.count_if(finish == WINNING_POSITION).alias("wins"),
        F.count_if(finish <= PODIUM_POSITIONS).alias("podiums"),
        F.count_if(finish <= POINTS_POSITIONS).alias("points_finishes"),
    ]


def driver_performance(
    races: DataFrame, finals: DataFrame, drivers: DataFrame, lap_stats: DataFrame
) -> DataFrame:
    """Season results per driver and team; a driver who changes team has a row for each.

    ``avg_lap_time`` is the mean of the driver's race means, whatever their lap counts.
    """
    results = (
        finals.join(drivers, ENTRY).join(lap_stats, ENTRY, "left").join(races, "session_key")
    )
    return results.groupBy(
        "year", "driver_number", "full_name", "name_acronym", "team_name"
    ).agg(
        F.count_distinct("session_key").alias("races"),
        rounded(F.avg("final_position"), 2).alias("avg_finish"),
        *_finish_counts(),
        rounded(F.avg("avg_lap_sec"), 3).alias("avg_lap_time"),
        rounded(F.min("best_lap_sec"), 3).alias("best_lap"),
    )


def best_lap_per_entry(laps: DataFrame) -> DataFrame:
    """Fastest lap of every driver in every session, the earlier one of equals."""
    return least(laps, ENTRY, ["lap_duration", "lap_number", *SECTORS])


def fastest_laps(races: DataFrame, best_laps: DataFrame, drivers: DataFrame) -> DataFrame:
    """Every driver's fastest race lap per circuit and season, ranked on the circuit.

    A driver missing from that session's entry list drops out before the ranking.
    """
    per_season = least(
        best_laps.join(races, "session_key"),
        ["driver_number", "circuit_short_name", "year"],
        ["lap_duration", "lap_number", "session_key", *SECTORS, "country_name"],
    )
    listed = per_season.join(drivers, ENTRY).select(
        "driver_number",
        F.col("full_name").alias("driver_name"),
        "name_acronym",
        "team_name",
        "circuit_short_name",
        "country_name",
        "year",
        "lap_number",
        F.col("lap_duration").alias("fastest_lap_sec"),
        *SECTORS,
        lap_time(F.col("lap_duration")).alias("fastest_lap_fmt"),
    )
    # a circuit's season now has one row per driver, however many laps were driven
    return rank_within(
        listed, ["circuit_short_name", "year"], "fastest_lap_sec", "rank_on_circuit"
    )


def counted_pit_stops(pit_stops: DataFrame) -> DataFrame:
    """Stops short enough to count as racing; longer ones are red flags and retirements."""
    return pit_stops.filter(F.col("pit_duration") < COUNTED_PIT_SECONDS_BELOW)


def entry_pit_stops(pit_stops: DataFrame) -> DataFrame:
    """Stops and time lost of every driver in every session."""
    return (
        counted_pit_stops(pit_stops)
        .groupBy(*ENTRY)
        .agg(
            F.count(F.lit(1)).alias("pit_stop_count"),
            rounded(F.avg("pit_duration"), 2).alias("avg_pit_duration_sec"),
            rounded(F.sum("pit_duration"), 2).alias("total_pit_time_sec"),
        )
    )


def pit_stop_impact(
    races: DataFrame, stops: DataFrame, finals: DataFrame, drivers: DataFrame
) -> DataFrame:
    """Stops and time lost per driver and race, beside the final position."""
    return (
        stops.join(finals, ENTRY)
        .join(drivers, ENTRY)
        .join(races, "session_key")
        .select(
            "year",
            "circuit_short_name",
            "country_name",
            F.col("full_name").alias("driver_name"),
            "name_acronym",
            "team_name",
            "pit_stop_count",
            "avg_pit_duration_sec",
            "total_pit_time_sec",
            "final_position",
        )
    )


def pit_stop_category_counts(pit_stops: DataFrame) -> DataFrame:
    return pit_stops.groupBy("pit_stop_category").agg(F.count(F.lit(1)).alias("n_stops"))


def race_winners(finals: DataFrame, drivers: DataFrame) -> DataFrame:
    """Whoever finished first; timing data can name more than one driver per session."""
    first = finals.filter(F.col("final_position") == WINNING_POSITION)
    return first.join(drivers, ENTRY).select(
        "session_key",
        F.col("full_name").alias("winner_name"),
        F.col("name_acronym").alias("winner_acronym"),
        F.col("team_name").alias("winner_team"),
    )


def session_fastest_lap(laps: DataFrame, drivers: DataFrame) -> DataFrame:
    """The fastest lap of each session, absent when its driver is not on the entry list."""
    best = least(laps, ["session_key"], ["lap_duration", "lap_number", "driver_number"])
    return best.join(drivers, ENTRY).select(
        "session_key",
        F.col("full_name").alias("fastest_lap_driver"),
        F.col("team_name").alias("fastest_lap_team"),
        F.col("lap_number").alias("fastest_lap_number"),
        rounded(F.col("lap_duration"), 3).alias("fastest_lap_sec"),
    )


def pit_stats_by_session(pit_stops: DataFrame) -> DataFrame:
    return (
        counted_pit_stops(pit_stops)
        .groupBy("session_key")
        .agg(
            F.count(F.lit(1)).alias("total_pit_stops"),
            F.count_distinct("driver_number").alias("drivers_with_pit_stops"),
            rounded(F.avg("pit_duration"), 2).alias("avg_pit_duration_sec"),
            rounded(F.min("pit_duration"), 2).alias("fastest_pit_stop_sec"),
            rounded(F.max("pit_duration"), 2).alias("slowest_pit_stop_sec"),
        )
    )


def weather_stats(weather: DataFrame) -> DataFrame:
    measures = ["air_temperature", "track_temperature", "humidity", "pressure", "wind_speed"]
    return weather.groupBy("session_key").agg(
        *[rounded(F.avg(m), 2).alias(f"avg_{m}") for m in measures],
        F.bool_or("rainfall").alias("had_rain"),
        F.count(F.lit(1)).alias("weather_measurements"),
    )


def race_summary(
    races: DataFrame,
    finals: DataFrame,
    winners: DataFrame,
    fastest: DataFrame,
    pit_stats: DataFrame,
    weather: DataFrame,
) -> DataFrame:
    """One row per race that has positions, or one per winner where there are several."""
    # asking for the position makes this the aggregation the winners need: Spark runs it once
    placed = finals.filter(F.col("final_position").isNotNull()).select("session_key")
    return (
        races.join(placed, "session_key", "left_semi")
        .join(winners, "session_key", "left")
        .join(fastest, "session_key", "left")
        .join(pit_stats, "session_key", "left")
        .join(weather.drop("weather_measurements"), "session_key", "left")
        .fillna(0, ["total_pit_stops", "drivers_with_pit_stops"])
    )


def team_results(races: DataFrame, finals: DataFrame, drivers: DataFrame) -> DataFrame:
    results = finals.join(drivers, ENTRY).join(races, "session_key")
    return results.groupBy("year", "team_name").agg(
        F.count_distinct("session_key").alias("races_count"),
        rounded(F.avg("final_position"), 2).alias("avg_position"),
        *_finish_counts(),
    )


def team_lap_stats(races: DataFrame, lap_stats: DataFrame, drivers: DataFrame) -> DataFrame:
    """Mean of the drivers' session means and the best lap, per season and team."""
    return (
        lap_stats.join(drivers, ENTRY)
        .join(races, "session_key")
        .groupBy("year", "team_name")
        .agg(
            rounded(F.avg("avg_lap_sec"), 3).alias("avg_lap_time_sec"),
            rounded(F.min("best_lap_sec"), 3).alias("best_lap_time_sec"),
        )
    )


def team_comparison(results: DataFrame, lap_stats: DataFrame) -> DataFrame:
    return results.join(lap_stats, ["year", "team_name"], "left")


def weather_analysis(races: DataFrame, weather: DataFrame) -> DataFrame:
    return weather.join(races, "session_key").select(
        "year", "circuit_short_name", "country_name", *[c for c in weather.columns if c != "session_key"]
    )


def in_reading_order(mart: DataFrame, name: str) -> DataFrame:
    """Sorted as the table is meant to be read: NULLs last ascending, first descending."""
    return mart.orderBy(
        *[
            F.col(c).desc_nulls_first() if descending else F.col(c).asc_nulls_last()
            for c, descending in MART_ORDER[name]
        ]
    )
