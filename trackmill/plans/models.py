"""Which model reads which: raw tables -> staging -> marts and anomalies."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame

from trackmill.plans import marts, quality, staging

STAGING = [
    "stg_sessions",
    "stg_drivers",
    "stg_laps",
    "stg_pit_stops",
    "stg_positions",
    "stg_weather",
]
MARTS = [
    "race_summary",
    "driver_performance",
    "team_comparison",
    "fastest_laps",
    "pit_stop_impact",
    "weather_analysis",
]
ANOMALIES = ["dq_lap_anomalies", "dq_weather_anomalies"]
# Reductions of staged facts, which the marts read instead of them.
SHARED = [
    "final_positions",
    "driver_lap_stats",
    "best_laps",
    "pit_stats_by_session",
    "entry_pit_stops",
    "weather_stats",
]
# Computed within one session: a session's rows depend on that session's raw rows alone.
BY_SESSION = [*STAGING, *SHARED, *ANOMALIES]


class Models:
    """Every model as a lazy DataFrame over a set of raw tables.

    Assigning a stored table to an attribute makes the models downstream read that instead.
    """

    def __init__(self, raw: Mapping[str, DataFrame]):
        self.raw = raw

    @cached_property
    def stg_sessions(self) -> DataFrame:
        return staging.stg_sessions(self.raw["sessions"])

    @cached_property
    def stg_drivers(self) -> DataFrame:
        return staging.stg_drivers(self.raw["drivers"])

    @cached_property
    def stg_laps(self) -> DataFrame:
        return staging.stg_laps(self.raw["laps"])

    @cached_property
    def stg_pit_stops(self) -> DataFrame:
        return staging.stg_pit_stops(self.raw["pit_stops"])

    @cached_property
    def stg_positions(self) -> DataFrame:
        return staging.stg_positions(self.raw["positions"])

    @cached_property
    def stg_weather(self) -> DataFrame:
        return staging.stg_weather(self.raw["weather"])

    # Narrow forms of the staged facts, so that a mart reads and shuffles only what it uses.

    @cached_property
    def lap_times(self) -> DataFrame:
        return staging.timed_laps(self.raw["laps"], staging.LAP_VALUES[:1])

    @cached_property
    def lap_sectors(self) -> DataFrame:
        return staging.timed_laps(self.raw["laps"], staging.LAP_VALUES[:4])

    @cached_property
    def session_laps(self) -> DataFrame:
        """Laps to find a session's fastest among; the best of each entry would do as well."""
        return self.lap_times

    @cached_property
    def race_sessions(self) -> DataFrame:
        return marts.race_sessions(self.stg_sessions)

    @cached_property
    def final_positions(self) -> DataFrame:
        return marts.final_positions(staging.clean_positions(self.raw["positions"]))

    @cached_property
    def driver_lap_stats(self) -> DataFrame:
        return marts.driver_lap_stats(self.lap_times)

    @cached_property
    def best_laps(self) -> DataFrame:
        return marts.best_lap_per_entry(self.lap_sectors)

    @cached_property
    def race_winners(self) -> DataFrame:
        return marts.race_winners(self.final_positions, self.stg_drivers)

    @cached_property
    def session_fastest_lap(self) -> DataFrame:
        return marts.session_fastest_lap(self.session_laps, self.stg_drivers)

    @cached_property
    def pit_stats_by_session(self) -> DataFrame:
        return marts.pit_stats_by_session(self.stg_pit_stops)

    @cached_property
    def entry_pit_stops(self) -> DataFrame:
        return marts.entry_pit_stops(self.stg_pit_stops)

    @cached_property
    def weather_stats(self) -> DataFrame:
        return marts.weather_stats(self.stg_weather)

    @cached_property
    def race_summary(self) -> DataFrame:
        return marts.race_summary(
            self.race_sessions,
            self.final_positions,
            self.race_winners,
            self.session_fastest_lap,
            self.pit_stats_by_session,
            self.weather_stats,
        )

    @cached_property
    def driver_performance(self) -> DataFrame:
        return marts.driver_performance(
            self.race_sessions, self.final_positions, self.stg_drivers, self.driver_lap_stats
        )

    @cached_property
    def team_lap_stats(self) -> DataFrame:
        return marts.team_lap_stats(self.race_sessions, self.driver_lap_stats, self.stg_drivers)

    @cached_property
    def team_comparison(self) -> DataFrame:
        results = marts.team_results(self.race_sessions, self.final_positions, self.stg_drivers)
        return marts.team_comparison(results, self.team_lap_stats)

    @cached_property
    def fastest_laps(self) -> DataFrame:
        return marts.fastest_laps(
            self.race_sessions, self.best_laps, self.stg_drivers
        )

    @cached_property
    def pit_stop_impact(self) -> DataFrame:
        return marts.pit_stop_impact(
            self.race_sessions, self.entry_pit_stops, self.final_positions, self.stg_drivers
        )

    @cached_property
    def pit_stop_category_counts(self) -> DataFrame:
        return marts.pit_stop_category_counts(self.stg_pit_stops)

    @cached_property
    def weather_analysis(self) -> DataFrame:
        return marts.weather_analysis(self.race_sessions, self.weather_stats)

    @cached_property
    def dq_lap_anomalies(self) -> DataFrame:
        return quality.dq_lap_anomalies(self.raw["laps"])

    @cached_property
    def dq_weather_anomalies(self) -> DataFrame:
        return quality.dq_weather_anomalies(self.raw["weather"])

    @cached_property
    def dq_reason_counts(self) -> DataFrame:
        return quality.dq_reason_counts(self.dq_lap_anomalies, self.dq_weather_anomalies)
