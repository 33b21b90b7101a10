"""Clean, deduplicated and categorised views of the raw tables.

Rows are filtered before they are deduplicated, so a dirty newest row never hides a clean
older one. Every order ends in the value columns, which makes it total: the result does not
depend on how the input was partitioned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from trackmill.fixed_values import (
    COLD_AIR_UP_TO,
    HOT_TRACK_FROM,
    LAP_SECONDS_ABOVE,
    LAP_SECONDS_BELOW,
    PIT_SECONDS_ABOVE,
    PIT_SECONDS_BELOW,
    PIT_STOP_CATEGORIES,
    PIT_STOP_CATEGORY_BELOW,
    POSITION_RANGE,
    WEATHER_CONDITIONS,
    WEATHER_RANGES,
    WIND_DIRECTION_RANGE,
)
from trackmill.functions.expressions import all_not_null, first_match, in_range
from trackmill.operators.groups import first_per_key

LAP_KEY = ["session_key", "driver_number", "lap_number"]
LAP_VALUES = [
    "lap_duration",
    "duration_sector_1",
    "duration_sector_2",
    "duration_sector_3",
    "i1_speed",
    "i2_speed",
    "st_speed",
]


def _ascending(names: Sequence[str]) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


def stg_sessions(sessions: DataFrame) -> DataFrame:
    return sessions.filter(F.col("session_key").isNotNull()).drop(
        "gmt_offset", "circuit_key", "created_at"
    )


def stg_drivers(drivers: DataFrame) -> DataFrame:
    keys = ["session_key", "driver_number"]
    texts = ["full_name", "name_acronym", "team_name", "team_colour", "country_code"]
    trimmed = drivers.select(*keys, *[F.trim(c).alias(c) for c in texts])
    named = trimmed.filter(
        all_not_null(keys) & (F.col("full_name") != "") & (F.col("team_name") != "")
    )
    return first_per_key(named, keys, _ascending(texts))


def clean_laps(laps: DataFrame) -> DataFrame:
    """Timed laps within the limits that did not start in the pits, repeats included."""
    seconds = F.col("lap_duration")
    return laps.withColumn(
        "is_pit_out_lap", F.coalesce("is_pit_out_lap", F.lit(False))
    ).filter(
        all_not_null([*LAP_KEY, "lap_duration"])
        & (seconds > LAP_SECONDS_ABOVE)
        & (seconds < LAP_SECONDS_BELOW)
        & ~F.col("is_pit_out_lap")
    )


def stg_laps(laps: DataFrame) -> DataFrame:
    flags = ["is_pit_out_lap", "date_start"]
    return timed_laps(laps, LAP_VALUES, flags)


def timed_laps(laps: DataFrame, values: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """One row per lap with only the wanted columns, so no others are read or shuffled.

    ``values`` is a leading part of ``LAP_VALUES``. The order over all value columns compares
    left to right, so it picks the same leading values.
    """
    order = [F.col("date_start").desc_nulls_last(), *_ascending(values)]
    narrow = clean_laps(laps).select(
        *LAP_KEY, *values, *extra, *[c for c in ["date_start"] if c not in extra]
    )
    return first_per_key(narrow, LAP_KEY, order).select(*LAP_KEY, *values, *extra)


def stg_pit_stops(pit_stops: DataFrame) -> DataFrame:
    seconds = F.col("pit_duration")
    keys = ["session_key", "driver_number", "lap_number", "pit_stop_timestamp"]
    limits = [(c, seconds < PIT_STOP_CATEGORY_BELOW[c]) for c in PIT_STOP_CATEGORIES[:-1]]
    clean = (
        pit_stops.select("id", *keys[:3], "pit_duration", F.col("date").alias(keys[3]))
        .filter(
            all_not_null([*keys, "pit_duration"])
            & (F.col("lap_number") > 0)
            & (seconds > PIT_SECONDS_ABOVE)
            & (seconds < PIT_SECONDS_BELOW)
        )
    )
    latest = first_per_key(clean, keys, [F.col("id").desc_nulls_first(), seconds.asc()])
    return latest.withColumn(
        "pit_stop_category", first_match(limits, default=PIT_STOP_CATEGORIES[-1])
    )


def clean_positions(positions: DataFrame) -> DataFrame:
    """Complete position rows within the limits, repeats included."""
    return positions.select(
        "id",
        "session_key",
        "driver_number",
        F.col("date").alias("position_timestamp"),
        "position",
    ).filter(
        all_not_null(["session_key", "driver_number", "position_timestamp"])
        & in_range("position", POSITION_RANGE)
    )


def stg_positions(positions: DataFrame) -> DataFrame:
    return first_per_key(
        clean_positions(positions),
        ["session_key", "driver_number", "position_timestamp"],
        [F.col("id").desc_nulls_first(), F.col("position").desc()],
    )


def stg_weather(weather: DataFrame) -> DataFrame:
    keys = ["session_key", "weather_timestamp"]
    measures = list(WEATHER_RANGES)
    wind = F.col("wind_direction")
    measured = weather.select(
        "id",
        "session_key",
        F.col("date").alias("weather_timestamp"),
        *measures,
        "wind_direction",
        F.coalesce("rainfall", F.lit(False)).alias("rainfall"),
    ).filter(all_not_null(keys) & (wind.isNull() | wind.between(*WIND_DIRECTION_RANGE)))
    for measure, limits in WEATHER_RANGES.items():
        measured = measured.filter(in_range(measure, limits))
    order = [
        F.col("id").desc_nulls_first(),
        *_ascending([*measures, "wind_direction", "rainfall"]),
    ]
    rain, hot, cold, normal = WEATHER_CONDITIONS
    return (
        first_per_key(measured, keys, order)
        .withColumn("temperature_difference", F.col("track_temperature") - F.col("air_temperature"))
        .withColumn(
            "weather_condition",
            first_match(
                [
                    (rain, F.col("rainfall")),
                    (hot, F.col("track_temperature") >= HOT_TRACK_FROM),
                    (cold, F.col("air_temperature") <= COLD_AIR_UP_TO),
                ],
                default=normal,
            ),
        )
    )
