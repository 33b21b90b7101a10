"""Raw rows that break a rule, labelled with the first rule they break. One pass, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from trackmill.fixed_values import (
    ANOMALY_LAP_SECONDS,
    ANOMALY_WEATHER_RANGES,
    WIND_DIRECTION_RANGE,
)
from trackmill.functions.expressions import first_match, outside
from trackmill.schemas import columns


def _labelled(df: DataFrame, rules) -> DataFrame:
    return df.withColumn("anomaly_reason", first_match(rules)).filter(
        F.col("anomaly_reason").isNotNull()
    )


def dq_lap_anomalies(laps: DataFrame) -> DataFrame:
    seconds = F.col("lap_duration")
    shortest, longest = ANOMALY_LAP_SECONDS
    required = ["session_key", "driver_number", "lap_number", "lap_duration"]
    rules = [
        *[(f"missing_{name}", F.col(name).isNull()) for name in required],
        ("non_positive_lap_duration", seconds <= 0),
        ("lap_too_short", seconds < shortest),
        ("lap_too_long", seconds > longest),
        ("pit_out_lap", F.col("is_pit_out_lap")),
    ]
    return _labelled(laps.select(*columns("laps")), rules)


def dq_weather_anomalies(weather: DataFrame) -> DataFrame:
    rules = [
        ("missing_session_key", F.col("session_key").isNull()),
        ("missing_timestamp", F.col("date").isNull()),
    ]
    for measure, limits in ANOMALY_WEATHER_RANGES.items():
        rules.append((f"missing_{measure}", F.col(measure).isNull()))
        rules.append((f"invalid_{measure}", outside(measure, limits)))
    rules.append(("invalid_wind_direction", outside("wind_direction", WIND_DIRECTION_RANGE)))
    return _labelled(weather.select("id", *columns("weather")), rules)


def dq_reason_counts(lap_anomalies: DataFrame, weather_anomalies: DataFrame) -> DataFrame:
    """How often each rule was broken, per table."""
    reasons = lap_anomalies.select(F.lit("laps").alias("table_name"), "anomaly_reason").unionByName(
        weather_anomalies.select(F.lit("weather").alias("table_name"), "anomaly_reason")
    )
    return reasons.groupBy("table_name", "anomaly_reason").agg(F.count(F.lit(1)).alias("n_rows"))
