"""Every operator as a named query over a folder of test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from trackmill.fixed_values import DIMENSION_KEYS, FACTS, MODEL_CHECKS, RAW_COLUMNS
from trackmill.functions.expressions import lap_time, rounded, utc_timestamp
from trackmill.operators import checks
from trackmill.operators.merging import (
    drop_null_keys,
    latest_in_batch,
    replace_by_key,
    upsert,
)
from trackmill.operators.selection import (
    facts_for_sessions,
    select_backfill,
    select_incremental,
)
from trackmill.plans.models import ANOMALIES, MARTS, STAGING, Models
from trackmill.plans.stored import (
    published_model,
    published_report,
    stored_replacement,
    stored_upsert,
    streamed_weather,
)
from trackmill.plans.suite import check_report
from trackmill.schemas import columns
from trackmill.sources.payloads import payload_problem, read_records
from trackmill.sources.testdata import RawTables, damaged_payloads, payloads

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the queries, in the time range of the test tables.
NOW = datetime(1998, 6, 30)
LOOKBACK_DAYS = 180
SEASONS = [1996, 1998]
FIRST_SEASON = 1990
THIS_YEAR = 1998
# Loads that write over earlier data bring the sessions from this season on.
RELOADED_FROM = 1996
KNOWN_UNTIL = 1996
CHANGED_VALUE = {
    "laps": "st_speed",
    "pit_stops": "pit_duration",
    "weather": "humidity",
    "positions": "position",
}


def _model(name: str) -> Query:
    return lambda spark, sf_dir: getattr(Models(RawTables(spark, sf_dir)), name)


def _read(table: str) -> Query:
    """The table sent through JSON payloads and read back."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        request = "year" if table == "sessions" else "session_key"
        sent = payloads(RawTables(spark, sf_dir)[table], table, request)
        return read_records(sent, table).select(*columns(table))

    return query


def validate_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = damaged_payloads(RawTables(spark, sf_dir)["weather"])
    return damaged.select("id", payload_problem(F.col("payload")).alias("problem"))


def latest_pit_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col("id").desc()]
    return latest_in_batch(
        RawTables(spark, sf_dir)["pit_stops"], ["session_key", "driver_number"], order
    )


def complete_lap_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_null_keys(
        RawTables(spark, sf_dir)["laps"], ["session_key", "driver_number", "lap_number"]
    )


def _seasons(raw: dict[str, DataFrame], condition: str) -> DataFrame:
    return raw["sessions"].filter(condition).select("session_key")


def upsert_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions known up to a season, then all from that season on sent again and renamed."""
    rows = RawTables(spark, sf_dir)["sessions"]
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    later = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    current = rows.filter(F.col("year") <= KNOWN_UNTIL).withColumn("created_at", at)
    batch = (
        rows.filter(F.col("year") >= RELOADED_FROM)
        .withColumn("session_name", F.concat("session_name", F.lit(" (final)")))
        .withColumn("created_at", later)
    )
    return upsert(current, batch, DIMENSION_KEYS["sessions"])


def upsert_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = RawTables(spark, sf_dir)
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    later = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    known = _seasons(raw, f"year <= {KNOWN_UNTIL}")
    sent = _seasons(raw, f"year >= {RELOADED_FROM}")
    current = facts_for_sessions(raw["drivers"], known).withColumn("created_at", at)
    batch = (
        facts_for_sessions(raw["drivers"], sent)
        .withColumn("team_name", F.concat(F.trim("team_name"), F.lit(" II")))
        .withColumn("created_at", later)
    )
    return upsert(current, batch, DIMENSION_KEYS["drivers"])


def _replace(table: str) -> Query:
    """The whole fact table, then the later seasons' sessions loaded again with another value."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = RawTables(spark, sf_dir)
        sent = _seasons(raw, f"year >= {RELOADED_FROM}")
        value = CHANGED_VALUE[table]
        new = facts_for_sessions(raw[table], sent).withColumn(value, F.col(value) + 1)
        return replace_by_key(raw[table], new.select(*raw[table].columns), "session_key")

    return query


def replace_rainy_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replacement by another key: the days with rain hold only their rainy rows afterwards."""
    weather = RawTables(spark, sf_dir)["weather"]
    new = weather.filter("rainfall and date is not null")
    return replace_by_key(weather, new, "date").select(*weather.columns)


def selected_incrementally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_incremental(RawTables(spark, sf_dir)["sessions"], NOW, LOOKBACK_DAYS)


def selected_for_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_backfill(RawTables(spark, sf_dir)["sessions"], THIS_YEAR, SEASONS, FIRST_SEASON)


def parse_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lap times as text in another zone, read back as UTC."""
    laps = RawTables(spark, sf_dir)["laps"].select("session_key", "driver_number", "date_start")
    text = F.translate(F.col("date_start").cast("string"), " ", "T")
    return laps.select(
        "session_key",
        "driver_number",
        utc_timestamp(F.concat(text, F.lit("Z"))).alias("from_zulu"),
        utc_timestamp(F.concat(text, F.lit("+02:00"))).alias("from_offset"),
        utc_timestamp(F.coalesce(text, F.lit(""))).alias("from_naive"),
    )


def laps_of_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = RawTables(spark, sf_dir)
    chosen = select_incremental(raw["sessions"], NOW, LOOKBACK_DAYS)
    return facts_for_sessions(raw["laps"], chosen).select(*columns("laps"))


def lap_time_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    laps = RawTables(spark, sf_dir)["laps"].filter("lap_duration > 0")
    return laps.select("lap_duration", lap_time(F.col("lap_duration")).alias("lap_fmt"))


def driver_lap_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = Models(RawTables(spark, sf_dir)).driver_lap_stats
    return stats.select(
        "session_key",
        "driver_number",
        rounded(F.col("avg_lap_sec"), 3).alias("avg_lap_sec"),
        rounded(F.col("best_lap_sec"), 3).alias("best_lap_sec"),
    )


def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every model built, as its number of rows."""
    models = Models(RawTables(spark, sf_dir))
    counts = [
        getattr(models, name).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("model"), "n_rows"
        )
        for name in [*STAGING, *MARTS, *ANOMALIES]
    ]
    return reduce(DataFrame.unionByName, counts)


def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = RawTables(spark, sf_dir)
    parts = [
        checks.not_null(raw[t], columns(t)).withColumn("table_name", F.lit(t)) for t in RAW_COLUMNS
    ]
    return reduce(DataFrame.unionByName, parts)


def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.unique(RawTables(spark, sf_dir)["weather"], ["date"])


def check_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = Models(RawTables(spark, sf_dir))
    return checks.relationships(
        models.raw["laps"], "session_key", models.race_sessions, "session_key"
    )


def check_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    stops = Models(RawTables(spark, sf_dir)).stg_pit_stops
    return checks.accepted_values(stops, "pit_stop_category", ["very_fast", "normal"])


def check_unique_laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.unique(
        RawTables(spark, sf_dir)["laps"], ["session_key", "driver_number", "lap_number"]
    )


def full_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = Models(RawTables(spark, sf_dir))
    return check_report({name: getattr(models, name) for name in MODEL_CHECKS})


def raw_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging checks on tables that never went through staging, with races as parents."""
    models = Models(RawTables(spark, sf_dir))
    dirty = {
        "stg_sessions": models.race_sessions,
        "stg_drivers": models.raw["drivers"],
        "stg_laps": models.raw["laps"],
        "stg_positions": models.raw["positions"],
    }
    return check_report(dirty, {name: MODEL_CHECKS[name] for name in dirty})


DERIVED_MODELS = [
    "race_sessions",
    "final_positions",
    "race_winners",
    "session_fastest_lap",
    "pit_stats_by_session",
    "pit_stop_category_counts",
    "team_lap_stats",
    "weather_stats",
    "dq_reason_counts",
]

QUERIES: dict[str, Query] = {
    **{f"read_{t}": _read(t) for t in RAW_COLUMNS},
    "validate_payload": validate_payload,
    "latest_in_batch": latest_pit_stop,
    "reject_null_keys": complete_lap_keys,
    "upsert_sessions": upsert_sessions,
    "upsert_drivers": upsert_drivers,
    "replace_partitions": replace_rainy_days,
    **{f"replace_{t}": _replace(t) for t in FACTS},
    "select_incremental": selected_incrementally,
    "select_backfill": selected_for_backfill,
    "parse_utc": parse_utc,
    "facts_for_sessions": laps_of_selected,
    **{name: _model(name) for name in [*STAGING, *MARTS, *ANOMALIES, *DERIVED_MODELS]},
    "driver_lap_stats": driver_lap_stats,
    "lap_time_format": lap_time_format,
    "build_all": row_counts,
    "check_not_null": check_not_null,
    "check_unique": check_unique,
    "check_relationships": check_relationships,
    "check_accepted_values": check_accepted_values,
    "check_unique_laps": check_unique_laps,
    "check_report": full_report,
    "check_report_raw": raw_report,
    "published_race_summary": published_model("race_summary"),
    "published_check_report": published_report,
    "stored_replace_pit_stops": stored_replacement("pit_stops", "pit_duration", RELOADED_FROM),
    "stored_upsert_drivers": stored_upsert(KNOWN_UNTIL, RELOADED_FROM),
    "streamed_weather": streamed_weather,
}
