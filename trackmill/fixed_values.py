"""Names, limits and column lists that define the results.

Everything here is a fixed value of the data model: changing one changes what the
tables contain. The code that uses them lives in ``operators`` and ``plans``.
"""

# --- raw tables: column -> Spark type, in stored order ----------------------------
RAW_COLUMNS = {
    "sessions": {
        "session_key": "int",
        "session_name": "string",
        "session_type": "string",
        "date_start": "timestamp_ntz",
        "date_end": "timestamp_ntz",
        "gmt_offset": "string",
        "location": "string",
        "country_name": "string",
        "country_code": "string",
        "circuit_key": "int",
        "circuit_short_name": "string",
        "year": "int",
    },
    "drivers": {
        "driver_number": "int",
        "session_key": "int",
        "broadcast_name": "string",
        "full_name": "string",
        "name_acronym": "string",
        "team_name": "string",
        "team_colour": "string",
        "country_code": "string",
        "headshot_url": "string",
    },
    "laps": {
        "session_key": "int",
        "driver_number": "int",
        "lap_number": "int",
        "lap_duration": "double",
        "duration_sector_1": "double",
        "duration_sector_2": "double",
        "duration_sector_3": "double",
        "i1_speed": "double",
        "i2_speed": "double",
        "st_speed": "double",
        "is_pit_out_lap": "boolean",
        "date_start": "timestamp_ntz",
    },
    "pit_stops": {
        "session_key": "int",
        "driver_number": "int",
        "lap_number": "int",
        "pit_duration": "double",
        "date": "timestamp_ntz",
    },
    "weather": {
        "session_key": "int",
        "date": "timestamp_ntz",
        "air_temperature": "double",
        "track_temperature": "double",
        "humidity": "double",
        "pressure": "double",
        "wind_speed": "double",
        "wind_direction": "int",
        "rainfall": "boolean",
    },
    "positions": {
        "session_key": "int",
        "driver_number": "int",
        "date": "timestamp_ntz",
        "position": "int",
    },
}

# Dimensions are merged on these keys; facts are replaced one session at a time.
DIMENSION_KEYS = {
    "sessions": ["session_key"],
    "drivers": ["driver_number", "session_key"],
}
FACTS = ["laps", "pit_stops", "weather", "positions"]

# Landing folder of each table; sessions are requested by year, the rest by session.
ENDPOINTS = {
    "sessions": "sessions",
    "drivers": "drivers",
    "laps": "laps",
    "pit_stops": "pit",
    "weather": "weather",
    "positions": "position",
}

# --- run selection -----------------------------------------------------------------
RUN_MODES = ["incremental", "backfill"]
LOOKBACK_DAYS = 14
FIRST_SEASON = 2023
DEFAULT_SEASONS = [2023, 2024, 2025]

# --- staging limits ------------------------------------------------------------------
LAP_SECONDS_ABOVE = 60
LAP_SECONDS_BELOW = 300
PIT_SECONDS_ABOVE = 0
PIT_SECONDS_BELOW = 600
POSITION_RANGE = (1, 30)
WEATHER_RANGES = {
    "air_temperature": (-20, 60),
    "track_temperature": (-20, 90),
    "humidity": (0, 100),
    "pressure": (700, 1100),
    "wind_speed": (0, 100),
}
WIND_DIRECTION_RANGE = (0, 359)

# --- categories ------------------------------------------------------------------------
PIT_STOP_CATEGORIES = ["very_fast", "normal", "slow", "very_slow"]
PIT_STOP_CATEGORY_BELOW = {"very_fast": 5, "normal": 15, "slow": 60}
WEATHER_CONDITIONS = ["rainy", "hot_track", "cold", "normal"]
HOT_TRACK_FROM = 40
COLD_AIR_UP_TO = 10

# --- marts --------------------------------------------------------------------------------
RACE_SESSION_TYPE = "Race"
RACE_SESSION_NAME = "Race"
WINNING_POSITION = 1
PODIUM_POSITIONS = 3
POINTS_POSITIONS = 10
COUNTED_PIT_SECONDS_BELOW = 60
SECONDS_PER_MINUTE = 60

# Reading order of the stored marts: column, descending?
MART_ORDER = {
    "driver_performance": [("year", True), ("avg_finish", False)],
    "fastest_laps": [("year", True), ("circuit_short_name", False), ("rank_on_circuit", False)],
    "pit_stop_impact": [("year", True), ("circuit_short_name", False), ("final_position", False)],
    "race_summary": [("year", True), ("circuit_short_name", False)],
    "team_comparison": [("year", True), ("avg_position", False)],
    "weather_analysis": [("year", True), ("circuit_short_name", False)],
}

# --- anomaly rules: these differ from the staging limits on purpose -------------------
ANOMALY_LAP_SECONDS = (60, 300)
ANOMALY_WEATHER_RANGES = {
    "air_temperature": (-20, 60),
    "track_temperature": (-20, 90),
    "humidity": (0, 100),
    "pressure": (800, 1100),
    "wind_speed": (0, 100),
}

# --- the declared data checks, by model -------------------------------------------------
MODEL_CHECKS = {
    "stg_sessions": {
        "not_null": ["session_key"],
        "unique": ["session_key"],
    },
    "stg_drivers": {
        "not_null": ["session_key", "driver_number"],
        "relationships": {"session_key": ("stg_sessions", "session_key")},
    },
    "stg_laps": {
        "not_null": ["session_key", "driver_number", "lap_number", "lap_duration"],
        "relationships": {"session_key": ("stg_sessions", "session_key")},
        "unique_rows": [["session_key", "driver_number", "lap_number"]],
    },
    "stg_positions": {
        "not_null": ["session_key", "driver_number", "position"],
        "relationships": {"session_key": ("stg_sessions", "session_key")},
    },
    "stg_pit_stops": {
        "not_null": ["session_key", "driver_number", "lap_number", "pit_duration"],
        "relationships": {"session_key": ("stg_sessions", "session_key")},
        "accepted_values": {"pit_stop_category": PIT_STOP_CATEGORIES},
    },
    "stg_weather": {
        "not_null": [
            "session_key",
            "air_temperature",
            "track_temperature",
            "humidity",
            "pressure",
        ],
        "relationships": {"session_key": ("stg_sessions", "session_key")},
        "accepted_values": {"weather_condition": WEATHER_CONDITIONS},
    },
    "fastest_laps": {
        "not_null": ["year", "circuit_short_name", "driver_name", "fastest_lap_sec"],
    },
    "pit_stop_impact": {
        "not_null": [
            "year",
            "circuit_short_name",
            "driver_name",
            "team_name",
            "pit_stop_count",
        ],
    },
    "team_comparison": {
        "not_null": ["year", "team_name", "races_count", "avg_position"],
    },
}
