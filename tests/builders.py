"""Small hand-made tables."""

from datetime import datetime

from trackmill.schemas import raw_schema


def at(text):
    return datetime.fromisoformat(text)


def table(spark, name, rows):
    """Raw table from dicts; absent columns are NULL."""
    schema = raw_schema(name)
    return spark.createDataFrame([tuple(r.get(f) for f in schema.names) for r in rows], schema)


def session(key, **fields):
    base = {
        "session_key": key,
        "session_name": "Race",
        "session_type": "Race",
        "year": 2024,
        "circuit_short_name": "Loop",
        "country_name": "Land",
    }
    return {**base, **fields}


def driver(key, number, **fields):
    base = {
        "session_key": key,
        "driver_number": number,
        "full_name": f"Driver {number}",
        "name_acronym": f"D{number}",
        "team_name": "Team",
    }
    return {**base, **fields}


def lap(key, number, lap_number, seconds, **fields):
    base = {
        "session_key": key,
        "driver_number": number,
        "lap_number": lap_number,
        "lap_duration": seconds,
        "date_start": at("2024-03-02 15:00:00"),
    }
    return {**base, **fields}


def pit(key, number, lap_number, seconds, when="2024-03-02 15:30:00", **fields):
    base = {
        "id": 1,
        "session_key": key,
        "driver_number": number,
        "lap_number": lap_number,
        "pit_duration": seconds,
        "date": at(when),
    }
    return {**base, **fields}


def position(key, number, place, when="2024-03-02 16:00:00", **fields):
    base = {
        "id": 1,
        "session_key": key,
        "driver_number": number,
        "position": place,
        "date": at(when),
    }
    return {**base, **fields}


def weather(key, when="2024-03-02 15:00:00", **fields):
    base = {
        "id": 1,
        "session_key": key,
        "date": at(when),
        "air_temperature": 20.0,
        "track_temperature": 30.0,
        "humidity": 50.0,
        "pressure": 1000.0,
        "wind_speed": 2.0,
        "wind_direction": 90,
        "rainfall": False,
    }
    return {**base, **fields}


def raw(spark, **rows):
    names = ["sessions", "drivers", "laps", "pit_stops", "weather", "positions"]
    return {n: table(spark, n, rows.get(n, [])) for n in names}


def values(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.select(*names).collect())
