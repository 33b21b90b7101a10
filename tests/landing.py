"""Write a small landing zone."""

import json
import os

from trackmill.fixed_values import ENDPOINTS


def land(root, table, request, records, name="part.json"):
    """``records`` is a list, or text to be written as it is."""
    folder = "year" if table == "sessions" else "session_key"
    path = os.path.join(str(root), ENDPOINTS[table], f"{folder}={request}")
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as out:
        out.write(records if isinstance(records, str) else json.dumps(records))


def session_record(key, **fields):
    base = {
        "session_key": key,
        "session_name": "Race",
        "session_type": "Race",
        "date_start": "2024-06-09T15:00:00+02:00",
        "date_end": "2024-06-09T17:00:00+02:00",
        "circuit_short_name": "Loop",
        "country_name": "Land",
        "circuit_key": 5,
        "year": 2024,
        "unknown_field": [1, 2],
    }
    return {**base, **fields}


def weekend(root, key):
    """Two drivers, a few laps, stops, weather and positions of one session."""
    land(root, "drivers", key, [
        {"driver_number": n, "session_key": key, "full_name": f" Driver {n} ",
         "name_acronym": f"D{n}", "team_name": "Team"} for n in (1, 2)
    ])
    land(root, "laps", key, [
        {"driver_number": n, "lap_number": i, "lap_duration": 80 + n + i / 10,
         "is_pit_out_lap": i == 1, "date_start": f"2024-06-09T13:0{i}:00+00:00",
         "session_key": 999}
        for n in (1, 2) for i in (1, 2, 3)
    ])
    land(root, "pit_stops", key, [
        {"driver_number": 1, "lap_number": 2, "pit_duration": 22.5,
         "date": "2024-06-09T13:10:00.250000+00:00"}
    ])
    land(root, "weather", key, [
        {"date": "2024-06-09T13:00:00+00:00", "air_temperature": 20, "track_temperature": 31.5,
         "humidity": 44.0, "pressure": 1001.1, "wind_speed": 1, "wind_direction": 90,
         "rainfall": rain, }
        for rain in (0, 1)
    ])
    land(root, "positions", key, [
        {"driver_number": n, "position": n, "date": "2024-06-09T14:30:00"} for n in (1, 2)
    ])
