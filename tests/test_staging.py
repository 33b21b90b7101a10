from pyspark.sql import functions as F

from builders import at, driver, lap, pit, position, session, table, values, weather
from trackmill.plans import staging


def test_sessions_without_key_are_dropped(spark):
    df = staging.stg_sessions(table(spark, "sessions", [session(1), session(None)]))
    assert values(df, "session_key") == [(1,)]
    assert "created_at" not in df.columns and "gmt_offset" not in df.columns


def test_drivers_are_trimmed_and_need_names(spark):
    rows = [
        driver(1, 1, full_name="  A B ", team_name=" T "),
        driver(1, 2, full_name="   "),
        driver(1, 3, full_name=None),
        driver(1, 4, team_name=" "),
        driver(1, None),
        driver(1, 1, full_name="Z"),
        driver(1, 5, full_name="\tTab"),
    ]
    df = staging.stg_drivers(table(spark, "drivers", rows))
    expected = [(1, "A B", "T"), (5, "\tTab", "Team")]
    assert values(df, "driver_number", "full_name", "team_name") == expected


def test_lap_limits_are_exclusive(spark):
    seconds = [59.9, 60.0, 60.001, 299.999, 300.0, None, float("nan")]
    rows = [lap(1, 1, i, s) for i, s in enumerate(seconds)]
    df = staging.stg_laps(table(spark, "laps", rows))
    assert values(df, "lap_duration") == [(60.001,), (299.999,)]


def test_pit_out_laps_are_dropped_and_unknown_flags_are_false(spark):
    rows = [
        lap(1, 1, 1, 80.0, is_pit_out_lap=True),
        lap(1, 1, 2, 80.0, is_pit_out_lap=None),
        lap(1, 1, 3, 80.0, is_pit_out_lap=False),
    ]
    df = staging.stg_laps(table(spark, "laps", rows))
    assert values(df, "lap_number", "is_pit_out_lap") == [(2, False), (3, False)]


def test_newest_clean_lap_wins_over_a_dirty_newer_one(spark):
    rows = [
        lap(1, 1, 1, 81.0, date_start=at("2024-01-01 10:00:00")),
        lap(1, 1, 1, 82.0, date_start=at("2024-01-01 11:00:00")),
        lap(1, 1, 1, 10.0, date_start=at("2024-01-01 12:00:00")),
        lap(1, 1, 1, 83.0, date_start=None),
    ]
    df = staging.stg_laps(table(spark, "laps", rows))
    assert values(df, "lap_duration") == [(82.0,)]


def test_narrow_laps_pick_the_same_rows_as_the_full_table(spark):
    when = at("2024-01-01 10:00:00")
    rows = [
        lap(1, 1, 1, 81.0, date_start=when, duration_sector_1=30.0, i1_speed=9.0),
        lap(1, 1, 1, 81.0, date_start=when, duration_sector_1=20.0, i1_speed=10.0),
        lap(1, 1, 1, 80.5, date_start=when, duration_sector_1=40.0, i1_speed=1.0),
    ]
    laps = table(spark, "laps", rows)
    full = staging.stg_laps(laps)
    for width in (1, 4):
        names = staging.LAP_VALUES[:width]
        assert values(staging.timed_laps(laps, names), *names) == values(full, *names)


def test_pit_stop_categories_and_limits(spark):
    seconds = [0.0, 4.9, 5.0, 15.0, 60.0, 599.9, 600.0]
    rows = [pit(1, 1, i + 1, s) for i, s in enumerate(seconds)]
    df = staging.stg_pit_stops(table(spark, "pit_stops", rows))
    assert values(df, "pit_duration", "pit_stop_category") == [
        (4.9, "very_fast"),
        (5.0, "normal"),
        (15.0, "slow"),
        (60.0, "very_slow"),
        (599.9, "very_slow"),
    ]


def test_last_inserted_pit_stop_wins(spark):
    rows = [pit(1, 1, 3, 20.0, id=5), pit(1, 1, 3, 22.0, id=9), pit(1, 1, 0, 20.0)]
    df = staging.stg_pit_stops(table(spark, "pit_stops", rows))
    assert values(df, "id", "pit_duration") == [(9, 22.0)]


def test_positions_between_one_and_thirty(spark):
    rows = [position(1, n, p) for n, p in enumerate([0, 1, 30, 31, None])]
    rows.append(position(1, 1, 7, id=2))
    df = staging.stg_positions(table(spark, "positions", rows))
    assert values(df, "driver_number", "position") == [(1, 7), (2, 30)]


def test_weather_limits_conditions_and_wind(spark):
    def at_minute(i, **fields):
        return weather(1, f"2024-03-02 15:{i:02d}:00", **fields)

    rows = [
        at_minute(0, pressure=699.0),
        at_minute(1, pressure=700.0),
        at_minute(2, wind_direction=None),
        at_minute(3, wind_direction=360),
        at_minute(4, rainfall=True, track_temperature=50.0),
        at_minute(5, track_temperature=40.0),
        at_minute(6, air_temperature=10.0),
        at_minute(7, rainfall=None),
        at_minute(8, humidity=None),
        at_minute(9, air_temperature=float("nan")),
    ]
    df = staging.stg_weather(table(spark, "weather", rows))
    found = values(
        df.withColumn("m", F.minute("weather_timestamp")),
        "m",
        "weather_condition",
        "temperature_difference",
        "rainfall",
    )
    assert found == [
        (1, "normal", 10.0, False),
        (2, "normal", 10.0, False),
        (4, "rainy", 30.0, True),
        (5, "hot_track", 20.0, False),
        (6, "cold", 20.0, False),
        (7, "normal", 10.0, False),
    ]


def test_result_does_not_depend_on_the_order_of_rows(spark, small):
    from trackmill.sources.testdata import RawTables

    laps = RawTables(spark, small)["laps"]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    expected = sorted(map(str, staging.stg_laps(laps).collect()))
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "31")
        shuffled = laps.repartition(7).orderBy(F.rand(3))
        assert sorted(map(str, staging.stg_laps(shuffled).collect())) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
