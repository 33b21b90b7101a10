from pyspark.sql import functions as F

from builders import driver, lap, pit, position, raw, session, table, values, weather
from trackmill.functions.expressions import lap_time
from trackmill.operators.groups import rank_within
from trackmill.plans import marts, staging
from trackmill.plans.models import Models


def test_lap_time_format(spark):
    df = spark.createDataFrame([(119.9996,), (61.0,), (60.5004,), (299.9994,)], "s double")
    found = [r[0] for r in df.select(lap_time(F.col("s"))).collect()]
    assert found == ["1:60.000", "1:01.000", "1:00.500", "4:59.999"]


def test_sprints_are_not_races(spark):
    m = Models(raw(spark, sessions=[session(1), session(2, session_name="Sprint")]))
    assert values(m.race_sessions, "session_key") == [(1,)]


def test_final_position_is_the_same_from_clean_and_deduplicated_rows(spark):
    rows = [
        position(1, 1, 9, "2024-03-02 15:00:00", id=1),
        position(1, 1, 4, "2024-03-02 16:00:00", id=2),
        position(1, 1, 3, "2024-03-02 16:00:00", id=3),
        position(1, 1, 99, "2024-03-02 17:00:00", id=4),
    ]
    positions = table(spark, "positions", rows)
    for source in (staging.clean_positions(positions), staging.stg_positions(positions)):
        assert values(marts.final_positions(source), "final_position") == [(3,)]


def test_driver_who_changes_team_has_two_rows(spark):
    m = Models(
        raw(
            spark,
            sessions=[session(1), session(2)],
            drivers=[driver(1, 7), driver(2, 7, team_name="Other")],
            positions=[position(1, 7, 1), position(2, 7, 4)],
        )
    )
    names = ["team_name", "races", "avg_finish", "wins", "podiums", "points_finishes"]
    assert values(m.driver_performance, *names) == [
        ("Other", 1, 4.0, 0, 0, 1),
        ("Team", 1, 1.0, 1, 1, 1),
    ]


def test_average_lap_is_the_mean_of_race_means(spark):
    laps = [lap(1, 7, n, 100.0) for n in range(1, 5)] + [lap(2, 7, 1, 80.0)]
    m = Models(
        raw(
            spark,
            sessions=[session(1), session(2)],
            drivers=[driver(1, 7), driver(2, 7)],
            positions=[position(1, 7, 1), position(2, 7, 1)],
            laps=laps,
        )
    )
    assert values(m.driver_performance, "avg_lap_time", "best_lap") == [(90.0, 80.0)]
    assert values(m.team_comparison, "avg_lap_time_sec", "best_lap_time_sec") == [(90.0, 80.0)]


def test_equal_best_laps_share_a_rank(spark):
    m = Models(
        raw(
            spark,
            sessions=[session(1)],
            drivers=[driver(1, n) for n in (1, 2, 3)],
            laps=[lap(1, 1, 5, 70.0), lap(1, 2, 6, 70.0), lap(1, 3, 7, 71.0), lap(1, 4, 8, 65.0)],
        )
    )
    # driver 4 is not on the entry list and drops out before the ranking
    found = values(m.fastest_laps, "driver_number", "rank_on_circuit", "fastest_lap_fmt")
    assert found == [(1, 1, "1:10.000"), (2, 1, "1:10.000"), (3, 3, "1:11.000")]


def test_rank_keeps_groups_without_a_name(spark):
    rows = [(None, 2.0), (None, 1.0), ("a", 5.0)]
    df = rank_within(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", "r")
    assert sorted((r.v, r.r) for r in df.collect()) == [(1.0, 1), (2.0, 2), (5.0, 1)]


def test_fastest_lap_of_a_season_prefers_the_earlier_lap(spark):
    m = Models(
        raw(
            spark,
            sessions=[session(1), session(2)],
            drivers=[driver(1, 1), driver(2, 1)],
            laps=[lap(1, 1, 9, 70.0), lap(2, 1, 4, 70.0), lap(1, 1, 2, 75.0)],
        )
    )
    assert values(m.fastest_laps, "lap_number", "fastest_lap_sec") == [(4, 70.0)]


def race_with_everything(spark, **changes):
    rows = {
        "sessions": [session(1)],
        "drivers": [driver(1, 1), driver(1, 2)],
        "positions": [position(1, 1, 1), position(1, 2, 2)],
        "laps": [lap(1, 1, 3, 70.1234), lap(1, 2, 4, 71.0)],
        "pit_stops": [pit(1, 1, 10, 20.0), pit(1, 1, 11, 30.0), pit(1, 2, 12, 61.0)],
        "weather": [weather(1), weather(1, "2024-03-02 15:01:00", rainfall=True)],
    }
    return Models(raw(spark, **{**rows, **changes}))


def test_race_summary_row(spark):
    m = race_with_everything(spark)
    row = m.race_summary.collect()[0].asDict()
    assert row["winner_name"] == "Driver 1"
    assert (row["fastest_lap_driver"], row["fastest_lap_number"]) == ("Driver 1", 3)
    assert row["fastest_lap_sec"] == 70.123
    assert (row["total_pit_stops"], row["drivers_with_pit_stops"]) == (2, 1)
    assert (row["avg_pit_duration_sec"], row["slowest_pit_stop_sec"]) == (25.0, 30.0)
    assert row["had_rain"] is True and row["avg_air_temperature"] == 20.0


def test_two_first_places_give_two_rows(spark):
    m = race_with_everything(spark, positions=[position(1, 1, 1), position(1, 2, 1)])
    assert values(m.race_summary, "session_key", "winner_acronym") == [(1, "D1"), (1, "D2")]


def test_fastest_driver_missing_leaves_the_lap_empty(spark):
    m = race_with_everything(spark, laps=[lap(1, 9, 3, 65.0), lap(1, 1, 4, 71.0)])
    assert values(m.race_summary, "fastest_lap_driver", "fastest_lap_sec") == [(None, None)]


def test_race_without_positions(spark):
    m = race_with_everything(spark, positions=[])
    assert m.race_summary.count() == 0
    assert m.weather_analysis.count() == 1


def test_race_without_short_stops(spark):
    m = race_with_everything(spark, pit_stops=[pit(1, 1, 10, 300.0)])
    names = ["total_pit_stops", "drivers_with_pit_stops", "avg_pit_duration_sec"]
    assert values(m.race_summary, *names) == [(0, 0, None)]
    assert m.pit_stop_impact.count() == 0


def test_pit_stop_impact_counts_short_stops_only(spark):
    m = race_with_everything(spark)
    names = ["driver_name", "pit_stop_count", "avg_pit_duration_sec", "total_pit_time_sec"]
    assert values(m.pit_stop_impact, *names, "final_position") == [("Driver 1", 2, 25.0, 50.0, 1)]


def test_a_newer_long_stop_hides_an_older_short_one(spark):
    stops = [pit(1, 1, 10, 20.0, id=1), pit(1, 1, 10, 90.0, id=2)]
    assert race_with_everything(spark, pit_stops=stops).pit_stop_impact.count() == 0


def test_reading_order_puts_unknown_years_first_and_unknown_names_last(spark):
    rows = [(2023, "b"), (None, "a"), (2024, None), (2024, "z")]
    df = spark.createDataFrame(rows, "year int, circuit_short_name string")
    ordered = [tuple(r) for r in marts.in_reading_order(df, "race_summary").collect()]
    assert ordered == [(None, "a"), (2024, "z"), (2024, None), (2023, "b")]
