from datetime import datetime

import pytest
from pyspark.sql import functions as F

from builders import at, session, table, values
from trackmill.functions.expressions import rounded, truth, utc_timestamp
from trackmill.operators.merging import (
    drop_null_keys,
    latest_in_batch,
    reject_null_keys,
    replace_by_key,
    upsert,
)
from trackmill.operators.selection import (
    facts_for_sessions,
    select_incremental,
    select_sessions,
    valid_seasons,
)

NOW = datetime(2024, 6, 15, 6, 0)


def test_upsert_inserts_updates_and_keeps_the_first_load_time(spark):
    first, second = at("2024-01-01 00:00:00"), at("2024-02-01 00:00:00")
    current = table(
        spark,
        "sessions",
        [session(1, created_at=first), session(2, created_at=first, location="old")],
    )
    batch = table(
        spark,
        "sessions",
        [session(2, created_at=second, location=None), session(3, created_at=second)],
    )
    merged = upsert(current, batch, ["session_key"])
    expected = [(1, first), (2, first), (3, second)]
    assert values(merged, "session_key", "created_at") == expected
    assert merged.filter("session_key = 2").collect()[0].location is None
    again = upsert(merged, batch, ["session_key"])
    assert sorted(map(str, again.collect())) == sorted(map(str, merged.collect()))


def test_replacing_with_nothing_keeps_everything(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    kept = replace_by_key(df, df.filter("false"), "k")
    assert kept.count() == 4
    new = spark.createDataFrame([(1, "new")], "k int, v string")
    assert sorted(r.v for r in replace_by_key(df, new, "k").collect()) == ["c", "d", "new"]


def test_last_record_of_a_batch_wins_whatever_the_partitioning(spark):
    rows = [(1, i, f"v{i}") for i in range(50)]
    df = spark.createDataFrame(rows, "k int, at int, v string").repartition(7)
    assert [r.v for r in latest_in_batch(df, ["k"], [F.col("at").desc()]).collect()] == ["v49"]


def test_null_keys_are_skipped_or_refused(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (1, None)], "a int, b int")
    assert drop_null_keys(df, ["a", "b"]).count() == 1
    assert reject_null_keys(df.filter("a = 1"), ["a"], "drivers").count() == 2
    with pytest.raises(Exception, match="drivers: a record lacks its key"):
        reject_null_keys(df, ["a", "b"], "drivers").count()


def test_window_includes_both_ends(spark):
    ends = ["2024-06-01 06:00:00", "2024-06-01 05:59:59", "2024-06-15 06:00:00",
            "2024-06-15 06:00:01", None]
    rows = [session(i, date_end=at(e) if e else None) for i, e in enumerate(ends)]
    rows.append(session(None, date_end=at(ends[0])))
    rows.append(session(9, date_end=at(ends[0]), year=2023))
    found = select_incremental(table(spark, "sessions", rows), NOW)
    assert values(found, "session_key") == [(0,), (2,)]


def test_window_over_new_year_looks_at_both_seasons(spark):
    rows = [
        session(1, date_end=at("2023-12-30 00:00:00"), year=2023),
        session(2, date_end=at("2024-01-02 00:00:00"), year=2024),
    ]
    found = select_incremental(table(spark, "sessions", rows), datetime(2024, 1, 5))
    assert values(found, "session_key") == [(1,), (2,)]


def test_backfill_takes_unfinished_sessions_of_the_seasons(spark):
    rows = [session(1, year=2023), session(2, year=2024), session(3, year=2022)]
    sessions = table(spark, "sessions", rows)
    assert values(select_sessions(sessions, "backfill", NOW, [2024]), "session_key") == [(2,)]
    in_2025 = datetime(2025, 3, 1)
    assert select_sessions(sessions, "backfill", in_2025).count() == 2


@pytest.mark.parametrize("seasons", [[], "2024", [2022], [2025], [2024.0], [True], None])
def test_bad_seasons_are_refused(seasons):
    with pytest.raises(ValueError):
        valid_seasons(seasons, 2024)


def test_seasons_are_sorted_once_each():
    assert valid_seasons([2024, 2023, 2024], 2024) == [2023, 2024]


def test_unknown_mode_is_refused(spark):
    with pytest.raises(ValueError, match="unknown run mode"):
        select_sessions(table(spark, "sessions", []), "weekly", NOW)


def test_facts_of_selected_sessions(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "session_key int, v string")
    chosen = spark.createDataFrame([(1,), (1,)], "session_key int")
    assert values(facts_for_sessions(facts, chosen), "v") == [("a",)]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_utc_timestamps_do_not_depend_on_the_session_zone(spark, zone):
    texts = {
        "2024-11-03T01:30:00-04:00": at("2024-11-03 05:30:00"),
        "2024-11-03T01:30:00-05:00": at("2024-11-03 06:30:00"),
        "2024-01-01T10:00:00.123456Z": at("2024-01-01 10:00:00.123456"),
        "2024-01-01T10:00:00": at("2024-01-01 10:00:00"),
        "2024-01-01T10:00:00+0200": at("2024-01-01 08:00:00"),
        "2024-01-01": at("2024-01-01 00:00:00"),
        "": None,
    }
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        found = {r.t: r.u for r in df.select("t", utc_timestamp(F.col("t")).alias("u")).collect()}
        with pytest.raises(Exception, match="not a timestamp"):
            spark.range(1).select(utc_timestamp(F.lit("soon"))).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == {**texts, None: None}


def test_rounding_is_half_away_from_zero_and_hides_noise(spark):
    df = spark.createDataFrame([(2.675,), (-2.675,), (0.1 + 0.2,), (1.005,)], "v double")
    found = [r[0] for r in df.select(rounded(F.col("v"), 2)).collect()]
    assert found == [2.68, -2.68, 0.3, 1.01]


def test_truth_of_numbers_and_words(spark):
    df = spark.createDataFrame([("0",), ("1",), ("0.5",), ("true",), ("false",), (None,)], "t string")
    found = [r[0] for r in df.select(truth(F.col("t"))).collect()]
    assert found == [False, True, True, True, False, None]
