"""A third of all rows in one group: the results equal a plain computation in pandas."""

import pytest

from builders import driver, session, table
from trackmill.operators.merging import replace_by_key
from trackmill.plans import marts, staging
from trackmill.plans.models import Models
from trackmill.schemas import columns

ROWS = 30_000


@pytest.fixture(scope="module")
def skewed(spark):
    """Laps of 50 sessions; every third lap belongs to session 1, of those half to driver 1."""
    return (
        spark.range(0, ROWS, 1, 6)
        .selectExpr(
            "cast(if(id % 3 = 0, 1, id % 50) as int) as session_key",
            "cast(if(id % 6 = 0, 1, id % 20) as int) as driver_number",
            "cast(if(id % 3 = 0, id % 4001, id % 40) as int) as lap_number",
            "60.5 + (id * 7919 % 23000) / 100.0D as lap_duration",
            "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 31 % 977)"
            " as date_start",
            "id % 11 = 0 as is_pit_out_lap",
        )
        .selectExpr(
            *[
                c if c in ("session_key", "driver_number", "lap_number", "lap_duration",
                           "date_start", "is_pit_out_lap")
                else f"cast(null as double) as {c}"
                for c in columns("laps")
            ]
        )
    )


@pytest.fixture(scope="module")
def expected(skewed):
    laps = skewed.toPandas()
    laps = laps[(laps.lap_duration > 60) & (laps.lap_duration < 300) & ~laps.is_pit_out_lap]
    laps = laps.sort_values(["date_start", "lap_duration"], ascending=[False, True])
    return laps.drop_duplicates(["session_key", "driver_number", "lap_number"])


def as_set(frame):
    return set(map(tuple, frame.itertuples(index=False, name=None)))


def test_deduplication(skewed, expected):
    names = ["session_key", "driver_number", "lap_number", "lap_duration"]
    found = staging.stg_laps(skewed).select(*names).toPandas()
    assert len(found) == len(expected) and as_set(found) == as_set(expected[names])


def test_best_lap_per_session(spark, skewed, expected):
    entries = [driver(s, d) for s in range(50) for d in range(20)]
    drivers = staging.stg_drivers(table(spark, "drivers", entries))
    best = expected.sort_values(["lap_duration", "lap_number", "driver_number"])
    best = best.drop_duplicates("session_key")
    narrow = staging.timed_laps(skewed, ["lap_duration"])
    found = marts.session_fastest_lap(narrow, drivers).toPandas()
    want = {(s, f"Driver {d}", n) for s, d, n in as_set(
        best[["session_key", "driver_number", "lap_number"]]
    )}
    assert as_set(found[["session_key", "fastest_lap_driver", "fastest_lap_number"]]) == want


def test_ranking(spark, skewed, expected):
    entries = [driver(s, d) for s in range(50) for d in range(20)]
    races = [session(s, circuit_short_name="Hot" if s % 3 else "Other") for s in range(50)]
    empty = {n: table(spark, n, []) for n in ("pit_stops", "weather", "positions")}
    models = Models({
        "sessions": table(spark, "sessions", races),
        "drivers": table(spark, "drivers", entries),
        "laps": skewed,
        **empty,
    })
    laps = expected.assign(circuit=["Hot" if s % 3 else "Other" for s in expected.session_key])
    best = laps.groupby(["circuit", "driver_number"]).lap_duration.min().reset_index()
    best["rank"] = best.groupby("circuit").lap_duration.rank(method="min").astype(int)
    found = models.fastest_laps.select(
        "circuit_short_name", "driver_number", "fastest_lap_sec", "rank_on_circuit"
    ).toPandas()
    assert as_set(found) == as_set(best)


def test_replacing_the_hot_session_keeps_every_other_row(skewed):
    new = skewed.filter("session_key = 1").limit(5)
    found = replace_by_key(skewed, new, "session_key")
    others = skewed.filter("session_key <> 1").count()
    assert found.count() == others + 5
