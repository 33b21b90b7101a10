"""Shapes of the physical plans that matter at scale."""

import re

import pytest

from trackmill.plans.models import ANOMALIES, MARTS, STAGING, Models
from trackmill.plans.registry import QUERIES
from trackmill.sources.testdata import RawTables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The raw tables as parquet files, the way a cluster reads them."""
    folder = tmp_path_factory.mktemp("raw")
    raw = RawTables(spark, "/root/testdata/sf0.001")
    names = ["sessions", "drivers", "laps", "pit_stops", "weather", "positions"]
    for name in names:
        raw[name].write.parquet(f"{folder}/{name}")
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}


@pytest.fixture
def without_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# queries through storage run their jobs when called; what they return is a plain read
PLANNED = [name for name in QUERIES if not name.startswith(("published_", "stored_", "streamed_"))]


@pytest.mark.parametrize("name", sorted(PLANNED))
def test_no_pairing_of_everything(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


@pytest.mark.parametrize("name", [*STAGING, *MARTS, *ANOMALIES])
def test_no_model_gathers_its_rows_in_one_task(stored, without_broadcast, name):
    assert "Exchange SinglePartition" not in plan(getattr(Models(stored), name))


@pytest.mark.parametrize(
    "name", ["stg_drivers", "stg_laps", "stg_pit_stops", "stg_positions", "stg_weather"]
)
def test_deduplication_limits_each_key_before_the_shuffle(stored, name):
    text = plan(getattr(Models(stored), name))
    kinds = re.findall(r"WindowGroupLimit .*?, row_number\(\), 1, (\w+)", text)
    assert sorted(kinds) == ["Final", "Partial"]
    assert text.count("Exchange") == 1


def test_final_positions_take_one_shuffle_after_a_partial_aggregate(stored):
    text = plan(Models(stored).final_positions)
    assert text.count("Exchange") == 1 and "partial_max" in text


def test_anomalies_do_not_shuffle(stored):
    for name in ANOMALIES:
        assert "Exchange" not in plan(getattr(Models(stored), name))


def test_joins_by_entry_need_no_shuffle_of_their_own(stored, without_broadcast):
    """Positions, drivers and laps are each shuffled once by their own reduction and then meet."""
    text = plan(Models(stored).driver_performance)
    by_entry = re.findall(r"Exchange hashpartitioning\(session_key#\d+, driver_number#\d+, \d+\)", text)
    assert len(by_entry) == 3


def test_races_with_positions_are_a_semi_join(stored):
    assert "LeftSemi" in plan(Models(stored).race_summary)


def test_lap_statistics_read_only_their_columns(stored, capsys):
    Models(stored).driver_lap_stats.explain("formatted")
    text = capsys.readouterr().out
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert {f.split(":")[0] for f in schema.split(",")} == {
        "session_key",
        "driver_number",
        "lap_number",
        "lap_duration",
        "is_pit_out_lap",
        "date_start",
    }
    assert "GreaterThan(lap_duration,60.0)" in text


def test_race_filter_reaches_the_fact_scan_at_scale(spark, stored, without_broadcast):
    """On large facts Spark filters the scan by a Bloom filter of the race sessions."""
    names = [
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold",
    ]
    for name in names:
        spark.conf.set(name, "0")
    try:
        assert "might_contain" in plan(Models(stored).weather_analysis)
    finally:
        for name in names:
            spark.conf.unset(name)
