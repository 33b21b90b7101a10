import pytest

from builders import lap, raw, session, table, values, weather
from trackmill.fixed_values import MODEL_CHECKS
from trackmill.operators import checks
from trackmill.plans import quality
from trackmill.plans.models import Models
from trackmill.plans.suite import ChecksFailed, Watched, check_report, checked, report_of_written


def test_lap_anomalies_in_rule_order(spark):
    rows = [
        lap(None, None, 1, 70.0),
        lap(1, None, None, 70.0),
        lap(1, 1, None, None),
        lap(1, 1, 4, None),
        lap(1, 1, 5, 0.0),
        lap(1, 1, 6, 59.9),
        lap(1, 1, 7, 300.1, is_pit_out_lap=True),
        lap(1, 1, 8, 80.0, is_pit_out_lap=True),
        lap(1, 1, 9, 60.0),
        lap(1, 1, 10, 300.0),
        lap(1, 1, 11, float("nan")),
    ]
    df = quality.dq_lap_anomalies(table(spark, "laps", rows))
    assert [r.anomaly_reason for r in df.collect()] == [
        "missing_session_key",
        "missing_driver_number",
        "missing_lap_number",
        "missing_lap_duration",
        "non_positive_lap_duration",
        "lap_too_short",
        "lap_too_long",
        "pit_out_lap",
        "lap_too_long",
    ]


def test_pressure_between_staging_and_anomaly_limits_is_in_both(spark):
    rows = [
        weather(1, f"2024-03-02 15:0{i}:00", pressure=p)
        for i, p in enumerate([699.0, 700.0, 799.0, 800.0])
    ]
    m = Models(raw(spark, weather=rows))
    assert values(m.stg_weather, "pressure") == [(700.0,), (799.0,), (800.0,)]
    assert values(m.dq_weather_anomalies, "pressure") == [(699.0,), (700.0,), (799.0,)]


def test_weather_reasons(spark):
    broken = [
        {"session_key": None},
        {"date": None},
        *[{m: None} for m in ("air_temperature", "humidity", "wind_speed")],
        {"track_temperature": 91.0},
        {"wind_direction": 360},
        {"wind_direction": None},
    ]
    rows = [{**weather(1), **change} for change in broken]
    df = quality.dq_weather_anomalies(table(spark, "weather", rows))
    assert [r.anomaly_reason for r in df.collect()] == [
        "missing_session_key",
        "missing_timestamp",
        "missing_air_temperature",
        "missing_humidity",
        "missing_wind_speed",
        "invalid_track_temperature",
        "invalid_wind_direction",
    ]


def test_every_check_finds_its_violation(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "z"), (2, None)], "k int, v string")
    parents = spark.createDataFrame([(1,), (None,)], "key int")
    assert values(checks.not_null(df, ["k", "v"]), "column_name", "n_rows") == [("k", 1), ("v", 1)]
    assert values(checks.unique(df, ["k"]), "k", "n_rows") == [(1, 2)]
    assert values(checks.relationships(df, "k", parents, "key"), "k", "n_rows") == [(2, 1)]
    assert values(checks.accepted_values(df, "v", ["a", "b"]), "v", "n_rows") == [("z", 1)]
    twice = df.unionByName(df)
    assert checks.unique(twice, ["k", "v"]).count() == 4


def test_passing_checks_are_empty(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    assert checks.not_null(df, ["k"]).count() == 0
    assert checks.unique(df, ["k"]).count() == 0
    assert checks.relationships(df, "k", df, "k").count() == 0
    assert checks.accepted_values(df, "v", ["a"]).count() == 0


def test_the_suite_has_41_checks(spark):
    m = Models(raw(spark, sessions=[session(1)]))
    report = check_report({name: getattr(m, name) for name in MODEL_CHECKS})
    assert report.count() == 41
    checked(report)


def test_the_gate_names_what_failed(spark):
    m = Models(raw(spark, sessions=[session(1), session(1)], laps=[lap(2, 1, 1, 80.0)]))
    report = check_report({name: getattr(m, name) for name in MODEL_CHECKS})
    with pytest.raises(ChecksFailed) as failure:
        checked(report)
    assert "unique(stg_sessions.session_key): 1" in str(failure.value)
    assert "relationships(stg_laps.session_key): 1" in str(failure.value)


def test_one_pass_counts_what_the_single_checks_find(spark, tmp_path):
    rows = [(k, n, v) for k in (1, 2, 2, None, 7) for n in (1, 1, None) for v in ("a", "z", "y", None)]
    path = str(tmp_path / "child")
    spark.createDataFrame(rows, "k int, n int, v string").write.parquet(path)
    child = spark.read.parquet(path)
    parent = spark.createDataFrame([(1,), (1,), (None,)], "key int")
    models = {"child": child, "parent": parent}
    for unique_rows in ([], [["k", "n"]], [["k", "n", "v"], ["n", "v"]]):
        for one in ([], ["k"], ["n"]):
            for related in ({}, {"k": ("parent", "key")}, {"k": ("parent", "key"), "n": ("parent", "key")}):
                declared = {"not_null": ["k", "v"], "unique": one, "unique_rows": unique_rows, "relationships": related}
                if related:
                    declared["accepted_values"] = {"v": ["a"]}
                found = check_report(models, {"child": declared})
                expected = {("not_null", c, child.filter(f"{c} is null").count()) for c in ("k", "v")}
                for names in [[c] for c in one]:
                    expected.add(("unique", names[0], checks.unique(child, names).count()))
                for names in unique_rows:
                    expected.add(("unique_rows", ", ".join(names), checks.unique(child, names).count()))
                for column in related:
                    orphans = checks.relationships(child, column, parent, "key").collect()
                    expected.add(("relationships", column, sum(r.n_rows for r in orphans)))
                if related:
                    expected.add(("accepted_values", "v", checks.accepted_values(child, "v", ["a"]).count()))
                assert {(r.check_name, r.column_name, r.n_violations) for r in found.collect()} == expected


def test_a_model_is_scanned_once(spark, tmp_path):
    m = Models(raw(spark, sessions=[session(1)]))
    stored = {}
    for name in MODEL_CHECKS:
        getattr(m, name).write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))
    plan = check_report(stored)._jdf.queryExecution().executedPlan().toString()
    # besides, each child looks at its parent's keys, which Spark reads once when it runs
    children = sum(len(declared.get("relationships", {})) for declared in MODEL_CHECKS.values())
    assert plan.count("FileScan parquet") == len(MODEL_CHECKS) + children


def test_nulls_are_counted_while_a_model_is_written(spark, tmp_path):
    rows = spark.createDataFrame([(1, None), (None, None), (2, "x")], "k int, v string")
    suite = {"m": {"not_null": ["k", "v"], "unique": ["k"]}}
    watched = Watched(rows, "m", suite)
    watched.df.write.parquet(str(tmp_path / "m"))
    found = report_of_written(spark, [watched], {"m": spark.read.parquet(str(tmp_path / "m"))}, suite).collect()
    assert {(r.check_name, r.column_name, r.n_violations) for r in found} == {
        ("not_null", "k", 1), ("not_null", "v", 2), ("unique", "k", 0),
    }
