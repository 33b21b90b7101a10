"""Queries through storage on a cluster whose shared folders are mounts with plain paths."""

import pytest
from pyspark.sql import functions as F

from trackmill.plans.registry import QUERIES
from trackmill.sources.tables import work_folder


class Session:
    """As much of a session as the choice of a folder reads."""

    def __init__(self, **named):
        self.conf = {key.replace("_", "."): value for key, value in named.items()}


@pytest.fixture
def on_cluster(spark, monkeypatch):
    """The local session, taken for one of a cluster."""
    monkeypatch.setattr(spark.sparkContext, "master", "spark://cluster:7077")
    return spark


@pytest.mark.parametrize("folder", ["/mnt/shared", "file:///mnt/shared", "s3a://lake/work"])
def test_the_checkpoint_folder_is_taken_as_named(folder):
    assert work_folder(Session(spark_checkpoint_dir=folder), "file:/warehouse/work") == folder


def test_the_fallback_is_taken_where_no_folder_is_named():
    assert work_folder(Session(), "file:/warehouse/work") == "file:/warehouse/work"


def test_stored_tables_are_written_and_read_on_a_cluster(on_cluster, small):
    stops = QUERIES["stored_replace_pit_stops"](on_cluster, small)
    drivers = QUERIES["stored_upsert_drivers"](on_cluster, small)
    assert stops.filter(F.col("session_key").isNotNull()).count() > 0
    assert drivers.groupBy("session_key", "driver_number").count().filter("count > 1").count() == 0
    assert drivers.count() > 0


def test_models_are_published_on_a_cluster(on_cluster, small):
    assert QUERIES["published_check_report"](on_cluster, small).count() == 41
