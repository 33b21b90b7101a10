"""Raw timing tables derived from the star-schema test tables (see FIXTURES.md).

The injected NULLs, blanks, repeats and out-of-range values come from the key columns, so
the tables are dirty in the same way at every scale.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession, functions as F

from trackmill.operators.groups import first_per_key
from trackmill.schemas import columns

Source = Callable[[str], DataFrame]

DRIVERS = 20


def sessions(source: Source) -> DataFrame:
    """A session for every hundred order keys, described by the first order of them."""
    numbered = source("orders").withColumn("hundred", F.expr("o_orderkey div 100"))
    orders = first_per_key(numbered, ["hundred"], [F.col("o_orderkey")])
    # nation and region have a fixed 25 and 5 rows at every scale
    places = F.broadcast(
        source("nation").join(
            source("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
    )
    return orders.join(places, F.expr("n_nationkey = o_custkey % 25")).selectExpr(
        "cast(o_orderkey div 100 as int) as session_key",
        """case when o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM') then 'Race'
                when o_orderpriority = '4-NOT SPECIFIED' then 'Sprint'
                else 'Qualifying' end as session_name""",
        "case when o_orderpriority = '5-LOW' then 'Qualifying' else 'Race' end as session_type",
        "o_orderdate as date_start",
        """case when o_orderkey % 1300 = 0 then null
                else o_orderdate + make_dt_interval(0, 0, 0, 7200) end as date_end""",
        "'00:00:00' as gmt_offset",
        "n_name as location",
        "r_name as country_name",
        "substr(r_name, 1, 3) as country_code",
        "cast(n_nationkey as int) as circuit_key",
        "n_name as circuit_short_name",
        "cast(year(o_orderdate) as int) as year",
    )


def drivers(source: Source) -> DataFrame:
    """Every supplier stands for the entry of its key's remainder; the first one describes it."""
    entries = (
        source("orders")
        .selectExpr("cast(o_orderkey div 100 as int) as session_key")
        .distinct()
        .withColumn("number", F.explode(F.sequence(F.lit(0), F.lit(DRIVERS - 1))))
    )
    remainder = source("supplier").withColumn("entry", F.expr(f"s_suppkey % {DRIVERS}"))
    # at most one row for each of the entries of a session
    suppliers = F.broadcast(first_per_key(remainder, ["entry"], [F.col("s_suppkey")]))
    return entries.join(suppliers, F.col("number") == F.col("entry")).selectExpr(
        "cast(entry + 1 as int) as driver_number",
        "session_key",
        "upper(s_name) as broadcast_name",
        """case when entry = 7 and session_key % 5 = 0 then null
                else concat('  ', s_name, ' ') end as full_name""",
        """case when entry = 9 then null
                else concat('D', lpad(cast(entry + 1 as string), 2, '0')) end as name_acronym""",
        """case when entry = 3 and session_key % 7 = 0 then '   '
                else concat('TEAM_', cast(s_nationkey % 10 as string), ' ') end as team_name""",
        "lpad(cast(s_nationkey * 1111 as string), 6, '0') as team_colour",
        """case when entry % 4 = 0 then null
                else concat('C', cast(s_nationkey as string)) end as country_code""",
        "concat('img/', cast(entry as string)) as headshot_url",
    )


def laps(source: Source) -> DataFrame:
    return source("lineitem").selectExpr(
        """case when l_partkey % 401 = 0 then null
                else cast(l_orderkey div 100 as int) end as session_key""",
        """case when l_partkey % 307 = 0 then null
                else cast(l_suppkey % 20 + 1 as int) end as driver_number""",
        "case when l_partkey % 211 = 0 then null else cast(l_quantity as int) end as lap_number",
        """case when l_partkey % 97 = 0 then null
                when l_partkey % 199 = 0 then cast(-1 as double)
                when l_partkey % 89 = 0 then cast(60 as double)
                when l_partkey % 101 = 0 then cast(300 as double)
                else l_extendedprice / 300 end as lap_duration""",
        "l_extendedprice / 1000 as duration_sector_1",
        "l_extendedprice / 900 as duration_sector_2",
        "case when l_linenumber = 7 then null else l_extendedprice / 800 end as duration_sector_3",
        "cast(200 + l_quantity as double) as i1_speed",
        "cast(210 + l_quantity as double) as i2_speed",
        "cast(220 + l_quantity as double) as st_speed",
        """case when l_linestatus = 'O' and l_returnflag = 'R' then true
                when l_linestatus = 'O' then null else false end as is_pit_out_lap""",
        """case when l_partkey % 53 = 0 then null
                else l_shipdate + make_dt_interval(0, 0, 0, l_orderkey) end as date_start""",
    )


def _timing_events(source: Source) -> DataFrame:
    events = source("events").select("event_id", "user_id", "value", "ts")
    # every ninth event is sent again later
    times_sent = F.when(F.col("event_id") % 9 == 0, F.array(F.lit(0), F.lit(1)))
    return (
        events.withColumn("resent", F.explode(F.coalesce(times_sent, F.array(F.lit(0)))))
        .withColumn("id", F.col("event_id") * 2 + F.col("resent"))
        .withColumn("value", F.col("value") + F.col("resent"))
    )


def pit_stops(source: Source) -> DataFrame:
    return _timing_events(source).selectExpr(
        "cast(id as bigint) as id",
        "cast(event_id div 67 as int) as session_key",
        "cast(user_id % 20 + 1 as int) as driver_number",
        "cast(event_id % 50 as int) as lap_number",
        "case when event_id % 83 = 0 then null else value * 3 / 2 end as pit_duration",
        "case when event_id % 91 = 0 then null else ts end as date",
    )


def positions(source: Source) -> DataFrame:
    return _timing_events(source).selectExpr(
        "cast(id as bigint) as id",
        "cast(event_id div 67 as int) as session_key",
        "cast(user_id % 20 + 1 as int) as driver_number",
        "ts as date",
        """case when event_id % 87 = 0 then null
                else cast(floor(value) % 32 as int) end as position""",
    )


def weather(source: Source) -> DataFrame:
    return source("orders").selectExpr(
        "cast(o_orderkey as bigint) as id",
        """case when o_custkey % 79 = 0 then null
                else cast(o_orderkey div 100 as int) end as session_key""",
        "case when o_custkey % 71 = 0 then null else o_orderdate end as date",
        """case when o_custkey % 59 = 0 then null
                when o_custkey % 83 = 0 then cast(-25 as double)
                else o_totalprice / 8000 end as air_temperature""",
        """case when o_custkey % 89 = 0 then null
                else o_totalprice / 8000 + o_custkey % 35 end as track_temperature""",
        "case when o_custkey % 61 = 0 then null else cast(o_custkey % 104 as double) end as humidity",
        """case when o_custkey % 67 = 0 then null
                else cast(690 + o_orderkey % 420 as double) end as pressure""",
        """case when o_custkey % 73 = 0 then null
                else cast(o_custkey % 107 as double) end as wind_speed""",
        "case when o_custkey % 11 = 0 then null else cast(o_custkey % 365 as int) end as wind_direction",
        """case o_orderstatus when 'P' then true when 'F' then false end as rainfall""",
    )


TABLES = {
    "sessions": sessions,
    "drivers": drivers,
    "laps": laps,
    "pit_stops": pit_stops,
    "positions": positions,
    "weather": weather,
}


class RawTables(dict):
    """The derived tables by name. Each is derived, and each file opened, when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.source = cache(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

    def __missing__(self, name: str) -> DataFrame:
        self[name] = TABLES[name](self.source)
        return self[name]


# --- landing payloads made of the same rows ------------------------------------------------


def _wire_value(df: DataFrame, name: str):
    """A column the way the wire carries it: times as ISO text in UTC, rain as 0 or 1."""
    kind = df.schema[name].dataType.simpleString()
    if kind == "timestamp_ntz":
        return F.concat(F.translate(F.col(name).cast("string"), " ", "T"), F.lit("+00:00"))
    return F.col(name).cast("int") if name == "rainfall" else F.col(name)


def payloads(raw: DataFrame, table: str, request: str = "session_key") -> DataFrame:
    """Every row as a payload of one record, requested by its own key. NULL fields are left out."""
    names = columns(table)
    record = F.to_json(F.struct(*[_wire_value(raw, n).alias(n) for n in names]))
    return raw.select(
        F.concat(F.lit("["), record, F.lit("]")).alias("payload"),
        F.col(request).alias("_requested"),
        F.lit("derived").alias("_path"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("_modified"),
    )


def damaged_payloads(weather_rows: DataFrame) -> DataFrame:
    """Payloads of which some are cut short, not arrays, or hold something other than objects."""
    record = F.to_json(F.struct("id", "pressure"))
    return weather_rows.select(
        "id",
        F.when(F.col("pressure").isNull(), F.concat(F.lit("["), record))
        .when(F.col("humidity").isNull(), record)
        .when(F.col("wind_speed").isNull(), F.concat(F.lit("["), record, F.lit(", null]")))
        .when(F.col("session_key").isNull(), F.concat(F.lit("["), record, F.lit(", 7]")))
        .otherwise(F.concat(F.lit("["), record, F.lit("]")))
        .alias("payload"),
    )
