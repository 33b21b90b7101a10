"""Spark schemas of the raw tables, built from the fixed column lists."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from trackmill.fixed_values import DIMENSION_KEYS, RAW_COLUMNS


def columns(table: str) -> list[str]:
    return list(RAW_COLUMNS[table])


def nothing(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """No rows of a schema, in a form that Spark knows to be empty when it plans."""
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def raw_schema(table: str) -> T.StructType:
    """The table as stored: its columns plus the values stamped at load time."""
    fields = [f"{name} {kind}" for name, kind in RAW_COLUMNS[table].items()]
    if table not in DIMENSION_KEYS:
        fields.insert(0, "id bigint")
    return T.StructType.fromDDL(", ".join([*fields, "created_at timestamp_ntz"]))


def wire_ddl(table: str) -> str:
    """One record as JSON carries it: numbers and flags as such, times as text.

    Whole numbers may arrive as 44.0 and rain as 0, 1, false or true.
    """
    wire = {"int": "double", "timestamp_ntz": "string"}
    kinds = {n: wire.get(kind, kind) for n, kind in RAW_COLUMNS[table].items()}
    if "rainfall" in kinds:
        kinds["rainfall"] = "string"
    return ", ".join(f"{name} {kind}" for name, kind in kinds.items())


def text_ddl(table: str) -> str:
    """One record with every field as text, to be cast later so that bad values can be told apart."""
    return ", ".join(f"{name} string" for name in RAW_COLUMNS[table])
