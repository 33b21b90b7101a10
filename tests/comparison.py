"""Run a registered query and its SQL on the same tables and compare the rows."""

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def kind(name):
    """Type names of both engines in common words."""
    name = name.lower()
    words = {
        "string": "varchar",
        "int": "integer",
        "timestamp_ntz": "timestamp",
        "timestamp_us": "timestamp",
        "timestamp_ns": "timestamp",
    }
    return words.get(name, name)


def cell(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return "<null>"
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def differences(df, con, sql):
    """Empty when columns, types and rows agree."""
    found = []
    result = con.execute(sql)
    described = {d[0]: kind(str(d[1])) for d in result.description}
    expected = result.fetchall()
    types = {f.name: kind(f.dataType.simpleString()) for f in df.schema.fields}
    if types != described:
        wrong = {c: (types.get(c), described.get(c)) for c in {*types, *described}
                 if types.get(c) != described.get(c)}
        found.append(f"columns: {wrong}")
    if set(types) != set(described):
        return found
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    theirs = rows_of(list(described), expected)
    if len(ours) != len(theirs):
        found.append(f"rows: {len(ours)} != {len(theirs)}")
    if ours != theirs:
        extra = set(ours) - set(theirs)
        missing = set(theirs) - set(ours)
        found.append(f"only here {sorted(extra)[:3]}, only in SQL {sorted(missing)[:3]}")
    return found
