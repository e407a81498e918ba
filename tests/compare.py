"""Rows of a Spark query and of DuckDB SQL in a common form."""

import math
import os

import duckdb
import pandas as pd


def duck(folder):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for name in os.listdir(folder):
        con.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{folder}/{name}'")
    return con


def plain(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return "~"
    if isinstance(value, float):
        return f"{value:.9g}"
    return str(int(value)) if hasattr(value, "__index__") and not isinstance(value, bool) else str(value)


def rows(frame):
    frame = frame[sorted(frame.columns)]
    # whole numbers in columns that pandas made floats for their nulls read alike on both sides
    return sorted(tuple(plain(v) for v in r) for r in frame.itertuples(index=False))
