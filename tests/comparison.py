"""Run a catalogue query and its SQL on the same files and compare them, whatever the row order."""

from __future__ import annotations

import math
import os

import duckdb

DATA = "/root/testdata"


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in sorted(os.listdir(sf_dir)):
        con.sql(f"create view {name.removesuffix('.parquet')} as select * from '{sf_dir}/{name}'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def rows_of(columns, rows):
    """Sorted columns; rows as a sorted list of tuples."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    tuples = [tuple(normal(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(tuples, key=repr)


def spark_rows(df):
    return rows_of(df.columns, df.collect())


def duck_rows(con, sql):
    relation = con.sql(sql)
    return rows_of(relation.columns, relation.fetchall())
