"""Rows of Spark and DuckDB in one form."""

import decimal
import glob
import math
import os

import duckdb


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, decimal.Decimal):
        return round(float(value), 9)
    if isinstance(value, dict):
        return tuple(map(plain, value.values()))
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return value


def in_order(columns, rows):
    at = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(plain(row[k]) for k in at) for row in rows), key=lambda r: [(x is None, str(x)) for x in r])


def by_sql(folder, sql):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    return columns, result.fetchall()
