"""Rows of a Spark query and of its SQL, made comparable."""

import math
from pathlib import Path

import duckdb


def plain(value):
    if isinstance(value, float):
        return round(value, 9) if math.isfinite(value) else str(value)
    if isinstance(value, list):
        return tuple(map(plain, value))
    return value


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)


def sql_rows(sql, sf_dir):
    db = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        db.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    found = db.sql(sql)
    names = sorted(found.columns)
    at = [found.columns.index(n) for n in names]
    return names, sorted((tuple(plain(r[i]) for i in at) for r in found.fetchall()), key=repr)
