"""Canonical text of keys, equal wherever equal keys are stored, and its hash."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class UnsupportedKeyType(ValueError):
    """A key column whose text could differ between two stores."""


def canonical(column: Column, kind: str) -> Column:
    """Text of a key column of a Spark type. Dates and times are cut to seconds and clamped to the end of 2299, numerics to whole numbers."""
    if kind in ("tinyint", "smallint", "int", "bigint", "string") or kind.startswith(("varchar", "char")):
        return column.cast("string")
    if kind == "date":
        return F.date_format(F.least(column, F.lit("2299-12-31").cast("date")), "yyyy-MM-dd")
    if kind in ("timestamp", "timestamp_ntz"):
        return F.date_format(F.least(column, F.lit("2299-12-31 00:00:00").cast(kind)), "yyyy-MM-dd HH:mm:ss")
    if kind.startswith("decimal"):
        return column.cast("bigint").cast("string")
    if kind == "boolean":
        return F.when(column, F.lit("1")).when(~column, F.lit("0"))
    raise UnsupportedKeyType(f"{kind} cannot be part of a compared key")


def key_columns(df: DataFrame, key: list[str]) -> list[Column]:
    kinds = dict(df.dtypes)
    return [canonical(F.col(k), kinds[k]) for k in key]


def hash32(columns: list[Column]) -> Column:
    """The low 32 bits of the MD5 of the joined key text, as a long."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *columns)), 25, 8), 16, 10).cast("long")


def same_key(left: DataFrame, right: DataFrame, key: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in key])
