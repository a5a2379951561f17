"""Lookups in a source's own catalogue and statistics, as joins of their tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_columns(indexes: DataFrame, attributes: DataFrame, types: DataFrame) -> DataFrame:
    """rel_id, place, name, type and oid of the columns of each primary key, in the order of the index.

    ``indexes`` has indrelid, indisprimary and indkey (numbers of columns),
    ``attributes`` attrelid, attnum, attname and atttypid, ``types`` oid and typname.
    """
    keyed = indexes.where("indisprimary").select("indrelid", F.posexplode("indkey").alias("place", "number"))
    named = keyed.join(attributes, (F.col("attrelid") == F.col("indrelid")) & (F.col("attnum") == F.col("number")))
    typed = named.join(types, F.col("atttypid") == F.col("oid"))
    return typed.select(F.col("indrelid").alias("rel_id"), "place", F.col("attname").alias("name"), F.col("typname").alias("type"), "oid").orderBy("rel_id", "place")


def senders(replication: DataFrame, activity: DataFrame, slot: str) -> DataFrame:
    """pid, state and sent position of the senders that serve ``slot``: those whose statement names it.

    ``replication`` has pid, state and sent_lsn, ``activity`` pid and query.
    """
    serving = activity.where(F.col("query").like(f"%{slot}%") & ~F.col("query").like("%pg_stat_activity%"))
    return replication.join(serving.select("pid"), "pid").select("pid", "state", "sent_lsn")
