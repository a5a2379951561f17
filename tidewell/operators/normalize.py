"""Row changes as versioned rows: upserts and tombstones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell import model


def sparse_tombstone(row: Column, kinds: dict[str, str], key: list[str]) -> Column:
    """The row of a delete that carries its key alone: other columns take their type's default."""
    return F.struct(*[(row[c] if c in key else model.default(k)).alias(c) for c, k in kinds.items()])


def to_versions(changes: DataFrame, key: list[str]) -> DataFrame:
    """Versioned rows of ``changes``.

    ``changes`` has op (I, U or D), old and new (structs of the table's columns
    or null), key_kind (K: old holds the key alone, O: a full row), commit_lsn,
    ordinal (arrival in its transaction) and rel_id. An insert is an upsert. An
    update that carries an old row is a tombstone of that and then an upsert;
    a delete is a tombstone. Versions are (commit_lsn, ordinal, part), so a
    repeated run makes the same rows and no global order is needed.

    An optional ``unsent`` names the columns that new does not hold. They are
    taken from old where that has them (the key, or a full row); the others
    stay marked, for :func:`merge.fill_unsent`.
    """
    kinds = {f.name: f.dataType.simpleString() for f in changes.schema["new"].dataType}
    old = F.when(F.col("key_kind") == "K", sparse_tombstone(F.col("old"), kinds, key)).otherwise(F.col("old"))
    row = lambda value, part, deleted: F.struct(value.alias("row"), F.lit(part).alias("part"), F.lit(deleted).alias("deleted"))
    unsent = F.col("unsent") if "unsent" in changes.columns else F.array().cast("array<string>")
    has = lambda c: F.col("old").isNotNull() & (F.lit(True) if c in key else F.coalesce(F.col("key_kind") == "O", F.lit(False)))
    new = F.when(F.col("new").isNotNull(), F.struct(*[F.when(F.array_contains(unsent, c) & has(c), F.col("old")[c]).otherwise(F.col("new")[c]).alias(c) for c in kinds]))
    left = F.array_compact(F.array(*[F.when(F.array_contains(unsent, c) & ~has(c), F.lit(c)) for c in kinds]))
    dead, live = row(old, 0, 1), row(new, 1, 0)
    parts = F.when(F.col("op") == "I", F.array(live)).when((F.col("op") == "U") & F.col("old").isNotNull(), F.array(dead, live)).when(F.col("op") == "U", F.array(live)).when(F.col("op") == "D", F.array(dead))
    made = changes.withColumn("_v", F.explode(parts))
    return made.select(
        *[F.col(f"_v.row.{c}").alias(c) for c in kinds],
        F.col("rel_id").cast("long").alias(model.REL_ID),
        F.current_timestamp().alias(model.SYNCED_AT),
        F.col("_v.deleted").alias(model.IS_DELETED),
        model.version(F.col("commit_lsn"), F.col("ordinal"), F.col("_v.part")).alias(model.VERSION),
        F.when(F.col("_v.deleted") == 0, left).otherwise(F.array().cast("array<string>")).alias(model.UNSENT),
    )


def snapshot_rows(table: DataFrame, rel_id: int) -> DataFrame:
    """A full table as versioned rows: version 0, so any logged change wins."""
    return table.withColumns({model.REL_ID: F.lit(rel_id).cast("long"), model.SYNCED_AT: F.current_timestamp(), model.IS_DELETED: F.lit(0), model.VERSION: model.version(0), model.UNSENT: F.array().cast("array<string>")})


def counters(changes: DataFrame, by: str = "table") -> DataFrame:
    """Inserts, updates and deletes by table, and rows to apply; a key-changing update counts as a delete and an update. The total has a null table."""
    rekeyed = (F.col("op") == "U") & F.col("old").isNotNull()
    return changes.rollup(by).agg(
        F.count_if(F.col("op") == "I").alias("inserts"),
        F.count_if(F.col("op") == "U").alias("updates"),
        F.count_if((F.col("op") == "D") | rekeyed).alias("deletes"),
        (F.count("*") + F.count_if(rekeyed)).alias("applied"),
    )


def summary(counted: DataFrame) -> DataFrame:
    """The tables of :func:`counters` that have rows to apply, by name."""
    return counted.where(F.col("table").isNotNull() & (F.col("applied") > 0)).orderBy("table")
