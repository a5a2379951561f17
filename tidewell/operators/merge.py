"""Latest version wins: the current state of an append-only table of versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell import model, store


def latest(rows: DataFrame, key: list[str], version: list[Column | str]) -> DataFrame:
    """For each key the row of the largest version; ``version`` must order the rows of a key fully.

    The rank filter becomes a group limit below the exchange, so a task sends
    one row a key, and predicates on the key reach the scan.
    """
    order = [(F.col(v) if isinstance(v, str) else v).desc() for v in version]
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def current(rows: DataFrame, key: list[str], version: list[Column | str] | None = None, deleted: str = model.IS_DELETED) -> DataFrame:
    """The live rows: latest versions that are no tombstones. Tombstones are only dropped after the collapse."""
    return latest(rows, key, version or [model.VERSION]).where(F.col(deleted) == 0)


def current_columns(rows: DataFrame, key: list[str], columns: list[str], version: Column, deleted: str = model.IS_DELETED) -> DataFrame:
    """As :func:`current` for few columns: one aggregation with partial maxima, no sort."""
    best = F.max_by(F.struct(*columns, F.col(deleted).alias("_d")), version).alias("_best")
    return rows.groupBy(*key).agg(best).where("_best._d = 0").select(*key, *[F.col(f"_best.{c}").alias(c) for c in columns])


def row_counts(rows: DataFrame, key: list[str]) -> DataFrame:
    """raw_rows and current_rows (tombstones counted) of a table of versions, from one aggregation by key."""
    versions = rows.groupBy(*key).count()
    return versions.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("raw_rows"), F.count("*").alias("current_rows"))


def carry_forward(rows: DataFrame, key: list[str], version: list[str], unchanged: dict[str, str], deleted: str | None = None) -> DataFrame:
    """Fill values that an update did not send with the key's last known value.

    ``unchanged`` maps a column to the boolean column that marks such values. A
    sent null counts as a value. A tombstone, a row with 1 in ``deleted``, ends
    a key's history: it keeps its own values and no later row takes one from
    before it.
    """
    life, dead = [], F.lit(False)
    if deleted:
        before = Window.partitionBy(*key).orderBy(*version).rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumn("_life", F.coalesce(F.sum(deleted).over(before), F.lit(0)))
        life, dead = ["_life"], F.col(deleted) == 1
    order = Window.partitionBy(*key, *life).orderBy(*version).rowsBetween(Window.unboundedPreceding, 0)
    filled = {}
    for column, mark in unchanged.items():
        sent = F.when(~F.col(mark) | dead, F.struct(F.col(column).alias("v")))
        filled[column] = F.last(sent, ignorenulls=True).over(order)["v"]
    return rows.withColumns(filled).drop("_life")


def fill_unsent(rows: DataFrame, history: DataFrame, key: list[str], fresh: bool = False) -> DataFrame:
    """``rows`` with the values that updates did not send, from earlier versions of the same source row.

    ``rows`` are the versions of one batch, ``history`` those of the other
    batches. A source row keeps its values when its key changes: the tombstone
    of the old key and the upsert of the new one share commit position and
    ordinal, so a life of a key that begins with such an upsert goes on from the
    life that its tombstone ended. A plain tombstone ends a life. A tombstone
    of a key that has no live row is a life of its own, so a life has one end
    and goes on in one other at most. Values that
    nothing earlier holds stay null and marked. ``fresh``: the snapshot was
    taken after all of ``rows``, so where the log has not sent a value the
    snapshot of the new key goes before that of an old key.
    """
    columns = [c for c in rows.columns if c not in key and not c.startswith(model.META)]
    names = rows.columns
    touched = rows.select(*key).distinct()
    both = rows.withColumn("_mine", F.lit(1)).unionByName(history.join(touched, key, "left_semi").select(*names, F.lit(0).alias("_mine")))
    # A version that another batch holds too is one row; the one with more values is kept.
    same = Window.partitionBy(*key, model.VERSION)
    whole = F.size(F.coalesce(model.UNSENT, F.array()))
    both = both.withColumns({"_rank": F.row_number().over(same.orderBy(whole, "_mine")), "_mine": F.max("_mine").over(same)}).where("_rank = 1").drop("_rank")

    v, dead = F.col(model.VERSION), F.col(model.IS_DELETED) == 1
    by_key = Window.partitionBy(*key).orderBy(model.VERSION)
    ends = both.where(dead).select(v["commit_lsn"].alias("_c"), v["ordinal"].alias("_o"), F.lit(True).alias("_moved")).distinct()
    both = both.join(ends, (v["commit_lsn"] == F.col("_c")) & (v["ordinal"] == F.col("_o")), "left").drop("_c", "_o")
    after_end = F.coalesce(F.lag(model.IS_DELETED).over(by_key) == 1, F.lit(True))
    both = both.withColumn("_start", after_end | (~dead & F.col("_moved").isNotNull())).drop("_moved")
    both = both.withColumn("_life", F.struct(*key, F.last(F.when(F.col("_start"), v), ignorenulls=True).over(by_key).alias("_from")))

    place = lambda deleted, of: both.where(F.col(model.IS_DELETED) == deleted).select(v["commit_lsn"].alias("_c"), v["ordinal"].alias("_o"), F.col("_life").alias(of))
    links = store.materialise(place(0, "_to").join(place(1, "_of"), ["_c", "_o"]).select("_to", "_of"), "lives")
    # Pointer doubling: each round halves the way to the first life of a source row.
    while True:
        ahead = links.select(F.col("_to").alias("_mid"), F.col("_of").alias("_far"))
        farther = links.join(ahead, F.col("_of") == F.col("_mid"), "left").select("_to", F.coalesce("_far", "_of").alias("_of"), F.col("_far").isNotNull().alias("_moved"))
        last, written = links, store.materialise(farther, "lives")
        store.remove(rows.sparkSession, last._tidewell_path)
        moved = not written.where("_moved").isEmpty()
        links = written.drop("_moved")
        links._tidewell_path = written._tidewell_path
        if not moved:
            break
    both = both.join(links, F.col("_life") == F.col("_to"), "left").withColumn("_row", F.coalesce("_of", "_life")).drop("_to", "_of")

    snapshot = v["commit_lsn"] == 0
    through = lambda *by: Window.partitionBy(*by).orderBy(model.VERSION).rowsBetween(Window.unboundedPreceding, 0)
    made, left = {}, []
    for c in columns:
        unsent = F.coalesce(F.array_contains(model.UNSENT, c), F.lit(False))
        known = lambda also, c=c, unsent=unsent: F.when(~unsent & ~dead & also, F.struct(F.col(c).alias("v")))
        sent = F.last(known(~snapshot if fresh else F.lit(True)), ignorenulls=True).over(through("_row"))
        own = F.last(known(snapshot), ignorenulls=True).over(through(*key))
        old = F.last(known(snapshot), ignorenulls=True).over(through("_row"))
        found = F.coalesce(sent, own, old) if fresh else F.coalesce(sent, own)
        made[f"_v_{c}"] = F.when(unsent, found).otherwise(F.struct(F.col(c).alias("v")))
        left.append(F.when(unsent & F.col(f"_v_{c}").isNull(), F.lit(c)))
    filled = both.withColumns(made)
    out = {c: F.col(f"_v_{c}")["v"] for c in columns} | {model.UNSENT: F.array_compact(F.array(*left)) if left else F.array().cast("array<string>")}
    return filled.where("_mine = 1").select(*[out[n].alias(n) if n in out else n for n in names])


def compact(rows: DataFrame, key: list[str], purge: bool = False) -> DataFrame:
    """One version a key, for rewriting a table; ``purge`` drops tombstones too."""
    return current(rows, key) if purge else latest(rows, key, [model.VERSION])
