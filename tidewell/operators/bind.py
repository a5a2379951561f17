"""Binding changes to the tables they belong to."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell import model
from tidewell.store import small_or_shuffled

# Labels of replica identities.
IDENTITIES = {"d": "default", "f": "full", "n": "nothing", "i": "index"}


def relations_of(messages: DataFrame) -> DataFrame:
    """The relation descriptions among decoded messages, each valid from its arrival on."""
    return messages.where("kind = 'R'").select("rel_id", "arrival_seq", "namespace", "name", "identity", "fields")


def bind_relations(changes: DataFrame, relations: DataFrame, strict: bool = True) -> DataFrame:
    """Each change with the description of its relation that last arrived before it.

    Both sides have rel_id and arrival_seq; arrival decides, not log position.
    ``strict`` fails on a change without description, else it is dropped.
    """
    order = Window.partitionBy("_rel").orderBy("_from")
    spans = relations.withColumnsRenamed({"rel_id": "_rel", "arrival_seq": "_from"}).withColumn("_to", F.lead("_from").over(order))
    joined = changes.join(small_or_shuffled(spans), (F.col("rel_id") == F.col("_rel")) & (F.col("arrival_seq") >= F.col("_from")) & (F.col("_to").isNull() | (F.col("arrival_seq") < F.col("_to"))), "left")
    if strict:
        missing = F.raise_error(F.concat(F.lit("no description of relation "), F.col("rel_id").cast("string")))
        # Part of a column that every reader needs, so the check is not pruned.
        joined = joined.withColumn("rel_id", F.when(F.col("_rel").isNull(), missing.cast("long")).otherwise(F.col("rel_id")))
    else:
        joined = joined.where("_rel IS NOT NULL")
    return joined.drop("_rel", "_from", "_to")


def route(changes: DataFrame, tables: DataFrame) -> DataFrame:
    """The changes of configured tables (namespace, name)."""
    return changes.join(small_or_shuffled(tables.select("namespace", "name").distinct()), ["namespace", "name"], "left_semi")


def skipped(changes: DataFrame, tables: DataFrame) -> DataFrame:
    """Changes by table that no configuration names, for the report."""
    others = changes.join(small_or_shuffled(tables.select("namespace", "name").distinct()), ["namespace", "name"], "left_anti")
    return others.groupBy("namespace", "name").agg(F.count("*").alias("changes"))


def identities(rows: DataFrame, rel_id: str = model.REL_ID, by: list[str] | None = None) -> DataFrame:
    """ids (how many) and first_id of the relation ids other than 0 that rows carry, by table."""
    return rows.where(F.col(rel_id) != 0).groupBy(*by or []).agg(F.count_distinct(rel_id).alias("ids"), F.min(rel_id).alias("first_id"))


def expected_identity(replica: DataFrame) -> int | None:
    """The one relation id that a replica's rows carry; None accepts all. More than one cannot be told apart."""
    found = identities(replica).first()
    if found["ids"] > 1:
        raise ValueError("the replica has rows of several relation ids; reload it")
    return found["first_id"]


def drop_stale(changes: DataFrame, expected: DataFrame) -> DataFrame:
    """Changes without those of an earlier incarnation of their table.

    ``expected`` (namespace, name, expected_id) has a row a table whose id is
    known; id 0 accepts all.
    """
    known = small_or_shuffled(expected.where("expected_id != 0"))
    joined = changes.join(known, ["namespace", "name"], "left")
    return joined.where("expected_id IS NULL OR expected_id = rel_id").drop("expected_id")


def audit_identities(relations: DataFrame) -> DataFrame:
    """Label of each relation's replica identity, and whether its updates and deletes are lost."""
    labels = F.create_map(*[F.lit(x) for pair in IDENTITIES.items() for x in pair])
    label = F.coalesce(F.try_element_at(labels, F.col("identity")), F.lit("unknown"))
    return relations.select("namespace", "name", label.alias("identity"), (F.col("identity") == "n").alias("changes_lost"))
