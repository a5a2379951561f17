"""Draining a change stream up to a fixed position, then stopping."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewell import model, store
from tidewell.operators import bind, merge, normalize
from tidewell.sources import pgoutput
from tidewell.sources.tables import Replica
from tidewell.streaming.position import RELATION

#: Arrival numbers of a block in which transactions are found together.
ARRIVAL_BLOCK = 100_000
FRAMES = "arrival_seq bigint, lsn_start bigint, lsn_end bigint, payload binary"


def frames(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """The log as parquet files of frames, as a batch or as a stream."""
    reader = spark.readStream.option("maxFilesPerTrigger", 64) if stream else spark.read
    return reader.schema(FRAMES).parquet(path)


def target_position(log: DataFrame) -> int:
    """The end of the log now; taken before loads, so changes made during a load stay pending."""
    return log.agg(F.coalesce(F.max("lsn_end"), F.lit(0))).first()[0]


def with_transaction(messages: DataFrame) -> DataFrame:
    """Each change with the commit position, id and time of its transaction and its ordinal in it.

    Transactions arrive one after another, so the last Begin at or before a
    change is its own. It is found inside blocks of arrival numbers; a change
    before the first Begin of its block takes the last one of the blocks before,
    from a table of one row a block. Nothing is ordered as a whole but that.
    """
    block = F.floor(F.col("arrival_seq") / ARRIVAL_BLOCK)
    begin = F.when(F.col("kind") == "B", F.struct(F.col("arrival_seq").alias("from"), "final_lsn", "committed_at", "xid"))
    rows = messages.withColumns({"_block": block, "_begin": begin})
    blocks = rows.groupBy("_block").agg(F.max("_begin").alias("_end"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select("_block", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    own = F.last("_begin", ignorenulls=True).over(Window.partitionBy("_block").orderBy("arrival_seq"))
    rows = rows.withColumn("_own", own).where("kind IN ('I', 'U', 'D', 'T')").join(carried, "_block").withColumn("_begin", F.coalesce("_own", "_carried"))
    kept = [c for c in messages.columns if c not in ("final_lsn", "committed_at", "xid")]
    return rows.where("_begin IS NOT NULL").select(*kept, F.col("_begin.final_lsn").alias("commit_lsn"), F.col("_begin.committed_at").alias("committed_at"), F.col("_begin.xid").alias("xid"), (F.col("arrival_seq") - F.col("_begin.from")).alias("ordinal"))


def bounded(changes: DataFrame, target: int, after: int = 0) -> DataFrame:
    """Whole transactions that commit after ``after`` and up to ``target``."""
    return changes.where((F.col("commit_lsn") > after) & (F.col("commit_lsn") <= target))


class FaultyLog(ValueError):
    """The log up to the target has messages that do not parse."""


def check_faults(messages: DataFrame, target: int, after: int = 0) -> None:
    """Fail on messages with a fault that bear on the changes of ``bounded``.

    Row changes count by their transaction. A Begin counts by its own position,
    and so does a row change with no Begin before it. A relation holds for all
    that follows, so one of before ``after`` counts too.
    """
    faulty = messages.where("fault IS NOT NULL").select("arrival_seq", "kind", "fault")
    if faulty.isEmpty():
        return
    inside = bounded(with_transaction(messages), target, after).where("fault IS NOT NULL")
    outside = messages.where((F.col("fault").isNotNull()) & ~F.col("kind").isin("I", "U", "D", "T") & (F.col("lsn_start") < target) & ((F.col("kind") == "R") | (F.col("lsn_start") >= after)))
    placed = with_transaction(messages).select("arrival_seq")
    alone = messages.where((F.col("fault").isNotNull()) & F.col("kind").isin("I", "U", "D", "T") & F.col("lsn_start").between(after, target - 1)).join(placed, "arrival_seq", "left_anti")
    bad = inside.select("arrival_seq", "kind", "fault").unionAll(outside.select("arrival_seq", "kind", "fault")).unionAll(alone.select("arrival_seq", "kind", "fault"))
    n = bad.count()
    if n:
        first = "; ".join(f"arrival {r['arrival_seq']}, kind {r['kind']}: {r['fault']}" for r in bad.orderBy("arrival_seq").limit(5).collect())
        raise FaultyLog(f"{n} malformed messages up to position {target}: {first}")


def described(changes: DataFrame, messages: DataFrame, relations: dict[str, model.Relation], remembered: DataFrame | None = None) -> DataFrame:
    """``changes`` with the namespace, name, ``shape`` (text) and ``fields`` of their relation as last described before them.

    ``relations`` hold until the log describes them anew, and before them those
    that an earlier run has ``remembered``. Fails on a change of an id that is
    not described.
    """
    row_changes = changes.where(F.col("kind").isin("I", "U", "D")).drop("namespace", "name", "identity", "fields")
    return bind.bind_relations(row_changes, told(messages, relations, remembered).withColumn("shape", F.to_json("fields")))


def told(messages: DataFrame, relations: dict[str, model.Relation], remembered: DataFrame | None = None) -> DataFrame:
    """All descriptions of relations, each from its arrival on."""
    known = [(r.rel_id, -2, r.namespace, r.name, r.identity, [(f.name, f.oid, f.key, f.modifier) for f in r.fields]) for r in relations.values()]
    given = messages.sparkSession.createDataFrame(known, RELATION)
    if remembered is not None:
        given = given.unionByName(remembered)
    return given.unionByName(bind.relations_of(messages))


def shapes_of(bound: DataFrame) -> dict[tuple[str, str], list[tuple[str, tuple[model.Field, ...]]]]:
    """By namespace and name the (shape, fields) that the changes in ``bound`` have, the latest last."""
    rows = bound.groupBy("namespace", "name", "shape").agg(F.max("arrival_seq").alias("last"), F.first("fields").alias("fields")).collect()
    found: dict[tuple[str, str], list] = {}
    for r in sorted(rows, key=lambda r: r["last"]):
        found.setdefault((r["namespace"], r["name"]), []).append((r["shape"], tuple(model.Field(f["name"], f["oid"], f["key"], f["modifier"]) for f in r["fields"])))
    return found


def columns_of(shapes: list[tuple[str, tuple[model.Field, ...]]], kept: dict[str, str]) -> dict[str, str]:
    """Columns and types of a replica that has ``kept``, widened by those that the latest shape adds."""
    return kept | {f.name: model.spark_type(f.oid, f.modifier) for _, fields in shapes[-1:] for f in fields if f.name not in kept}


def changes_of(messages: DataFrame, relation: model.Relation, shapes: list[tuple[str, tuple[model.Field, ...]]] | None = None, columns: dict[str, str] | None = None, any_id: bool = False) -> DataFrame:
    """The typed changes of one relation: op, old, new, key_kind, commit_lsn, ordinal, rel_id, and in unsent the columns that new leaves out.

    With ``shapes`` each change is read by the fields of its own ``shape`` and
    laid out by name as ``columns`` (name: type). A column that a shape lacks is
    unsent if the latest one has it, as it was added later; else it was dropped
    and is null. With ``any_id`` all row changes of ``messages`` are taken as
    the relation's, else those of its id.
    """
    own = messages.where(F.col("kind").isin("I", "U", "D") & (F.lit(any_id) | (F.col("rel_id") == relation.rel_id)))
    shapes = shapes or [("", relation.fields)]
    columns = columns or {f.name: model.spark_type(f.oid, f.modifier) for f in relation.fields}
    latest = {f.name for f in shapes[-1][1]}
    key = {f.name for f in relation.fields if f.key}
    if bad := [fields for _, fields in shapes if not key <= {f.name for f in fields}]:
        raise ValueError(f"key columns of {relation.name} are missing from its description {[f.name for f in bad[0]]}")

    def by_shape(of: Callable[[tuple[model.Field, ...]], Column]) -> Column:
        if len(shapes) == 1:
            return of(shapes[0][1])
        return F.coalesce(*[F.when(F.col("shape") == shape, of(fields)) for shape, fields in shapes])

    def laid_out(cells: str, fields: tuple[model.Field, ...], compact_key: bool = False) -> Column:
        row, names = pgoutput.typed_rows(F.col(cells), fields, compact_key), {f.name for f in fields}
        return F.when(F.col(cells).isNotNull(), F.struct(*[(row[n] if n in names else F.lit(None)).cast(k).alias(n) for n, k in columns.items()]))

    def left_out(fields: tuple[model.Field, ...]) -> Column:
        at = {f.name: i for i, f in enumerate(fields)}
        marks = [F.when(F.get("new", F.lit(at[n]))["tag"] == "u", F.lit(n)) if n in at else F.when(F.col("new").isNotNull(), F.lit(n)) for n in columns if n in at or n in latest]
        return F.array_compact(F.array(*marks)) if marks else F.array().cast("array<string>")

    own = own.withColumns({"new": by_shape(lambda f: pgoutput.text_cells(F.col("new"), f)), "old": by_shape(lambda f: pgoutput.text_cells(F.col("old"), f, compact_key=True))})
    old, new = by_shape(lambda f: laid_out("old", f, compact_key=True)), by_shape(lambda f: laid_out("new", f))
    return own.select(F.col("kind").alias("op"), old.alias("old"), new.alias("new"), "key_kind", "commit_lsn", "ordinal", "rel_id", F.coalesce(by_shape(left_out), F.array()).alias("unsent"))


def drain(spark: SparkSession, log: str, replica: Replica, relations: dict[str, model.Relation], target: int, batch: int, after: int = 0, fresh: set[str] = frozenset(), remembered: DataFrame | None = None, report: dict | None = None) -> dict[str, int]:
    """Apply one bounded run of the log to the replicas of ``relations`` (by table), as batch ``batch``.

    Repeating a run replaces its batch by the same rows. Values that an update
    did not send come from the versions of the other batches and of this one;
    ``fresh`` names tables that were loaded after ``target``. Each change is
    read as its relation was described when it arrived, or before the log in
    ``remembered``; columns that the log adds are added to the replica. Changes
    go to the configured table of their namespace and name, those of an earlier
    incarnation of a table are left out. Malformed messages up to ``target``
    stop the run before anything is written. Returns rows by table.

    ``report`` gets, besides, the changes of tables that are not configured
    (skipped) or of other incarnations (stale), tables whose replica has
    another identity than their relation (mismatched), tables whose updates and
    deletes the source does not log (lost), truncations, which are not applied
    (truncated), the counters of each table (changes) and the relations as they
    are described now (relations).
    """
    if after >= target:
        return {}
    # Decoded and bound once, for the checks and all tables, and written by table.
    messages = store.materialise(pgoutput.decode_frames(frames(spark, log)), "messages")
    check_faults(messages, target, after)
    inside = bounded(with_transaction(messages), target, after)
    expected, mismatched, served = {}, [], {}
    for table, relation in relations.items():
        if replica.exists(table):
            expected[table] = bind.expected_identity(replica.read(table))
            (mismatched.append(table) if expected[table] not in (None, relation.rel_id) else served.update({table: relation}))
    bound = store.materialise(described(inside, messages, relations, remembered), "bound", ["namespace", "name"])
    configured = spark.createDataFrame([(r.namespace, r.name, expected[t] or 0) for t, r in served.items()], "namespace string, name string, expected_id bigint")
    routed = bind.route(bound, configured)
    changes = bind.drop_stale(routed, configured)
    if report is not None:
        report |= reported(messages, inside, bound, routed, changes, configured) | {"mismatched": mismatched, "relations": told(messages, relations, remembered)}
    shapes, applied = shapes_of(changes), {}  # fails before anything is written
    for table, relation in served.items():
        key = [f.name for f in relation.fields if f.key]
        of_table = changes.where((F.col("namespace") == relation.namespace) & (F.col("name") == relation.name))
        own = shapes.get((relation.namespace, relation.name)) or [("", relation.fields)]
        kept = {n: k for n, k in replica.read(table).dtypes if not n.startswith(model.META)}
        columns = columns_of(own, kept)
        replica.widen(table, {n: k for n, k in columns.items() if n not in kept})
        rows = normalize.to_versions(changes_of(of_table, relation, own, columns, any_id=True), key)
        if not rows.where(F.size(model.UNSENT) > 0).isEmpty():
            rows = merge.fill_unsent(rows, replica.read(table, but=batch), key, table in fresh)
        replica.write(table, rows, batch)
        applied[table] = replica.written(table, batch)
    return applied


def reported(messages: DataFrame, inside: DataFrame, bound: DataFrame, routed: DataFrame, changes: DataFrame, configured: DataFrame) -> dict[str, list]:
    """What a run has left out or cannot know, and its counters; a row a table or relation at most."""
    rows = lambda df: [r.asDict() for r in df.collect()]
    other = routed.join(store.small_or_shuffled(configured), ["namespace", "name"]).where("expected_id != 0 AND expected_id != rel_id")
    audited = bind.route(bind.audit_identities(bind.relations_of(messages)).where("changes_lost").distinct(), configured)
    cut = inside.where("kind = 'T'").select(F.explode("truncated").alias("rel_id")).groupBy("rel_id").agg(F.count("*").alias("times"))
    return {
        "skipped": rows(bind.skipped(bound, configured).orderBy("namespace", "name")),
        "stale": rows(other.groupBy("namespace", "name", "rel_id").agg(F.count("*").alias("changes")).orderBy("namespace", "name", "rel_id")),
        "lost": [r["name"] for r in audited.orderBy("name").collect()],
        "truncated": rows(cut.orderBy("rel_id")),
        "changes": rows(normalize.summary(normalize.counters(changes.select(F.col("kind").alias("op"), "old", F.col("name").alias("table"))))),
    }


def run(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str, interval_secs: int | None = None) -> StreamingQuery:
    """Feed micro-batches to ``apply``; without an interval all that is there now, then stop.

    Spark commits a batch's position after ``apply`` returns, so a position is
    never acknowledged before its rows are stored. ``apply`` must replace what
    an earlier try of its batch wrote.
    """
    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": f"{interval_secs} seconds"} if interval_secs else {"availableNow": True}
    return writer.trigger(**trigger).start()


def flush_batches(rows: DataFrame, order: str, size: int) -> DataFrame:
    """Number the flush that each row belongs to when every ``size`` rows in ``order`` are flushed.

    Rows are dealt by ranges of ``order`` and numbered inside a range; only the
    counts of the ranges are put in order as a whole.
    """
    ranged = store.materialise(rows.repartitionByRange(order).withColumn("_range", F.spark_partition_id()), "ranges")
    counts = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(order)) - 1
    numbered = ranged.join(store.small_or_shuffled(starts), "_range").withColumn("_place", place)
    return numbered.withColumn("flush", F.floor((F.col("_start") + F.col("_place")) / F.lit(size))).select(*rows.columns, "flush")
