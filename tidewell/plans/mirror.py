"""A mirror run and a diff run, from configuration to result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell import model
from tidewell.config import Config
from tidewell.functions import lsn
from tidewell.operators import diff, load, merge
from tidewell.plans import planner
from tidewell.sources.tables import Replica, Source, check_key, has_rows
from tidewell.streaming import drain
from tidewell.streaming.position import Progress

STATS = "table string, ordinal int, table_exists boolean, has_rows boolean, est_rows bigint, max_commit_lsn bigint, raw_rows bigint, readded boolean, source_has_rows boolean"


def gather(spark: SparkSession, config: Config, source: Source, replica: Replica, readded: set[str] = frozenset()) -> DataFrame:
    """Statistics of the configured tables, one row each. The source is only looked into where it has no estimate."""
    rows = []
    for i, t in enumerate(config.tables):
        there = replica.exists(t.name)
        top, raw = (None, 0)
        if there:
            top, raw = replica.read(t.name).agg(F.max(f"{model.VERSION}.commit_lsn"), F.count("*")).first()
        estimate = source.estimated_rows(t.name)
        rows.append((t.name, i, there, bool(raw), estimate, top, raw, t.name in readded, estimate > 0 or (estimate < 0 and not raw and has_rows(source.read(t.name)))))
    return spark.createDataFrame(rows, STATS)


def readded_tables(spark: SparkSession, config: Config, progress: Progress) -> set[str]:
    """Configured tables that an earlier run of the mirror did not have."""
    published = progress.published()
    if published is None:
        return set()
    configured = spark.createDataFrame([(t.name,) for t in config.tables], "name string")
    return {r["name"] for r in planner.publication_delta(configured, published).collect()}


def mirror(spark: SparkSession, config: Config, relations: dict[str, model.Relation], log: str, batch: int | None = None, after: int = 0, readded: set[str] = frozenset()) -> dict:
    """Take the target position, plan, load what is missing, drain the log to the target, and check the loads.

    A run goes on from the position that the last one confirmed, as the next
    batch; one that ended early is repeated under its number. With ``batch``
    the run applies the log after ``after`` as that batch and confirms nothing.
    Keys are checked for the tables that are loaded.
    """
    source, replica = Source(spark, config.source), Replica(spark, config.destination.path)
    progress = Progress(spark, config.destination.path, config.mirror_name)
    slot, given = progress.slot(), batch is not None
    batch, after = (batch, after) if given else (slot.batch + 1, slot.confirmed)
    target = drain.target_position(drain.frames(spark, log))
    readded = set(readded) | readded_tables(spark, config, progress)
    planned = planner.load_order(planner.plan(gather(spark, config, source, replica, readded))).orderBy("place").collect()
    todo = [(r["table"], relations[r["table"]].rel_id, r["est_rows"]) for r in planned if r["load"]]
    keys = {t.name: list(t.key) for t in config.tables}
    for t, *_ in todo:
        check_key(source.read(t), keys[t])
    loads = load.load_all(todo, lambda t, rel, est: load.load_table(source, replica, t, rel, est), config.settings.parallel_loads)
    progress.publish([t.name for t in config.tables])
    report: dict = {}
    applied = drain.drain(spark, log, replica, relations, target, batch, after, {t for t, *_ in todo}, progress.relations(), report)
    described = report.pop("relations", None)
    if not given and target > slot.confirmed:
        progress.acknowledge(batch, target, described)
    stats = gather(spark, config, source, replica).withColumn("loaded", F.col("table").isin([t for t, *_ in todo]))
    suspects = [r["table"] for r in planner.integrity(stats).where("suspect").collect()]
    shown = {"slot": {"exists": slot.exists, "confirmed": lsn.format(slot.confirmed), "lag": slot.lag(target)}, "batch": batch}
    return {"target": target, "actions": {r["table"]: r["action"] for r in planned}, "loads": loads, "applied": applied, "suspects": suspects, **shown, **report}


def follow(spark: SparkSession, config: Config, relations: dict[str, model.Relation], log: str, checkpoint: str) -> None:
    """Mirror what arrives in ``log`` until ``timeout_secs`` have gone by: a run every ``flush_interval_secs`` in which frames came.

    The stream only tells that there is something new; every run takes whole
    transactions from the confirmed position on.
    """
    arrived = drain.run(drain.frames(spark, log, stream=True).select("lsn_end"), lambda *_: mirror(spark, config, relations, log), checkpoint, config.settings.flush_interval_secs)
    arrived.awaitTermination(config.settings.timeout_secs)
    arrived.stop()


def compare(spark: SparkSession, config: Config) -> list[diff.Result]:
    """The diff of every configured table at its level."""
    source, replica = Source(spark, config.source), Replica(spark, config.destination.path)

    def of(t):
        def run() -> diff.Result:
            raw = replica.read(t.name) if replica.exists(t.name) else None
            live = merge.current(raw, list(t.key)) if raw is not None else None
            return diff.diff_table(t.name, t.level, source.read(t.name), live, list(t.key), lambda: source.estimated_rows(t.name), lambda: raw.count())

        return run

    return diff.run([(t.name, of(t)) for t in config.tables], {t.name: t.level for t in config.tables})
