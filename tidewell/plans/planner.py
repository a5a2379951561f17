"""What to do with each table, from a small table of their statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Estimates up to this many rows are too rough to judge a load by.
JUDGED_ROWS = 1000


def too_few(rows: Column, estimate: Column) -> Column:
    """Whether ``rows`` is below four fifths of an estimate, rounded down; small estimates never say so."""
    return (estimate > JUDGED_ROWS) & (rows < F.floor(estimate * F.lit(0.8)))


def plan(stats: DataFrame) -> DataFrame:
    """``stats`` with reload_reason, action, load and the two columns of the status report.

    ``stats`` has table, table_exists, has_rows, est_rows (negative: unknown),
    max_commit_lsn (0: no change was ever applied), raw_rows and readded, and
    may have source_has_rows for tables whose estimate is not known.
    """
    reload = (
        F.when(F.col("has_rows") & F.col("readded"), "re-added")
        .when(F.col("has_rows") & (F.col("max_commit_lsn") == 0) & too_few(F.col("raw_rows"), F.col("est_rows")), "incomplete load")
    )
    reason, empty = F.col("reload_reason"), ~F.col("has_rows")
    known = F.col("est_rows") > 0
    wanted = empty & ((known | F.col("source_has_rows")) if "source_has_rows" in stats.columns else known)
    action = (
        F.when(reason.isNotNull(), F.concat(F.lit("RELOAD ("), reason, F.lit(")")))
        .when(~F.col("table_exists"), "CREATE + LOAD")
        .when(wanted, "LOAD")
        .when(F.col("has_rows"), "CDC")
        .otherwise("SKIP (empty)")
    )
    shown = F.when(reason.isNotNull(), "STALE").when(~F.col("table_exists"), "—").when(empty, "0").otherwise("✓")
    return stats.withColumn("reload_reason", reload).withColumns(
        {
            "action": action,
            "load": reason.isNotNull() | ~F.col("table_exists") | wanted,
            "source_shown": F.when(F.col("est_rows") >= 0, F.col("est_rows").cast("string")).otherwise("?"),
            "replica_shown": shown,
        }
    )


def load_order(stats: DataFrame) -> DataFrame:
    """Smallest estimate first, then the order of the configuration; one row a table, so one task is enough."""
    return stats.withColumn("place", F.row_number().over(Window.orderBy("est_rows", "ordinal")))


def integrity(stats: DataFrame) -> DataFrame:
    """Tables that were loaded in this run and whether they hold too few rows."""
    return stats.where("loaded").withColumn("suspect", too_few(F.col("raw_rows"), F.col("est_rows")))


def publication_delta(configured: DataFrame, published: DataFrame) -> DataFrame:
    """Configured tables (name) that are not published yet."""
    return configured.join(published, "name", "left_anti")
