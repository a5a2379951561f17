"""Source against replica, at three levels of cost."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions import keys

#: Groups of each kind that a report lists.
LISTED = 20


def count_ratio(source: Column, replica: Column) -> Column:
    """Replica rows for each source row; 1 where the source has none or its estimate is unknown."""
    return F.when(source > 0, replica / source).otherwise(F.lit(1.0))


def counts_match(source: Column, replica: Column, strict: bool = False) -> Column:
    """Whether an estimate fits: the ratio is 0.8 to 1.2, or the source's estimate is not positive (``strict``: then only an empty replica fits)."""
    fits = count_ratio(source, replica).between(0.8, 1.2)
    return F.when(source > 0, fits).otherwise((replica == 0) if strict else F.lit(True))


def exact_counts(source: DataFrame, replica: DataFrame) -> DataFrame:
    """Rows of both sides (s, r) and whether they agree, in one row."""
    both = source.select(F.lit(1).alias("a"), F.lit(0).alias("b")).unionAll(replica.select(F.lit(0), F.lit(1)))
    counts = both.agg(*[F.coalesce(F.sum(x), F.lit(0)).cast("long").alias(n) for x, n in (("a", "s"), ("b", "r"))])
    return counts.withColumn("matches", F.col("s") == F.col("r"))


def grouped(rows: DataFrame, key: list[str]) -> DataFrame:
    """By canonical text of the first key column: rows, and a sum of key hashes that no order changes.

    Grouping by text, not by raw value, keeps two values of equal text in one group.
    """
    columns = keys.key_columns(rows, key)
    return rows.select(columns[0].alias("lead"), keys.hash32(columns).alias("h")).groupBy("lead").agg(F.count("*").alias("n"), F.sum("h").alias("h"))


def compare_keys(source: DataFrame, replica: DataFrame, key: list[str]) -> DataFrame:
    """lead, source_rows, replica_rows and status of each group; both sides are aggregated before they meet."""
    left = grouped(source, key).withColumnsRenamed({"n": "source_rows", "h": "_h1"})
    right = grouped(replica, key).withColumnsRenamed({"n": "replica_rows", "h": "_h2"})
    status = (
        F.when(F.col("replica_rows").isNull(), "source_only")
        .when(F.col("source_rows").isNull(), "dest_only")
        .when(F.col("source_rows") != F.col("replica_rows"), "count_mismatch")
        .when(F.col("_h1") != F.col("_h2"), "hash_mismatch")
        .otherwise("match")
    )
    joined = left.join(right, "lead", "full_outer").withColumn("status", status)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return joined.select("lead", zero("source_rows"), zero("replica_rows"), "status")


def summarise(compared: DataFrame) -> DataFrame:
    """Groups and rows by status, in one row."""
    out = [F.count_if(F.col("status") == s).alias(f"{s}_groups") for s in ("match", "source_only", "dest_only", "count_mismatch", "hash_mismatch")]
    lost = F.coalesce(F.sum(F.when(F.col("status") == "source_only", F.col("source_rows"))), F.lit(0)).cast("long").alias("source_only_rows")
    extra = F.coalesce(F.sum(F.when(F.col("status") == "dest_only", F.col("replica_rows"))), F.lit(0)).cast("long").alias("dest_only_rows")
    return compared.agg(*out, lost, extra)


def top_mismatches(compared: DataFrame, listed: int = LISTED) -> DataFrame:
    """The first ``listed`` groups of each mismatch by key text in byte order, and how many more there are."""
    order = Window.partitionBy("status").orderBy("lead")
    bad = compared.where("status != 'match'")
    first = bad.withColumn("place", F.row_number().over(order)).where(F.col("place") <= listed)
    total = bad.groupBy("status").agg(F.count("*").alias("_n"))
    return first.join(F.broadcast(total), "status").select("status", "place", "lead", "source_rows", "replica_rows", F.greatest(F.col("_n") - listed, F.lit(0)).alias("more"))


@dataclass(frozen=True)
class Result:
    """Outcome for a table: Match, Mismatch or Error, with a line of detail."""

    table: str
    level: str
    status: str
    detail: str


def diff_table(table: str, level: str, source: DataFrame, replica: DataFrame | None, key: list[str], estimate: Callable[[], int], raw_rows: Callable[[], int], strict: bool = False) -> Result:
    """Compare one table. Only what ``level`` needs is computed; ``replica`` holds live rows, None if it does not exist."""
    if replica is None:
        return Result(table, level, "Error", "the replica does not exist")
    if level == "metadata_count":
        expected, found = estimate(), raw_rows()
        ratio = found / expected if expected > 0 else 1.0
        fine = 0.8 <= ratio <= 1.2 if expected > 0 else (not strict or found == 0)
        return Result(table, level, "Match" if fine else "Mismatch", f"estimated {expected}, replica {found}, ratio {ratio:.3f}")
    if level == "exact_count":
        row = exact_counts(source, replica).first()
        return Result(table, level, "Match" if row["matches"] else "Mismatch", f"source {row['s']}, replica {row['r']}")
    row = summarise(compare_keys(source, replica, key)).first()
    bad = {k: row[f"{k}_groups"] for k in ("source_only", "dest_only", "count_mismatch", "hash_mismatch")}
    detail = ", ".join(f"{n} {k}" for k, n in bad.items()) + f" groups; {row['source_only_rows']} rows missing, {row['dest_only_rows']} extra"
    return Result(table, level, "Mismatch" if any(bad.values()) else "Match", detail)


def run(tables: list[tuple[str, Callable[[], Result]]], level_of: dict[str, str]) -> list[Result]:
    """Each table's result; an error in one table does not stop the others."""
    found = []
    for name, compare in tables:
        try:
            found.append(compare())
        except Exception as e:  # noqa: BLE001
            found.append(Result(name, level_of.get(name, ""), "Error", str(e).splitlines()[0][:300]))
    return found


def exit_status(results: list[Result]) -> int:
    return int(any(r.status != "Match" for r in results))
