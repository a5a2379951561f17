"""How far a mirror has come: confirmed positions, published tables and relations as last described, kept beside the replicas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell import store
from tidewell.functions import formats
from tidewell.sources import pgoutput

CONFIRMED = "confirmed bigint, at timestamp"
RELATION = f"rel_id bigint, arrival_seq bigint, namespace string, name string, identity string, fields array<{pgoutput.FIELD}>"


@dataclass(frozen=True)
class Slot:
    """What is known of a mirror's progress; ``batch`` is the last acknowledged one, 0 if there is none."""

    exists: bool
    batch: int = 0
    confirmed: int = 0

    def lag(self, end: int) -> str:
        """The bytes of log that are not confirmed, for display."""
        return formats.size_text(max(0, end - self.confirmed))


class Progress:
    """The state of the mirror ``slot`` below ``folder``.

    Every acknowledgement is a folder of its own, written after the rows that
    it covers, so a run that ends early is repeated under the same batch number
    and replaces what it had written.
    """

    def __init__(self, spark: SparkSession, folder: str, slot: str):
        self.spark, self.folder = spark, f"{folder.rstrip('/')}/_mirror/{slot or 'default'}"

    def slot(self) -> Slot:
        path = f"{self.folder}/acknowledged"
        if not store.exists(self.spark, path):
            return Slot(False)
        row = self.spark.read.schema(f"{CONFIRMED}, batch int").parquet(path).agg(F.max(F.struct("batch", "confirmed")).alias("last")).first()["last"]
        return Slot(True, row["batch"], row["confirmed"]) if row else Slot(True)

    def acknowledge(self, batch: int, position: int, relations: DataFrame | None = None) -> None:
        """Confirm all up to ``position``; ``relations`` (RELATION) are described so from here on."""
        if relations is not None:
            last = relations.groupBy("rel_id").agg(F.max_by(F.struct("namespace", "name", "identity", "fields"), "arrival_seq").alias("r"))
            last.select("rel_id", F.lit(-1).cast("long").alias("arrival_seq"), "r.*").write.mode("overwrite").parquet(f"{self.folder}/relations/batch={batch}")
        row = self.spark.range(1).select(F.lit(position).cast("long").alias("confirmed"), F.current_timestamp().alias("at"))
        row.write.mode("overwrite").parquet(f"{self.folder}/acknowledged/batch={batch}")

    def relations(self) -> DataFrame:
        """Relations as they were described up to the confirmed position, for logs that have been trimmed."""
        path = f"{self.folder}/relations/batch={self.slot().batch}"
        if not store.exists(self.spark, path):
            return self.spark.createDataFrame([], RELATION)
        return self.spark.read.schema(RELATION).parquet(path)

    def published(self) -> DataFrame | None:
        """The tables (name) that the mirror had before; None before its first run."""
        path = f"{self.folder}/publication"
        return self.spark.read.schema("name string").parquet(path) if store.exists(self.spark, path) else None

    def publish(self, names: list[str]) -> None:
        self.spark.createDataFrame([(n,) for n in names], "name string").write.mode("overwrite").parquet(f"{self.folder}/publication")
