"""Source and replica tables: where they lie, what is known of them, and how they are written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewell import model
from tidewell.config import Endpoint
from tidewell.sources import lookups
from tidewell.store import exists, file_system, remove

BATCH = model.META + "batch"
#: The mark of a folder that a rewrite has filled; Spark skips files of such names.
COMPLETE = "_complete"


def has_rows(df: DataFrame) -> bool:
    return not df.isEmpty()


def data_columns(df: DataFrame) -> list[str]:
    """Columns in order, without metadata."""
    return [c for c in df.columns if not c.startswith(model.META)]


class NoKey(ValueError):
    """A table without a usable primary key."""


def check_key(df: DataFrame, key: list[str]) -> None:
    """Fail unless ``key`` is given, not null and unique."""
    if not key:
        raise NoKey("the table has no primary key")
    nulls = df.where(" OR ".join(f"`{k}` IS NULL" for k in key))
    if has_rows(nulls) or has_rows(df.groupBy(*key).count().where("count > 1")):
        raise NoKey(f"{', '.join(key)} is null or repeats")


class Source:
    """Tables of one endpoint: parquet below ``path``, or JDBC where a driver jar is on the class path."""

    def __init__(self, spark: SparkSession, at: Endpoint):
        self.spark, self.at = spark, at

    def read(self, table: str, partition: dict | None = None) -> DataFrame:
        """A full scan; ``partition`` (partitionColumn, lowerBound, upperBound, numPartitions) splits a JDBC read."""
        if self.at.path:
            return self.spark.read.parquet(f"{self.at.path}/{table}.parquet")
        return self._jdbc().option("dbtable", f'"{self.at.schema}"."{table}"').options(**partition or {}).load()

    def query(self, sql: str) -> DataFrame:
        """A statement that the source itself runs; only its result is moved."""
        if self.at.path:
            return self.spark.sql(sql)
        return self._jdbc().option("query", sql).load()

    def _jdbc(self):
        reader = self.spark.read.format("jdbc").option("url", f"jdbc:postgresql://{self.at.host}:{self.at.port}/{self.at.database}")
        return reader.option("user", self.at.user).option("password", self.at.password).option("fetchsize", 10_000)

    def estimated_rows(self, table: str) -> int:
        """Rows by the store's own statistics, -1 if unknown. Parquet footers hold exact counts."""
        if self.at.path:
            return self.read(table).count()
        name = f"{self.at.schema}.{table}".replace("'", "''")
        row = self.query(f"SELECT reltuples::bigint AS n FROM pg_class WHERE oid = '{name}'::regclass").first()
        return row["n"] if row and row["n"] is not None else -1


    def primary_key(self, table: str) -> list[str]:
        """Columns of the primary key by the source's catalogue; parquet tables declare none."""
        if self.at.path:
            return []
        of = f"\"{self.at.schema}\".\"{table}\"".replace("'", "''")
        indexes = self.query(f"SELECT indrelid::bigint AS indrelid, indisprimary, indkey::int[] AS indkey FROM pg_index WHERE indrelid = '{of}'::regclass")
        attributes = self.query(f"SELECT attrelid::bigint AS attrelid, attnum::int AS attnum, attname::text AS attname, atttypid::bigint AS atttypid FROM pg_attribute WHERE attrelid = '{of}'::regclass")
        types = self.query("SELECT oid::bigint AS oid, typname::text AS typname FROM pg_type")
        return [r["name"] for r in lookups.key_columns(indexes, attributes, types).collect()]


class Replica:
    """Append-only tables of versioned rows below a folder, one partition a batch, so a repeated batch replaces itself."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def data(self, table: str) -> str:
        """The folder of a table's rows: the last one that a rewrite has completed, at first ``data-0``."""
        fs, target = file_system(self.spark, self.path(table))
        done = [0]
        for entry in fs.listStatus(target) if fs.exists(target) else []:
            name = entry.getPath().getName()
            if name.startswith("data-") and exists(self.spark, f"{self.path(table)}/{name}/{COMPLETE}"):
                done.append(int(name[5:]))
        return f"{self.path(table)}/data-{max(done)}"

    def exists(self, table: str) -> bool:
        return exists(self.spark, self.path(table) + "/_schema")

    def create(self, table: str, schema: StructType) -> None:
        """An empty table with the source's columns and the metadata columns; the schema is kept beside the data."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        whole = columns + ", " + ", ".join(f"`{n}` {t}" for n, t in model.META_TYPES.items())
        self.spark.createDataFrame([], whole).write.mode("overwrite").parquet(self.path(table) + "/_schema")

    def widen(self, table: str, added: dict[str, str]) -> None:
        """Add columns (name: type) to a table; rows of before have null there."""
        if not added:
            return
        path = self.path(table) + "/_schema"
        schema = self.spark.read.parquet(path).schema
        data = [f for f in schema if not f.name.startswith(model.META)] + [f for n, k in added.items() for f in StructType().add(n, k)]
        whole = StructType([*data, *[f for f in schema if f.name.startswith(model.META)]])
        self.spark.createDataFrame([], whole).write.mode("overwrite").parquet(path)

    def read(self, table: str, but: int | None = None) -> DataFrame:
        """All versions, as stored. Rows of before ``_tw_rel_id`` existed have 0 there, those of before ``_tw_unsent`` null. Without the rows of batch ``but``."""
        schema = self.spark.read.parquet(self.path(table) + "/_schema").schema
        for name in (model.REL_ID, model.UNSENT):
            if name not in schema.names:
                schema = StructType([*schema, *StructType().add(name, model.META_TYPES[name])])
        path = self.data(table)
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(StructType([*schema, *StructType().add(BATCH, "long")])).parquet(path)
        rows = rows.where(F.col(BATCH) != F.lit(but)).drop(BATCH) if but is not None else rows.drop(BATCH)
        return rows.withColumn(model.REL_ID, F.coalesce(model.REL_ID, F.lit(0).cast("long")))

    def write(self, table: str, rows: DataFrame, batch: int) -> None:
        """Put ``rows`` in place of the batch's earlier rows. Columns are matched by name."""
        schema = self.spark.read.parquet(self.path(table) + "/_schema").schema
        ordered = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])
        ordered.write.mode("overwrite").parquet(f"{self.data(table)}/{BATCH}={batch}")

    def written(self, table: str, batch: int) -> int:
        """Rows of a batch, from the footers of its files."""
        path = f"{self.data(table)}/{BATCH}={batch}"
        return self.spark.read.parquet(path).count() if exists(self.spark, path) else 0

    def register(self, database: str, keys: dict[str, list[str]]) -> None:
        """Create the database if it is missing, and in it a view of the current rows of each table (with its key)."""
        quoted = lambda name: "`" + name.replace("`", "``") + "`"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")
        for table, key in keys.items():
            columns = ", ".join(quoted(c) for c in data_columns(self.read(table)))
            by = ", ".join(map(quoted, key))
            ranked = f"SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {model.VERSION} DESC) AS _rank FROM parquet.{quoted(self.data(table))}"
            self.spark.sql(f"CREATE OR REPLACE VIEW {quoted(database)}.{quoted(table)} AS SELECT {columns} FROM ({ranked}) WHERE _rank = 1 AND {model.IS_DELETED} = 0")

    def truncate(self, table: str) -> None:
        path = self.data(table)
        for batch in self._entries(path):
            if batch.startswith(BATCH):
                remove(self.spark, f"{path}/{batch}")

    def _entries(self, path: str) -> list[str]:
        fs, target = file_system(self.spark, path)
        return [e.getPath().getName() for e in fs.listStatus(target)] if fs.exists(target) else []

    def rewrite(self, table: str, change: Callable[[DataFrame], DataFrame], batch: int = 0) -> None:
        """Replace all rows by ``change`` of them.

        They are written to a new folder, which counts from the moment on that
        its mark is there; so a rewrite that ends early leaves the table as it
        was, and the old folder goes last.
        """
        old = self.data(table)
        fresh = f"{self.path(table)}/data-{int(old.rpartition('-')[2]) + 1}"
        remove(self.spark, fresh)
        change(self.read(table)).write.parquet(f"{fresh}/{BATCH}={batch}")
        fs, mark = file_system(self.spark, f"{fresh}/{COMPLETE}")
        fs.create(mark).close()
        remove(self.spark, old)
