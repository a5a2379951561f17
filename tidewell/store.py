"""Tables that a run writes for itself, in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_owned: dict[str, object] = {}


def file_system(spark: SparkSession, path: str) -> tuple:
    """(Hadoop file system, path) of a path of any file system that Spark reaches."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = file_system(spark, path)
    return fs.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    fs, target = file_system(spark, path)
    fs.delete(target, True)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the file system that Spark resolves it on."""
    fs, target = file_system(spark, path)
    return fs.makeQualified(target).toString()


def _remove_own() -> None:
    for path, (fs, target) in _owned.items():
        try:
            fs.delete(target, True)
        except Exception as e:  # the JVM may be gone by now; the folder is then left to its owner
            print(f"{path} was not removed: {type(e).__name__}")


def shared_dir(spark: SparkSession) -> str:
    """The folder of this process below ``spark.checkpoint.dir``, or below the context's checkpoint folder.

    It is removed when the process ends. Where the session names none (tests on
    one machine) a temporary folder is made once and set as the checkpoint folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        found = tempfile.mkdtemp(prefix="tidewell-")
        atexit.register(shutil.rmtree, found, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", found)
        spark.sparkContext.setCheckpointDir(found)
    own = f"{found.rstrip('/')}/tidewell-{spark.sparkContext.applicationId}"
    if own not in _owned:
        if not _owned:
            atexit.register(_remove_own)
        _owned[own] = file_system(spark, own)
    return own


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str, by: list[str] | None = None) -> DataFrame:
    """Write ``df`` below the shared folder, in folders for each value of ``by``, and read it back.

    This cuts the lineage with files that outlive any executor.
    """
    path = scratch(df.sparkSession, name)
    df.write.partitionBy(*by or []).parquet(path)
    read = df.sparkSession.read.schema(df.schema).parquet(path)
    read._tidewell_path = path
    return read


def discard(*tables: DataFrame) -> None:
    """Delete materialised tables that no later step reads, and let Spark drop the shuffle files that led to them."""
    for t in tables:
        remove(t.sparkSession, t._tidewell_path)
    if tables:
        tables[0].sparkSession.sparkContext._jvm.System.gc()


#: A side of a join is broadcast if it has no more rows and, written as text, no more bytes than these.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 16 << 20


def small_or_shuffled(lookup: DataFrame) -> DataFrame:
    """``lookup`` with a broadcast hint if its counted rows and bytes prove it small; a larger one is joined by a shuffle."""
    width = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in lookup.columns])))
    rows, size = lookup.limit(BROADCAST_ROWS + 1).select(width.alias("w")).agg(F.count("*"), F.sum("w")).first()
    return F.broadcast(lookup) if rows <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES else lookup
