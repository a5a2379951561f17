"""Two-pass external shuffle into shards.

Pass 1 scatters records into memory-sized buckets by seeded hashes; Spark's
exchange is the external store between the passes. Pass 2 gives each bucket to
one task, which puts it in Fisher-Yates order and writes it. A shard is the
run of its buckets, so its order is a uniform shuffle of its records.

Shards follow the law ``key``: rendezvous hashing, where a record goes to the
shard with the largest hash of (doc_id, shard). Adding a shard moves only the
records whose new hash is the largest, all of them into the new shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewell.llm import common

BUCKET_BYTES = 32 << 20
MADE = ("size", "shard", "grown_shard", "bucket", "place", "slot")


def rendezvous(key: Column, shards: int, seed: int) -> Column:
    """The shard of 0 to ``shards`` - 1 with the largest hash of (key, shard); a null key is a key too."""
    ranks = [F.struct(F.xxhash64(F.coalesce(key.cast("string"), F.lit("null")), F.lit(seed), F.lit(s)).alias("rank"), F.lit(s).alias("shard")) for s in range(shards)]
    return (F.greatest(*ranks) if shards > 1 else ranks[0])["shard"]


def fisher_yates(n: int, seed: list[int]) -> np.ndarray:
    """A uniform permutation: numpy's shuffle swaps each place with a random one at or below it."""
    order = np.arange(n)
    np.random.default_rng(seed).shuffle(order)
    return order


def shuffle(docs: DataFrame, shards: int, path: str, seed: int = 20, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write ``docs`` to ``path`` in shuffled order, and return what was written.

    Adds ``size`` (UTF-8 bytes of text, null: none, plus 1), ``shard``,
    ``grown_shard`` (with one more shard), ``bucket`` and ``place`` in the
    bucket. Rows with one doc_id share a shard; equal texts do not. Repeated
    rows are all kept. Null doc_ids are one key. Columns of the names made here,
    and ``_order``, are replaced or dropped. An empty table writes no rows. The
    number of buckets follows the bytes of the table, so a bucket's memory does
    not grow; only rows that agree in doc_id and text must share a bucket, and
    a text larger than a bucket is held whole with what else falls into its
    own.
    """
    docs = docs.drop(*MADE, "_order")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    total = docs.agg(F.sum(size)).first()[0] or 0
    per_shard = max(1, -(-total // (shards * bucket_bytes)))
    buckets = shards * per_shard
    shard = rendezvous(F.col("doc_id"), shards, seed)
    grown = rendezvous(F.col("doc_id"), shards + 1, seed)
    within = F.pmod(F.xxhash64(F.lit(seed + 1), F.col("doc_id"), F.col("text")), F.lit(per_shard))
    scattered = docs.withColumns({"size": size, "shard": shard, "grown_shard": grown}).withColumn("bucket", (F.col("shard") * per_shard + within).cast("long"))

    def pass_two(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        del held
        # Rows arrive in any order; sorting by content first makes the result the same in every run.
        key = np.asarray(rows.column("_order"))
        bucket = np.asarray(rows.column("bucket"))
        ranked = np.lexsort((key, bucket))
        edges = np.flatnonzero(np.diff(bucket[ranked], prepend=-1))
        names = [n for n in rows.column_names if n != "_order"] + ["place"]
        for own in np.split(ranked, edges[1:]):
            own = own[fisher_yates(len(own), [seed, int(bucket[own[0]])])]
            for i in range(0, len(own), 2000):
                part = rows.take(pa.array(own[i : i + 2000])).drop_columns("_order")
                part = part.append_column("place", pa.array(np.arange(i, i + part.num_rows)))
                yield from part.select(names).combine_chunks().to_batches()

    keyed = scattered.withColumn("_order", F.xxhash64("doc_id", "text"))
    dealt = keyed.repartitionById(int(buckets), F.col("bucket").cast("int"))
    schema = StructType([*scattered.schema, *StructType().add("place", "long")])
    dealt.mapInArrow(pass_two, schema).write.parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def slots(shuffled: DataFrame) -> DataFrame:
    """Add ``slot``, the gapless place in the shard: the sizes of a shard's earlier buckets plus ``place``."""
    counts = shuffled.groupBy("shard", "bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("bucket"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return shuffled.join(starts, "bucket").withColumn("slot", F.col("_start") + F.col("place")).drop("_start")


def shard(docs: DataFrame, shards: int = 16, seed: int = 20, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """:func:`shuffle` into a fresh folder below the shared one."""
    return shuffle(docs, shards, common.scratch(docs.sparkSession, "shards"), seed, bucket_bytes)
