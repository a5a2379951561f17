import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tidewell.llm import queries, sharding


def slots_of(rows):
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    return by


def test_every_row_has_one_place(spark, edges):
    wide = edges.withColumn("shard", F.lit(-1)).withColumn("slot", F.lit("x"))
    rows = sharding.slots(sharding.shard(wide.drop("slot"), shards=3, bucket_bytes=1 << 17)).collect()
    assert len(rows) == 9 and all(sorted(s) == list(range(len(s))) for s in slots_of(rows).values())
    assert Counter(r["text"] for r in rows) == Counter(r["text"] for r in edges.collect())
    assert {r["size"] for r in rows if r["text"] is None} == {1}


def test_a_new_shard_takes_rows_only_into_itself(spark):
    ids = spark.range(3000)
    rows = ids.select(*[sharding.rendezvous(F.col("id"), n, 1).alias(f"s{n}") for n in (16, 17)]).collect()
    moved = [r for r in rows if r["s16"] != r["s17"]]
    assert all(r["s17"] == 16 for r in moved) and 100 < len(moved) < 260
    assert min(Counter(r["s16"] for r in rows).values()) > 120


def test_shuffles_are_uniform_and_repeat():
    first = Counter(int(sharding.fisher_yates(5, [s])[0]) for s in range(3000))
    assert min(first.values()) > 500
    assert (sharding.fisher_yates(50, [1, 2]) == sharding.fisher_yates(50, [1, 2])).all()
    assert (np.sort(sharding.fisher_yates(50, [3])) == np.arange(50)).all()


def test_query_repeats_and_empty_table(spark, sf_dir, nothing):
    key = lambda: sorted(map(tuple, queries.op2_sharding(spark, sf_dir).collect()))
    assert key() == key()
    assert sharding.slots(sharding.shard(nothing)).count() == 0


def test_query_equals_brute_force(spark, sf_dir):
    """Sizes, checksums, shards by the largest hash, and slots by a shuffle of each shard, all made one row at a time."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    ranks = F.array(*[F.xxhash64(F.col("doc_id").cast("string"), F.lit(20), F.lit(s)) for s in range(17)])
    rows = [(r["doc_id"], (r["text"] or "").encode(), r["ranks"], r["key"]) for r in docs.select("*", ranks.alias("ranks"), F.xxhash64("doc_id", "text").alias("key")).collect()]
    want, shards = {}, {}
    for doc, text, rank, key in rows:
        shard, grown = max(range(16), key=lambda s: rank[s]), max(range(17), key=lambda s: rank[s])
        want[doc] = [len(text) + 1, zlib.crc32(text), "key", shard, None, grown]
        shards.setdefault(shard, []).append((key, doc))
    for shard, own in shards.items():
        # Small shards are one bucket each.
        own = [d for _, d in sorted(own)]
        for slot, at in enumerate(sharding.fisher_yates(len(own), [20, shard])):
            want[own[at]][4] = slot
    found = queries.op2_sharding(spark, sf_dir).collect()
    assert {r["doc_id"]: [r[c] for c in ("size", "text_crc32", "law", "shard", "slot", "grown_shard")] for r in found} == want


def test_columns_of_clashing_names_and_texts_beyond_a_bucket(spark):
    docs = spark.createDataFrame([(i, "word " * (5000 if i == 3 else 5)) for i in range(20)], "doc_id long, text string")
    for name in (*sharding.MADE, "_order"):
        docs = docs.withColumn(name, F.lit("mine"))
    rows = sharding.slots(sharding.shard(docs, shards=2, bucket_bytes=100)).collect()
    assert len(rows) == 20 and all(sorted(s) == list(range(len(s))) for s in slots_of(rows).values())
    assert len({r["bucket"] for r in rows}) > 2
