"""One query for each corpus operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import jaccard_join, mixing, multi_index, oracles, packing, quality_classifier, quality_rules, secrets, sharding, toxicity, warc
from tidewell.llm.common import held_out, materialise, scratch, table

SHARDS = 16


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(toxicity.labelled_texts(docs, table(spark, sf_dir, "labels"), "toxic"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = sharding.shard(docs, SHARDS)
    digest = rows.select("doc_id", "size", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), "shard", "grown_shard", "bucket", "place")
    return sharding.slots(digest).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = scratch(spark, "blob-ledger")
    # As a ledger is used: a first delivery of about half of all blobs, then all, of which the unseen ones are scanned.
    blobs = secrets.with_blob(docs)
    secrets.update(blobs.where("blob_id < '8'"), ledger)
    secrets.update(blobs, ledger)
    found = secrets.findings(spark, ledger)
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE))
    of_kind = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    counted = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in secrets.BASE]
    digests = found.select("blob_id", *counted, F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"))
    digests = materialise(digests, "secret-digests")
    none = {"n_assign": F.lit(0).cast("long"), "n_access": F.lit(0).cast("long"), "n_hex": F.lit(0).cast("long"), "base_sha256": F.sha2(F.lit(""), 256), "spans": F.lit("")}
    return blobs.select("doc_id", "blob_id").join(digests, "blob_id", "left").select("doc_id", *[F.coalesce(c, v).alias(c) for c, v in none.items()])


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_classifier.train(quality_classifier.graded(docs, table(spark, sf_dir, "labels")), levels=3)
    rated = quality_classifier.rate(docs, model).select("doc_id", "expected_grade", "p_tail")
    return rated.withColumn("kept", F.col("p_tail") >= 0.5)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read(warc.write(table(spark, sf_dir, "pages"), scratch(spark, "warc")))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"), k=3, num=90, den=100)


def op8_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return multi_index.search(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    return quality_rules.rate(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_sharding": op2_sharding,
    "op3_packing": op3_packing,
    "op4_secret_scans": op4_secret_scans,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_warc": op6_warc,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_multi_index": op8_multi_index,
    "op9_mixing": op9_mixing,
    "op10_quality_rules": op10_quality_rules,
}

SQL: dict[str, str] = {
    "op4_secret_scans": oracles.secret_scans(),
    "op6_warc": oracles.warc_records(warc.REVISIT_BYTES),
    "op7_jaccard_join": oracles.similar_documents(3, 90, 100),
    "op10_quality_rules": oracles.quality_verdicts(),
}
