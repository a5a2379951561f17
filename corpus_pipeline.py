"""The corpus pipeline: from ``documents`` to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept. All but the last return the columns of ``documents``.

In every stage a null text is an empty one, a null doc_id, source or language
is a value like others, repeated rows are rows of their own, and an empty table
gives an empty one. Columns that ``documents`` does not have are passed on, but
for the names that the mixing stage documents as its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import common, jaccard_join, mixing, packing, quality_classifier, secrets

#: Near duplicates share 80 of 100 of their distinct five-word shingles.
SHINGLE_WORDS, SIMILAR = 5, (80, 100)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that are likelier of grade 0 than of a better one.

    Empty texts are judged by what the classifier learned of such. Equal texts
    share their fate.
    """
    labels = common.table(spark, sf_dir, "labels")
    model = quality_classifier.train(quality_classifier.graded(docs, labels), levels=3)
    return quality_classifier.rate(docs, model).where("p_tail >= 0.5").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep of each group of near duplicates the document of the smallest doc_id.

    Documents without words are no duplicates and all stay. Where doc_ids are
    null or repeat, rows are told apart by a row number that is written with
    them; a null doc_id is larger than all others, and of rows with one doc_id
    any one stays.
    """
    repeats = docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").limit(1).count()
    if not repeats:
        groups = jaccard_join.join(docs.select("doc_id", "text"), SHINGLE_WORDS, *SIMILAR)
        return docs.join(groups.where("doc_id != component_id").select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
    rows = common.materialise(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")
    keyed = rows.select(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row").alias("doc_id"), "text")
    groups = jaccard_join.join(keyed, SHINGLE_WORDS, *SIMILAR)
    return rows.join(groups.where("doc_id != component_id").select("doc_id._row"), "_row", "left_anti").select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret in every text by its kind in brackets; no document goes, and a null text stays null."""
    scanned = secrets.scan(docs, common.scratch(spark, "blob-ledger"))
    redacted = scanned.withColumn("_redacted", secrets.redact(F.col("text"), F.col("secret_spans")))
    made = {"text": F.col("_redacted")}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.when(F.size("secret_spans") > 0, F.length("_redacted").cast("long")).otherwise(F.col("n_chars"))
    return redacted.select(*[made[c].alias(c) if c in made else c for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or drop documents so that each source's words meet its target; a document taken n times is n rows.

    Documents without words are never taken. Rows that agree in doc_id and text
    are drawn one by one.
    """
    mixed = mixing.mix(docs, keep=True).where("copies > 0")
    return mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens; each row is a document of its own."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality_classifier", keep_good),
    ("jaccard_join", drop_near_duplicates),
    ("secret_scans", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Training a classifier and packing tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return common.materialise(STAGES[-1][1](spark, docs, sf_dir), f"pipeline-{STAGES[-1][0]}")
