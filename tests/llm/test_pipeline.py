import re
from collections import Counter

import corpus_pipeline as cp
from pyspark.sql import functions as F
from test_jaccard_join import brute
from test_packing import JSON
from tokenizers import Tokenizer

from tidewell.llm import common


def written(df):
    return common.materialise(df, "test")


def test_stages_on_real_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    good = written(cp.keep_good(spark, docs, sf_dir))
    assert good.columns == columns and good.count() < docs.count()

    single = written(cp.drop_near_duplicates(spark, good, sf_dir))
    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    want = {d for d, _, c in brute(rows, 5, 80, 100) if d == c}
    assert single.columns == columns and {r["doc_id"] for r in single.collect()} == want

    clean = written(cp.redact_secrets(spark, single, sf_dir))
    assert clean.columns == columns and clean.count() == single.count()
    assert clean.where(F.col("n_chars") != F.length("text")).count() == 0
    assert not any(re.search("[0-9a-f]{24,}|AKIA[A-Z0-9]{16,}", r["text"]) for r in clean.collect())

    mixed = written(cp.mix_sources(spark, clean, sf_dir))
    times = Counter(r["doc_id"] for r in mixed.collect())
    assert mixed.columns == columns and max(times.values()) <= 3

    packed = cp.pack_sequences(spark, mixed, sf_dir)
    model = Tokenizer.from_file(JSON)
    tokens = sum(len(model.encode(r["text"], add_special_tokens=False).ids) + 1 for r in mixed.collect())
    assert packed.agg(F.sum("length")).first()[0] == tokens


def test_rows_without_or_with_shared_ids(spark, edges, sf_dir):
    kept = cp.drop_near_duplicates(spark, edges, sf_dir).collect()
    assert Counter(r["text"] for r in kept)["one two three four five six seven"] == 1 and len(kept) == 7
    assert [r["doc_id"] for r in kept if r["text"] == "one two three four five six seven"] == [1]
    rows = [(5, "a b c d e f"), (None, "a b c d e f"), (6, "a b c d e f"), (6, "g h")]
    kept = cp.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), sf_dir).collect()
    assert sorted(map(tuple, kept)) == [(5, "a b c d e f"), (6, "g h")]


def test_edges_pass_through(spark, edges, nothing, sf_dir):
    empty = written(nothing.withColumn("extra", F.lit(1)))
    docs = written(edges.withColumn("extra", F.lit(1)))
    for name, stage in cp.STAGES:
        before, docs, empty = docs, written(stage(spark, docs, sf_dir)), written(stage(spark, empty, sf_dir))
        assert empty.count() == 0, name
        if name != "packing":
            assert docs.columns == before.columns, name
        if name == "secret_scans":
            assert sorted(map(repr, docs.collect())) == sorted(map(repr, before.collect()))
        if name == "mixing":
            assert all((r["text"] or "").split() for r in docs.collect())
    assert docs.where("length = 0").count() == 0


def test_names():
    assert 4 <= len(cp.STAGES) <= 5 and cp.ORACLE_SQL is None
