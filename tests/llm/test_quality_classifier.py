import math

import numpy as np
from pyspark.sql import functions as F

from tidewell.llm import quality_classifier as qc
from tidewell.llm import common, queries, wordhash
from tidewell.llm.wordhash import WordHasher


def test_recovers_ordered_thresholds():
    rng = np.random.default_rng(1)
    n = 4000
    x = rng.normal(size=(n, 3))
    latent = x @ [2.0, -1.0, 0.0] + rng.logistic(size=n)
    grades = np.digitize(latent, [-1.0, 0.5, 2.0])
    rows, columns = np.repeat(np.arange(n), 3), np.tile(np.arange(3), n)
    w, cuts = qc.fit_ordinal(rows, columns, x.ravel(), grades, 4, 3, l2=0, rounds=600)
    assert np.abs(w - [2, -1, 0]).max() < 0.2 and np.abs(cuts - [-1, 0.5, 2]).max() < 0.2
    tail = qc.tails(x @ w, cuts)
    assert (np.diff(tail, axis=1) <= 0).all()
    for k in range(3):
        assert abs(tail[:, k].mean() - (grades > k).mean()) < 0.03


def test_features_do_not_depend_on_neighbours():
    texts = [b"One two two", b"", b"### $$$ a|b", "äöü äöü".encode()]
    rows, columns, values = qc.features(texts, WordHasher())
    for i, t in enumerate(texts):
        alone = qc.features([t], WordHasher())
        mine = rows == i
        assert dict(zip(columns[mine].tolist(), values[mine].tolist(), strict=True)) == dict(zip(alone[1].tolist(), alone[2].tolist(), strict=True))


def test_edges(spark, edges, nothing):
    unlearned = qc.train(spark.createDataFrame([], "text string, grade int"), 3)
    rows = qc.rate(edges.withColumn("p_tail", F.lit("x")), unlearned).collect()
    assert len(rows) == 9 and all(r["p_tail"] > 0.99 and r["expected_grade"] > 1.99 for r in rows)
    assert qc.rate(nothing, unlearned).count() == 0


def test_long_text_has_the_features_of_its_whole(monkeypatch):
    rng = np.random.default_rng(4)
    text = b" ".join(rng.choice([b"One", b"two", b"\n", b"### |", "äöü".encode(), b"x" * 50, b"\n\n"], 4000))
    whole = qc.features([text], WordHasher())
    for size in (64, 997):
        monkeypatch.setattr(qc, "CHUNK_BYTES", size)
        monkeypatch.setattr(wordhash, "CHUNK_BYTES", size)
        parts = qc.features([text], WordHasher())
        assert np.array_equal(whole[1], parts[1]) and np.allclose(whole[2], parts[2], atol=1e-12)


def test_loss_and_slope_are_those_of_the_definition():
    rng = np.random.default_rng(2)
    n, width, levels = 40, 5, 4
    dense = rng.normal(size=(n, width))
    rows, columns = np.repeat(np.arange(n), width), np.tile(np.arange(width), n)
    grades, x = rng.integers(0, levels, n), np.concatenate((rng.normal(size=width), [-0.7], rng.normal(size=levels - 2)))
    value, slope = qc.loss(x, rows, columns, dense.ravel(), grades, width, 0.1)

    def by_definition(x):
        cuts = [x[width]]
        for step in x[width + 1 :]:
            cuts.append(cuts[-1] + math.exp(step))
        total = 0.0
        for row, g in zip(dense, grades, strict=True):
            below = [1 / (1 + math.exp(-(c - row @ x[:width]))) for c in cuts]
            total -= math.log(([*below, 1.0][g]) - ([0.0, *below][g]))
        return total / n + 0.05 * float(x[:width] @ x[:width])

    assert abs(value - by_definition(x)) < 1e-12
    for i, own in enumerate(slope):
        ahead, back = x.copy(), x.copy()
        ahead[i], back[i] = x[i] + 1e-5, x[i] - 1e-5
        assert abs(own - (by_definition(ahead) - by_definition(back)) / 2e-5) < 1e-8


def test_query_is_the_model_applied_to_every_document(spark):
    """Expected grade and tail of the query, recomputed one document at a time; and accuracy on labels that no fit has seen."""
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    weights, cuts = qc.train(qc.graded(docs, labels), levels=3)
    found = {r["doc_id"]: r for r in queries.op5_quality_classifier(spark, sf).collect()}
    assert len(found) == docs.count()
    hasher = WordHasher()
    for r in docs.where("doc_id % 50 = 7").collect():
        _, columns, values = qc.features([(r["text"] or "").encode()], hasher)
        score = float(weights.astype(np.float32)[columns] @ values)
        tail = [1 - 1 / (1 + math.exp(-(c - score))) for c in cuts]
        own = found[r["doc_id"]]
        assert abs(own["p_tail"] - tail[0]) < 1e-4 and abs(own["expected_grade"] - sum(tail)) < 1e-4
    unseen = [r for r in labels.where(common.held_out(F.col("doc_id"))).collect() if r["doc_id"] in found]
    right = np.mean([found[r["doc_id"]]["kept"] == (r["quality"] == 1) for r in unseen])
    assert len(unseen) > 200 and right > 0.95
