import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tidewell.llm import queries, toxicity


def test_ngrams_do_not_depend_on_chunks(monkeypatch):
    texts = ["Abcdefgh ijkl", "", "xy", "abcdefgh" * 5]
    whole = toxicity.presence(texts)
    monkeypatch.setattr(toxicity, "CHUNK", 7)
    parts = toxicity.presence(texts)
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))
    lengths = [len({t.lower()[i : i + n] for n in toxicity.ORDERS for i in range(len(t) - n + 1)}) for t in texts]
    assert np.bincount(whole[0], minlength=4).tolist() == lengths


def test_learns_a_word(spark, edges):
    rng = np.random.default_rng(0)
    names = ["alpha", "bravo", "carol", "delta", "eagle", "foxes", "grape", "house"]
    rows = []
    for i in range(400):
        words = list(rng.choice(names, 30))
        if i % 5 == 0:
            words[int(rng.integers(30))] = "wretched"
        rows.append((" ".join(words), int(i % 5 == 0)))
    model = toxicity.train(spark.createDataFrame(rows, "text string, label int"))
    scored = model.scores(["carol delta wretched house", "carol delta house", "", "WRETCHED"])
    assert scored[0] > 0.5 > scored[1] and scored[3] > 0.5 > scored[2]
    out = {r["doc_id"]: r["score"] for r in toxicity.score(edges.withColumn("score", F.lit(9)), model).collect()}
    assert len(out) == 8 and all(0 <= s <= 1 for s in out.values()) and out[3] == out[4]


def test_one_class_or_none(spark, nothing):
    none = toxicity.train(spark.createDataFrame([], "text string, label int"))
    assert none.scores(["a"])[0] < 1e-6
    ones = toxicity.train(spark.createDataFrame([("abcd", 1), (None, 1)], "text string, label int"))
    assert ones.scores(["x"])[0] > 0.99
    assert toxicity.score(nothing, none).count() == 0


def test_ties_repeats_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "doc_id long, text string").withColumn("label", F.lit("x")).withColumn("toxic", F.lit("y"))
    labels = spark.createDataFrame([(1, 0), (1, 0), (1, None), (2, 1), (None, 1), (9, 1)], "doc_id long, toxic int")
    found = sorted(map(tuple, toxicity.labelled_texts(docs, labels, "toxic").collect()))
    assert not {1, 2} & {d for d in (1, 2) if zlib.crc32(str(d).encode()) % 5 == 0}
    assert found == [("a", 0), ("a", 0), ("b", 0), ("b", 0), ("c", 1)]
    assert toxicity.labelled_texts(docs.where("doc_id > 9"), labels, "toxic").count() == 0


def test_query_equals_brute_force(spark, sf_dir):
    """The counts, ratios, chosen n-grams and scores of the whole query from Python sets; and accuracy on the fold that no fit has seen."""
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    held = {d: zlib.crc32(str(d).encode()) % 5 == 0 for d in texts}
    rows = [(texts[r["doc_id"]], r["toxic"]) for r in labels.collect() if r["doc_id"] in texts and not held[r["doc_id"]] and r["toxic"] is not None]

    def grams(text):
        return {int(g) for _, part in toxicity.ngrams([text]) for g in part}

    sets = [(grams(t), y) for t, y in rows]
    counts = [Counter(g for own, y in sets if y == c for g in own) for c in (0, 1)]
    model = toxicity.train(toxicity.labelled_texts(docs, labels, "toxic"))
    chosen = set(np.flatnonzero(model.chosen >= 0).tolist())
    n = [sum(y == c for _, y in sets) for c in (0, 1)]

    def g_squared(g):
        both, total = counts[0][g] + counts[1][g], sum(n)
        cells = [(counts[c][g], both * n[c] / total) for c in (0, 1)] + [(n[c] - counts[c][g], (total - both) * n[c] / total) for c in (0, 1)]
        return sum(o * math.log(o / e) for o, e in cells if o)

    strong = {g for g in set(counts[0]) | set(counts[1]) if g_squared(g) >= toxicity.SIGNIFICANT}
    assert (chosen == strong) if len(strong) <= 4096 else (chosen <= strong and len(chosen) == 4096)
    found = {r["doc_id"]: r for r in queries.op1_toxicity(spark, sf_dir).collect()}
    assert found.keys() == texts.keys()
    for d, t in texts.items():
        z = model.bias + sum(model.weights[model.chosen[g]] for g in grams(t) & chosen)
        assert abs(found[d]["score"] - 1 / (1 + math.exp(-max(-35, min(35, z))))) < 1e-9
        assert found[d]["held_out"] == held[d] and found[d]["predicted"] == int(found[d]["score"] >= 0.5)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = queries.op1_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    right = rows.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int"))).first()[0]
    assert right > 0.97
