import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tidewell.llm import multi_index, queries

SCHEMA = "vec_id long, embedding array<float>"


def brute(ids, rows, query_ids, k):
    out = {}
    for i in np.flatnonzero(np.isin(ids, query_ids)):
        score = multi_index.exact(rows[i], rows)
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def found_of(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def test_walk_is_in_order_of_distance():
    rng = np.random.default_rng(0)
    books, query, sizes = rng.normal(size=(2, 6, 4)), rng.normal(size=8), rng.integers(0, 3, 36)
    cells = multi_index.walk(query, books, sizes, int(sizes.sum()))
    far = [-(books[0, c // 6] @ query[:4]) - (books[1, c % 6] @ query[4:]) for c in cells]
    assert sorted(cells) == np.flatnonzero(sizes).tolist() and far == sorted(far)


def test_ties_and_bad_vectors(spark, monkeypatch):
    rng = np.random.default_rng(2)
    good = rng.normal(size=(60, 5)).astype(np.float32)
    good[10:40] = good[10]  # one cell, so that the walk cannot miss a tie
    rows = [(i, v.tolist()) for i, v in enumerate(good)]
    monkeypatch.setattr(multi_index, "TARGET", 1.0)
    bad = [(100, None), (120, []), (140, [0.0] * 5), (160, [1.0, None, 1.0, 1.0, 1.0]), (180, [float("nan")] * 5), (200, [float("inf")] * 5), (220, [1.0]), (None, [1.0] * 5)]
    for kind in ("float", "double"):
        # Bad vectors come first.
        vectors = spark.createDataFrame(bad + rows, SCHEMA.replace("float", kind)).coalesce(1)
        got = found_of(multi_index.search(vectors, vectors.where("vec_id % 20 = 0")))
        assert got == brute(np.arange(60), good.astype(float), [0, 20, 40], 20)


def test_fewer_candidates_than_asked_and_none(spark):
    vectors = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], SCHEMA)
    assert found_of(multi_index.search(vectors, vectors.where("vec_id = 0"))) == {0: [(1, 0.5)]}
    nothing = vectors.where("vec_id < 0")
    assert multi_index.search(nothing, nothing).count() == 0
    assert multi_index.search(vectors, nothing).count() == 0


@pytest.mark.parametrize("copies", [0, 3000])
def test_recall_beyond_a_whole_search(spark, monkeypatch, copies):
    """Cells, shelves and parts at work; a vector of very many copies does not crowd out others."""
    monkeypatch.setattr(multi_index, "SHELF_ROWS", 300)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16))
    rows = (centres[rng.integers(0, 40, 3000)] + 0.3 * rng.normal(size=(3000, 16))).astype(np.float32)
    rows = np.concatenate((rows, np.repeat(rows[:1], copies, 0)))
    ids = np.arange(len(rows))
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], SCHEMA)
    asked = ids[ids % 60 == 0]
    got = found_of(multi_index.search(vectors, vectors.where("vec_id % 60 = 0")))
    want = brute(ids, rows.astype(float), asked, 20)
    least = {q: w[-1][1] for q, w in want.items()}
    hits = sum(s >= least[q] for q in want for _, s in got[q])
    assert hits / (20 * len(want)) >= 0.9 and all(len(got[q]) == 20 for q in want)


@pytest.mark.parametrize("clusters", [0, 300])
def test_recall_at_shipped_constants(spark, tmp_path, clusters):
    """20,000 vectors, random and clustered: recall against brute force, and a walk that is short where the data allow."""
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(20_000, 64))
    if clusters:
        rows = rng.normal(size=(clusters, 64))[rng.integers(0, clusters, 20_000)] + 0.2 * rows
    rows = (rows / np.linalg.norm(rows, axis=1, keepdims=True)).astype(np.float32)
    ids = np.arange(20_000)
    pq.write_table(pa.table({"vec_id": ids, "embedding": pa.array(list(rows), pa.list_(pa.float32()))}), f"{tmp_path}/embeddings.parquet")
    vectors, report = spark.read.parquet(f"{tmp_path}/embeddings.parquet"), {}
    got = found_of(multi_index.search(vectors, vectors.where("vec_id % 100 = 0"), report=report))
    want = brute(ids, rows.astype(float), ids[ids % 100 == 0], 20)
    recall = np.mean([len({v for v, _ in want[q]} & {v for v, _ in got[q]}) / 20 for q in want])
    assert recall >= 0.9 and all(len(got[q]) == 20 for q in want)
    assert all(abs(s - float(rows[q].astype(float) @ rows[v].astype(float))) < 1e-12 for q in got for v, s in got[q])
    assert report["walk"] < (0.1 if clusters else 0.7) * report["entries"]


def test_query_finds_nine_in_ten(spark):
    """The whole query on sf0.01, against brute force."""
    held = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").toPandas()
    ids, rows = held["vec_id"].to_numpy(), np.stack(held["embedding"].to_numpy()).astype(float)
    want = brute(ids, rows, ids[ids % 20 == 0], 20)
    got = found_of(queries.op8_multi_index(spark, "/root/testdata/sf0.01"))
    assert got.keys() == want.keys() and all(len(got[q]) == 20 for q in want)
    assert np.mean([len({v for v, _ in want[q]} & {v for v, _ in got[q]}) / 20 for q in want]) >= 0.9
