"""Approximate nearest neighbours by inner product: an inverted multi-index.

Each half of a vector is quantised by a codebook of its own, so k + k centroids
make k * k cells (Babenko and Lempitsky, 2012). A query orders the centroids of
each half by distance, walks the pairs of centroids by their summed distance
with a heap until the cells passed hold enough entries, and reranks the entries
of these cells by exact inner products. Distance is the negative inner product.

How many entries are enough is measured, for tables of every size: a bounded
sample of queries is searched by brute force in one scan, and the walk is made
as long as ``TARGET`` of their true neighbours need. Random vectors in many
dimensions need a large share of all entries, clustered ones a small one.

Cells are gathered into shelves of about SHELF_ROWS entries; a larger cell is
dealt by hash over several shelves. Entries and queries meet by shelf, where
one matrix product scores them. A shelf that very many queries visit is copied
for parts of them. All tables on the driver are bounded by k * k.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm import common

#: Rows that the codebooks are fitted on; a centroid stands for ROWS_A_CENTROID of them at least.
FIT_ROWS = 20_000
ROWS_A_CENTROID = 10
TEST_QUERIES = 100
TARGET = 0.95
ENTRIES_A_CELL = 32
SHELF_ROWS = 4096
SHELF_QUERIES = 2048


def valid(vectors: DataFrame, dimension: int, kind: str) -> DataFrame:
    """(vec_id, embedding) without vectors that are null, zero, of another length, or hold null or non-finite components."""
    e = F.col("embedding").cast(kind)
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(F.col("vec_id").cast("long"), e.alias("embedding")).where(F.col("vec_id").isNotNull() & (F.size(F.col("embedding")) == dimension) & fine & F.exists("embedding", lambda x: x != 0))


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return np.asarray(column.flatten(), float).reshape(-1, dimension)


def kmeans(rows: np.ndarray, k: int, seed: int, rounds: int = 10) -> np.ndarray:
    """Lloyd's algorithm on few rows; an empty cluster keeps its centroid."""
    rng = np.random.default_rng(seed)
    centroids = rows[rng.choice(len(rows), k, replace=False)]
    for _ in range(rounds):
        near = (-2 * rows @ centroids.T + (centroids**2).sum(1)).argmin(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, rows)
        sizes = np.bincount(near, minlength=k)
        centroids = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centroids)
    return centroids


def cells_of(rows: np.ndarray, books: np.ndarray) -> np.ndarray:
    k, half = books.shape[1], books.shape[2]
    codes = [(-2 * rows[:, h * half : (h + 1) * half] @ books[h].T + (books[h] ** 2).sum(1)).argmin(1) for h in (0, 1)]
    return codes[0] * k + codes[1]


def walk(query: np.ndarray, books: np.ndarray, sizes: np.ndarray, enough: int) -> list[int]:
    """Non-empty cells in order of summed distance, until they hold ``enough`` entries or none is left."""
    k, half = books.shape[1], books.shape[2]
    near = [-(books[h] @ query[h * half : (h + 1) * half]) for h in (0, 1)]
    order = [np.argsort(d, kind="stable") for d in near]
    first, second = (near[h][order[h]].tolist() for h in (0, 1))
    heap, reached, found, held = [(first[0] + second[0], 0, 0)], [0] * k, [], 0
    # Row i of the grid is entered at column 0 when row i - 1 is, and walked to the right.
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        cell = int(order[0][i] * k + order[1][j])
        if sizes[cell]:
            found.append(cell)
            held += int(sizes[cell])
        if j + 1 < k:
            heapq.heappush(heap, (first[i] + second[j + 1], i, j + 1))
        if j == 0 and i + 1 < k:
            heapq.heappush(heap, (first[i + 1] + second[0], i + 1, 0))
    return found


def exact(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed in order of dimension."""
    total = np.zeros(len(rows))
    for d in range(rows.shape[1]):
        total += query[d] * rows[:, d]
    return total


def best(query: np.ndarray, own: int, rows: np.ndarray, ids: np.ndarray, rough: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the ``k`` rows of largest inner product but the query's own, ties to smaller ids. ``rough``: scores up to rounding."""
    rough = np.where(ids == own, -np.inf, rough)
    if len(ids) > k:
        least = np.partition(rough, -k)[-k]
        chosen = np.flatnonzero(rough >= least - 1e-9 * max(1.0, abs(least)))
    else:
        chosen = np.arange(len(ids))
    chosen = chosen[ids[chosen] != own]
    scores = exact(query, rows[chosen])
    order = np.lexsort((ids[chosen], -scores))[:k]
    return ids[chosen][order], scores[order]


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, seed: int = 8, report: dict | None = None) -> DataFrame:
    """The ``k`` nearest found for each row of ``queries``: query_id, rank from 1, vec_id, score.

    Both tables have vec_id and embedding; a query's own row (that vec_id) is no
    candidate. The dimension is the most frequent length of a vector, of equally
    frequent ones the larger. Vectors that :func:`valid` rejects take no part on either side.
    Every other row is indexed, repeated vectors and ids too. Components may be
    of any number type; they are taken as floats if they are, else as doubles.
    Other columns are ignored. An empty table gives no rows. ``report`` gets
    the number of entries and cells and the length of a walk.
    """
    kind = "array<float>" if vectors.schema["embedding"].dataType.elementType.typeName() == "float" else "array<double>"
    spark = vectors.sparkSession
    none = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    lengths = vectors.where("size(embedding) > 0").groupBy(F.size("embedding").alias("length")).count()
    head = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    if head is None:
        return none
    dimension = head[0]
    rows = common.materialise(valid(vectors, dimension, kind), "vectors")
    queries = valid(queries, dimension, kind)
    total = rows.count()
    if not total:
        return none
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_ROWS).toPandas()
    fit = np.stack(sample["embedding"].to_numpy()).astype(float)
    pad = dimension % 2
    half = (dimension + pad) // 2
    widened = np.pad(fit, ((0, 0), (0, pad)))
    size = int(max(1, min(round((total / ENTRIES_A_CELL) ** 0.5), -(-len(fit) // ROWS_A_CENTROID))))
    books = np.stack([kmeans(widened[:, h * half : (h + 1) * half], size, seed + h) for h in (0, 1)])
    code = spark.sparkContext.broadcast(books)

    def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cell = cells_of(np.pad(matrix(b.column("embedding"), dimension), ((0, 0), (0, pad))), code.value)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell, pa.int32())], [*b.schema.names, "cell"])

    entries = common.materialise(rows.mapInArrow(quantise, f"vec_id long, embedding {kind}, cell int"), "entries")
    sizes = np.zeros(size * size, np.int64)
    for r in entries.groupBy("cell").count().collect():
        sizes[r["cell"]] = r["count"]
    # Rows of a query's own id are passed too and do not count.
    repeats = entries.groupBy("vec_id").count().agg(F.max("count")).first()[0]
    enough = max(k + repeats, calibrate(entries, queries, books, sizes, dimension, k))
    if report is not None:
        report |= {"entries": total, "cells": size * size, "walk": min(enough, total)}

    # Shelves: runs of cells with SHELF_ROWS entries, or parts of one large cell.
    shelf, parts, at, held = np.zeros(size * size, np.int64), np.ones(size * size, np.int64), 0, 0
    for c in np.flatnonzero(sizes):
        if held and held + sizes[c] > SHELF_ROWS:
            at, held = at + 1, 0
        shelf[c], parts[c] = at, max(1, -(-sizes[c] // SHELF_ROWS))
        held += sizes[c]
        if parts[c] > 1:
            at, held = at + parts[c], 0
    plan = spark.sparkContext.broadcast((sizes, shelf, parts))

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, shelf, parts = plan.value
        for b in batches:
            if not b.num_rows:
                continue
            held = matrix(b.column("embedding"), dimension)
            shelves, cells, at = [], [], []
            for i, q in enumerate(held):
                by: dict[int, list[int]] = {}
                for c in walk(np.pad(q, (0, pad)), code.value, sizes, enough):
                    for p in range(int(parts[c])):
                        by.setdefault(int(shelf[c]) + p, []).append(c)
                for s, own in by.items():
                    shelves.append(s)
                    cells.append(own)
                    at.append(i)
            taken = b.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([taken.column("vec_id"), taken.column("embedding"), pa.array(shelves, pa.int64()), pa.array(cells, pa.list_(pa.int32()))], ["query_id", "query", "shelf", "cells"])

    asked = queries.repartition(max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))).mapInArrow(visits, f"query_id long, query {kind}, shelf long, cells array<int>")
    asked = common.materialise(asked, "visits")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, shelf, parts = plan.value
        for b in batches:
            cell, ids = np.asarray(b.column("cell")), np.asarray(b.column("vec_id")).view(np.uint64)
            dealt = ((ids * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % parts[cell]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shelf[cell] + dealt)], [*b.schema.names, "shelf"])

    placed = entries.mapInArrow(place, f"vec_id long, embedding {kind}, cell int, shelf long")
    copies = asked.groupBy("shelf").agg(F.ceil(F.count("*") / SHELF_QUERIES).cast("int").alias("copies"))
    left = asked.join(copies, "shelf").withColumn("copy", F.pmod(F.xxhash64("query_id"), F.col("copies")).cast("int"))
    right = placed.join(copies, "shelf").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))

    def rerank(asking: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "hits": []}
        if len(asking) and len(held):
            order = np.argsort(held["vec_id"].to_numpy(), kind="stable")
            ids, cells = held["vec_id"].to_numpy()[order], held["cell"].to_numpy()[order]
            entry = np.stack(held["embedding"].to_numpy()[order]).astype(float)
            for at in range(0, len(asking), 256):
                some = asking.iloc[at : at + 256]
                query = np.stack(some["query"].to_numpy()).astype(float)
                rough = query @ entry.T
                for i, (own, seen) in enumerate(zip(some["query_id"], some["cells"], strict=True)):
                    inside = np.flatnonzero(np.isin(cells, seen))
                    found, score = best(query[i], own, entry[inside], ids[inside], rough[i, inside], k)
                    out["query_id"].append(own)
                    out["hits"].append([{"far": -s, "vec_id": v} for v, s in zip(found.tolist(), score.tolist(), strict=True)])
        return pd.DataFrame(out)

    grouped = left.groupBy("shelf", "copy").cogroup(right.select("shelf", "copy", "vec_id", "embedding", "cell").groupBy("shelf", "copy"))
    hits = grouped.applyInPandas(rerank, "query_id long, hits array<struct<far: double, vec_id: long>>")
    top = hits.groupBy("query_id").agg(F.slice(F.sort_array(F.flatten(F.collect_list("hits"))), 1, k).alias("hits"))
    ranked = top.select("query_id", F.posexplode("hits").alias("rank", "hit"))
    return ranked.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.far")).alias("score"))


def calibrate(entries: DataFrame, queries: DataFrame, books: np.ndarray, sizes: np.ndarray, dimension: int, k: int) -> int:
    """Entries that a walk must pass so that TARGET of the true neighbours of TEST_QUERIES queries lie in its cells."""
    spark = entries.sparkSession
    picked = queries.orderBy(F.xxhash64(F.lit(1), "vec_id"), "vec_id").limit(TEST_QUERIES).toPandas()
    if not len(picked):
        return 0
    tests = np.stack(picked["embedding"].to_numpy()).astype(float)
    shared = spark.sparkContext.broadcast((tests, picked["vec_id"].to_numpy()))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests, own = shared.value
        top = [[] for _ in own]
        for b in batches:
            if b.num_rows:
                rough = tests @ matrix(b.column("embedding"), dimension).T
                rough[own[:, None] == np.asarray(b.column("vec_id"))[None, :]] = -np.inf
                cell = np.asarray(b.column("cell"))
                for i, row in enumerate(rough):
                    at = np.argpartition(-row, k)[:k] if len(row) > k else np.arange(len(row))
                    top[i] = heapq.nlargest(k, top[i] + list(zip(row[at].tolist(), cell[at].tolist(), strict=True)))
        for i, found in enumerate(top):
            if found:
                yield pa.RecordBatch.from_pydict({"query": [i] * len(found), "score": [x for x, _ in found], "cell": pa.array([c for _, c in found], pa.int32())})

    found = entries.mapInArrow(nearest, "query long, score double, cell int")
    found = found.groupBy("query").agg(F.slice(F.sort_array(F.collect_list(F.struct("score", "cell")), asc=False), 1, k).alias("top")).collect()
    need, total, pad = [], int(sizes.sum()), dimension % 2
    for r in found:
        order = walk(np.pad(tests[r["query"]], (0, pad)), books, sizes, total)
        passed = dict(zip(order, np.cumsum(sizes[order]).tolist(), strict=True))
        need += [passed[x["cell"]] for x in r["top"]]
    return int(np.quantile(need, TARGET, method="higher")) if need else 0
