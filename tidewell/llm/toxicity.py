"""Toxicity: a linear classifier of character n-grams scaled by naive Bayes log-count ratios.

Texts become sets of hashed n-grams of lower-cased characters. From labelled
documents, each n-gram gets the logarithm of the ratio of its smoothed share
among positive and among negative documents; logistic regression is then fitted
on the features scaled by these ratios (Wang and Manning, 2012). Only the
n-grams whose counts differ most between the classes take part.

Training runs on a bounded sample of labelled rows: counts and features are
made where the texts are, and the driver gets one count table and the ids of
the chosen n-grams that each sampled document has.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm import common

ORDERS = (4, 5, 6)
BITS = 20
#: Half of G squared that an n-gram must reach; chance takes about one n-gram in exp(10) there.
SIGNIFICANT = 10.0
#: Characters that are hashed at once; memory does not depend on the length of a text.
CHUNK = 1 << 20
#: Parts of the count tables that are added up apart.
SLICES = 8


def ngrams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pieces of (text index, hashed n-gram) over a batch of texts, every n-gram of every text once for each place."""
    codes = [np.frombuffer(t.lower().encode("utf-32-le", "replace"), np.uint32) for t in texts]
    ends = np.cumsum([len(c) for c in codes])
    stream = np.concatenate(codes) if codes else np.zeros(0, np.uint32)
    for at in range(0, len(stream), CHUNK):
        part = stream[at : at + CHUNK + max(ORDERS) - 1].astype(np.uint64)
        owner = np.searchsorted(ends, np.arange(at, at + len(part)), "right")
        total = part * np.uint64(0x9E3779B97F4A7C15)
        for n in range(2, max(ORDERS) + 1):
            if len(part) < n:
                break
            total = total[: len(part) - n + 1] * np.uint64(0xBF58476D1CE4E5B9) + part[n - 1 :] * np.uint64(0x9E3779B97F4A7C15)
            if n in ORDERS:
                size = min(CHUNK, len(total))
                mixed = (total[:size] ^ (total[:size] >> np.uint64(29))) * np.uint64(0x94D049BB133111EB + 2 * n)
                inside = owner[:size] == owner[n - 1 : n - 1 + size]
                yield owner[:size][inside], (mixed[inside] >> np.uint64(64 - BITS)).astype(np.int64)


def presence(texts: list[str], chosen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text index, n-gram) pairs, each once; with ``chosen``, a table from n-gram to feature or -1, only those features."""
    pairs = []
    for owner, gram in ngrams(texts):
        if chosen is not None:
            gram = chosen[gram]
            hit = gram >= 0
            owner, gram = owner[hit], gram[hit].astype(np.int64)
        pairs.append(np.unique((owner << BITS) | gram))
    both = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
    return both >> BITS, both & ((1 << BITS) - 1)


def groups(texts: list[str], limit: int = CHUNK) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about ``limit`` characters, with the index of the first."""
    start = total = 0
    for i, t in enumerate(texts):
        if total and total + len(t) > limit:
            yield start, texts[start:i]
            start, total = i, 0
        total += len(t)
    if start < len(texts):
        yield start, texts[start:]


@dataclass(frozen=True)
class Model:
    """``chosen`` maps an n-gram to its feature or -1; a score is the logistic of ``bias`` plus the weights of a text's features."""

    chosen: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        sums = np.full(len(texts), self.bias)
        for start, part in groups(texts):
            owner, feature = presence(part, self.chosen)
            sums[start : start + len(part)] += np.bincount(owner, self.weights[feature], len(part))
        return 1 / (1 + np.exp(-np.clip(sums, -35, 35)))


def log_count_ratio(positive: np.ndarray, negative: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    p, q = positive + alpha, negative + alpha
    return np.log((p / p.sum()) / (q / q.sum()))


def choose(positive: np.ndarray, negative: np.ndarray, n_pos: int, n_neg: int, features: int, least: float = SIGNIFICANT) -> np.ndarray:
    """The n-grams with the largest log-likelihood ratio statistic of presence against class, ``least`` or more."""
    both = positive + negative
    total = n_pos + n_neg
    cells = [(positive, both * n_pos / total), (negative, both * n_neg / total), (n_pos - positive, (total - both) * n_pos / total), (n_neg - negative, (total - both) * n_neg / total)]
    statistic = sum(np.where(o > 0, o * np.log(np.maximum(o, 1e-9) / np.maximum(e, 1e-9)), 0.0) for o, e in cells)
    best = np.argsort(-statistic, kind="stable")[:features]
    return np.sort(best[statistic[best] >= least])


def fit_logistic(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, labels: np.ndarray, n_columns: int, l2: float = 1e-5, rounds: int = 300, rate: float = 0.1) -> tuple[np.ndarray, float]:
    """Weights and bias by full-batch Adam on the mean logistic loss."""
    w, n = np.zeros(n_columns + 1), len(labels)
    m, v = np.zeros_like(w), np.zeros_like(w)
    prior = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    w[-1] = np.log(prior / (1 - prior))
    for t in range(1, rounds + 1):
        z = np.bincount(rows, w[columns] * values, n) + w[-1]
        error = (1 / (1 + np.exp(-np.clip(z, -35, 35))) - labels) / n
        g = np.append(np.bincount(columns, error[rows] * values, n_columns) + l2 * w[:-1], error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def train(labelled: DataFrame, max_rows: int = common.LABELLED_ROWS, features: int = 4096, tasks: int = 8) -> Model:
    """Fit on at most ``max_rows`` rows of ``labelled`` (text, label 0 or 1), those of smallest ``order``.

    ``labelled`` has been cut to the bound by the caller or is cut here by a
    hash of the text. Without both classes every text scores the share of
    positive rows, or 0 without rows.
    """
    sample = labelled.where("label IS NOT NULL").select(common.text_or_empty().alias("text"), F.col("label").cast("int").alias("label"))
    sample = common.materialise(sample.orderBy(F.xxhash64("text"), "text").limit(max_rows), "toxicity-sample").repartition(tasks)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, seen = np.zeros((2, 1 << BITS), np.int32), np.zeros(2, np.int32)
        for b in batches:
            texts, labels = b.column(0).to_pylist(), np.asarray(b.column(1))
            for start, part in groups(texts):
                owner, gram = presence(part)
                own = labels[start : start + len(part)]
                for c in (0, 1):
                    tables[c] += np.bincount(gram[own[owner] == c], minlength=1 << BITS).astype(np.int32)
                    seen[c] += int((own == c).sum())
        parts = np.split(tables, SLICES, axis=1)
        yield pa.RecordBatch.from_pydict({"slice": pa.array(range(SLICES), pa.int32()), "counts": [zlib.compress(p.tobytes(), 1) for p in parts], "seen": [seen.tobytes()] * SLICES})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for b in batches:
            for s, counts, seen in zip(*[c.to_pylist() for c in b.columns], strict=True):
                own = sums.setdefault(s, [0, 0])
                own[0] += np.frombuffer(zlib.decompress(counts), np.int32)
                own[1] += np.frombuffer(seen, np.int32)
        if sums:
            yield pa.RecordBatch.from_pydict({"slice": pa.array(list(sums), pa.int32()), "counts": [zlib.compress(c.tobytes(), 1) for c, _ in sums.values()], "seen": [n.tobytes() for _, n in sums.values()]})

    # Tasks count side by side, and slices of their tables are added side by side.
    schema, tables, seen = "slice int, counts binary, seen binary", np.zeros((2, SLICES, (1 << BITS) // SLICES), np.int64), np.zeros(2, np.int64)
    for row in sample.mapInArrow(count, schema).repartition(SLICES, "slice").mapInArrow(add, schema).collect():
        tables[:, row["slice"]] = np.frombuffer(zlib.decompress(row["counts"]), np.int32).reshape(2, -1)
        seen = np.frombuffer(row["seen"], np.int32)
    tables = tables.reshape(2, -1)
    if not seen.all():
        share = np.clip(seen[1] / max(seen.sum(), 1), 1e-9, 1 - 1e-9)
        return Model(np.full(1 << BITS, -1, np.int16), np.zeros(1), float(np.log(share / (1 - share))))
    best = choose(tables[1].astype(float), tables[0].astype(float), int(seen[1]), int(seen[0]), features)
    chosen = np.full(1 << BITS, -1, np.int16)
    chosen[best] = np.arange(len(best))
    ratio = log_count_ratio(tables[1].astype(float), tables[0].astype(float))[best]

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, labels = b.column(0).to_pylist(), b.column(1).to_pylist()
            for start, part in groups(texts):
                owner, feature = presence(part, chosen)
                cut = np.searchsorted(owner, np.arange(1, len(part)))
                yield pa.RecordBatch.from_pydict({"label": labels[start : start + len(part)], "ids": [x.astype(np.int32).tobytes() for x in np.split(feature, cut)]}, pa.schema([("label", pa.int32()), ("ids", pa.binary())]))

    found = sample.mapInArrow(featurise, "label int, ids binary").collect()
    ids = [np.frombuffer(r["ids"], np.int32) for r in found]
    labels = np.array([r["label"] for r in found], float)
    columns = np.concatenate(ids).astype(np.int64)
    rows = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
    weights, bias = fit_logistic(rows, columns, ratio[columns], labels, len(best))
    return Model(chosen, weights * ratio, bias)


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``doc_id`` of each row of ``docs`` with ``column``, the probability of label 1.

    Null and empty texts have no n-grams and score the bias. Null and repeated
    doc_ids are rows like others, equal texts score alike, other columns are
    ignored, an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.chosen, model.weights, model.bias))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Model(*shared.value)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fitted.scores(texts))], ["doc_id", column])

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(work, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {column} double")


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, max_rows: int = common.LABELLED_ROWS) -> DataFrame:
    """(text, label) of at most ``max_rows`` rows of ``labels`` outside the held-out fold, lowest hashes of doc_id first.

    The sample of labels is bounded, so it is broadcast to the one scan of
    ``docs``. A document that repeats, or that has several labels, is there
    once for each pair; so are ties. Labels without a document, a doc_id or a
    value are left out; empty tables give none. Other columns are ignored.
    """
    rows = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~common.held_out(F.col("doc_id")))
    rows = rows.select("doc_id", F.col(label).alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_rows)
    return docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id").select("text", "label")
