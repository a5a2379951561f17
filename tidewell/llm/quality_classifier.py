"""Quality: ordinal cumulative-link regression on graded ratings.

All grades share one weight vector over hashed text, and ordered thresholds
cut its score into grades: P(grade <= k) = logistic(threshold_k - w.x). The fit
gives the expected grade and the probability of a grade of at least some bar,
by which documents are selected.

Three kinds of hashed tokens describe a text: its words; runs of one to three
characters in which letters and digits are replaced by their class, so that
markup, shouting and symbol noise show in any language; and the rounded shares
of words that repeat the word before, of distinct words and of repeated lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewell.llm import common
from tidewell.llm.wordhash import CHUNK_BYTES, WordHasher, chunks, distinct, mix

WORD_BITS = 16
SHAPE_BITS = 12
SHARES = 3 * 16
WIDTH = (1 << WORD_BITS) + (1 << SHAPE_BITS) + SHARES


def _classes() -> np.ndarray:
    table = np.arange(256, dtype=np.uint64)
    table[48:58], table[65:91], table[97:123], table[128:] = ord("0"), ord("A"), ord("a"), ord("a")
    return table


def long_features(text: bytes, hasher: WordHasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:func:`features` of one text of any length, from pieces of it."""
    n, repeated, last, tokens = 0, 0, np.zeros(0, np.uint64), np.zeros(1 << WORD_BITS, np.int64)

    def words() -> Iterator[np.ndarray]:
        nonlocal n, repeated, last, tokens
        for word in hasher.stream(text):
            tokens += np.bincount((word >> np.uint64(64 - WORD_BITS)).astype(np.int64), minlength=len(tokens))
            joined = np.concatenate((last, word))
            n, repeated, last = n + len(word), repeated + int((joined[1:] == joined[:-1]).sum()), joined[-1:]
            yield word

    different = len(distinct(words()))
    used = np.flatnonzero(tokens)
    columns, values = [used], [np.log1p(tokens[used]) / np.sqrt(np.log1p(len(used))) / 2]
    size, shapes = len(text) + 1, np.zeros((3, 1 << SHAPE_BITS), np.int64)
    for at in range(0, size, CHUNK_BYTES):
        part = _classes()[np.frombuffer(text[at : at + CHUNK_BYTES + 2] + b"\n" * (at + CHUNK_BYTES + 2 >= size), np.uint8)]
        total = np.zeros(len(part), np.uint64)
        for k in range(3):
            total = total[: len(part) - k] * np.uint64(257) + part[k:] + np.uint64(1)
            own = total[:CHUNK_BYTES]
            shapes[k] += np.bincount((mix(own + np.uint64(k)) >> np.uint64(64 - SHAPE_BITS)).astype(np.int64), minlength=1 << SHAPE_BITS)
    for times in shapes:
        used = np.flatnonzero(times)
        columns.append((1 << WORD_BITS) + used)
        values.append(np.sqrt(times[used] / size))
    lines = text.count(b"\n") + 1
    empty = b"\n\n" in text or text[:1] == b"\n" or text[-1:] == b"\n"
    unlike = len(distinct(WordHasher(False, breaks=b"\n").stream(text))) + empty
    for i, share in enumerate((repeated / max(n, 1), different / max(n, 1), 1 - unlike / lines)):
        columns.append(np.array([(1 << WORD_BITS) + (1 << SHAPE_BITS) + 16 * i + min(15, int(share * 16))]))
        values.append(np.ones(1))
    columns = np.concatenate(columns)
    return np.zeros(len(columns), np.int64), columns, np.concatenate(values)


def features(texts: list[bytes], hasher: WordHasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, hashed token, value) of a run of texts. Words weigh log counts over the text's length, shapes the root of their share."""
    if len(texts) == 1 and len(texts[0]) > CHUNK_BYTES:
        return long_features(texts[0], hasher)
    word, owner, counts = hasher.words(texts)
    n = np.maximum(counts, 1)
    rows, columns, values = [], [], []
    key, times = np.unique((owner.astype(np.int64) << WORD_BITS) | (word >> np.uint64(64 - WORD_BITS)).astype(np.int64), return_counts=True)
    kinds = np.bincount(key >> WORD_BITS, minlength=len(texts))
    rows.append(key >> WORD_BITS)
    columns.append(key & ((1 << WORD_BITS) - 1))
    values.append(np.log1p(times) / np.sqrt(np.log1p(kinds[rows[0]])) / 2)

    stream = _classes()[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    sizes = np.array([len(t) + 1 for t in texts])
    text = np.repeat(np.arange(len(texts)), sizes)
    total = np.zeros(len(stream), np.uint64)
    for k in range(3):
        total = total[: len(stream) - k] * np.uint64(257) + stream[k:] + np.uint64(1)
        inside = text[: len(total)] == text[k:]
        shape = (mix(total[inside] + np.uint64(k)) >> np.uint64(64 - SHAPE_BITS)).astype(np.int64)
        key, times = np.unique((text[: len(total)][inside] << SHAPE_BITS) | shape, return_counts=True)
        rows.append(key >> SHAPE_BITS)
        columns.append((1 << WORD_BITS) + (key & ((1 << SHAPE_BITS) - 1)))
        values.append(np.sqrt(times / sizes[rows[-1]]))

    same = (word[1:] == word[:-1]) & (owner[1:] == owner[:-1])
    repeated = np.bincount(owner[1:][same], minlength=len(texts)) / n
    order = np.lexsort((word, owner))
    first = (np.diff(word[order], prepend=word[:1] + np.uint64(1)) != 0) | (np.diff(owner[order], prepend=-1) != 0)
    different = np.bincount(owner[order][first], minlength=len(texts))
    lines = [t.split(b"\n") for t in texts]
    again = np.array([1 - len(set(x)) / len(x) for x in lines])
    for i, share in enumerate((repeated, different / n, again)):
        rows.append(np.arange(len(texts)))
        columns.append((1 << WORD_BITS) + (1 << SHAPE_BITS) + 16 * i + np.minimum(15, (share * 16).astype(np.int64)))
        values.append(np.ones(len(texts)))
    order = np.argsort(np.concatenate(rows), kind="stable")
    return np.concatenate(rows)[order], np.concatenate(columns)[order], np.concatenate(values)[order]


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def cuts_of(x: np.ndarray, width: int) -> np.ndarray:
    """The thresholds of parameters ``x``: weights, the first threshold and logarithms of the steps to the next, so thresholds stay ordered."""
    return x[width] + np.concatenate(([0.0], np.cumsum(np.exp(x[width + 1 :]))))


def loss(x: np.ndarray, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grades: np.ndarray, width: int, l2: float) -> tuple[float, np.ndarray]:
    """The mean negative log likelihood of ``grades`` with a ridge on the weights, and its gradient."""
    n, levels = len(grades), len(x) - width + 1
    score = np.bincount(rows, x[columns] * values, n)
    bounds = np.concatenate(([-np.inf], cuts_of(x, width), [np.inf]))
    upper, lower = _logistic(bounds[grades + 1] - score), _logistic(bounds[grades] - score)
    share = np.maximum(upper - lower, 1e-9)
    slope_up, slope_low = upper * (1 - upper), lower * (1 - lower)
    slope_up, slope_low = np.where(grades == levels - 1, 0, slope_up), np.where(grades == 0, 0, slope_low)
    d_score = (slope_up - slope_low) / share / n
    d_cuts = np.array([(np.where(grades == k, -slope_up, 0) + np.where(grades == k + 1, slope_low, 0)) @ (1 / share) / n for k in range(levels - 1)])
    d_steps = np.array([d_cuts[i + 1 :].sum() * np.exp(x[width + 1 + i]) for i in range(levels - 2)])
    slope = np.concatenate((np.bincount(columns, d_score[rows] * values, width) + l2 * x[:width], [d_cuts.sum()], d_steps))
    return float(-np.log(share).mean() + l2 / 2 * x[:width] @ x[:width]), slope


def fit_ordinal(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grades: np.ndarray, levels: int, width: int, l2: float = 1e-4, rounds: int = 150, rate: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Weights and the ``levels`` - 1 ordered thresholds, by full-batch Adam on :func:`loss`."""
    below = np.clip([(grades <= k).mean() for k in range(levels - 1)], 1e-3, 1 - 1e-3)
    start = np.log(below / (1 - below))
    x = np.concatenate((np.zeros(width), start[:1], np.log(np.maximum(np.diff(start), 1e-2))))
    m, v = np.zeros_like(x), np.zeros_like(x)
    for t in range(1, rounds + 1):
        _, g = loss(x, rows, columns, values, grades, width, l2)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        x = x - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return x[:width], cuts_of(x, width)


def tails(scores: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade >= k) for k = 1, 2, ... by row."""
    return 1 - _logistic(thresholds[None, :] - scores[:, None])


def train(rated: DataFrame, levels: int, max_rows: int = common.LABELLED_ROWS, tasks: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Fit on at most ``max_rows`` rows of ``rated`` (text, grade of 0 to ``levels`` - 1), lowest text hashes first.

    Features are made where the texts are, in pieces where a text is long; the
    driver gets at most WIDTH of them a row. Rows without a grade are ignored. Without rows every text is
    held to have the highest grade, so that nothing is rejected unlearned.
    """
    sample = rated.where("grade IS NOT NULL").select(common.text_or_empty().alias("text"), F.col("grade").cast("int").alias("grade"))
    sample = common.materialise(sample.orderBy(F.xxhash64("text"), "text").limit(max_rows), "quality-sample").repartition(tasks)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for b in batches:
            grades = b.column(1).to_pylist()
            for start, part in chunks(b.column(0).cast(pa.binary())):
                row, column, value = features(part, hasher)
                cut = np.searchsorted(row, np.arange(1, len(part)))
                ids, weights = np.split(column.astype(np.int32), cut), np.split(value.astype(np.float32), cut)
                yield pa.RecordBatch.from_pydict({"grade": pa.array(grades[start : start + len(part)], pa.int32()), "ids": [x.tobytes() for x in ids], "weights": [x.tobytes() for x in weights]})

    found = sample.mapInArrow(featurise, "grade int, ids binary, weights binary").collect()
    if not found:
        return np.zeros(WIDTH), np.full(levels - 1, -35.0)
    ids = [np.frombuffer(r["ids"], np.int32) for r in found]
    rows = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
    values = np.concatenate([np.frombuffer(r["weights"], np.float32) for r in found]).astype(float)
    return fit_ordinal(rows, np.concatenate(ids).astype(np.int64), values, np.array([r["grade"] for r in found]), levels, WIDTH)


def rate(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], bar: int = 1) -> DataFrame:
    """``docs`` with ``expected_grade`` and ``p_tail``, the probability of a grade of ``bar`` or more.

    All columns stay but those two, which are replaced. Null and empty texts
    have no words and are scored by what is left, the thresholds. Repeated rows
    score alike; an empty table gives no rows.
    """
    docs = docs.drop("expected_grade", "p_tail")
    shared = docs.sparkSession.sparkContext.broadcast((model[0].astype(np.float32), model[1]))
    at = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (weights, thresholds), hasher = shared.value, WordHasher()
        for b in batches:
            scores = np.zeros(b.num_rows)
            for start, part in chunks(b.column(at).cast(pa.binary())):
                row, column, value = features(part, hasher)
                scores[start : start + len(part)] = np.bincount(row, weights[column] * value, len(part))
            tail = tails(scores, thresholds)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(tail.sum(1)), pa.array(tail[:, bar - 1])], [*b.schema.names, "expected_grade", "p_tail"])

    schema = StructType([*docs.schema, *StructType().add("expected_grade", "double").add("p_tail", "double")])
    return docs.mapInArrow(work, schema)


def graded(docs: DataFrame, labels: DataFrame, max_rows: int = common.LABELLED_ROWS) -> DataFrame:
    """(text, grade) of at most ``max_rows`` labels outside the held-out fold: 0 poor, 1 good but toxic, 2 good.

    Lowest hashes of doc_id come first. The bounded sample of labels is
    broadcast to one scan of the texts. A document that repeats, or that has
    several labels, is there once for each pair. Labels without a document, a
    doc_id or a grade are left out; empty tables give none.
    """
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2)
    rows = labels.select("doc_id", grade.alias("grade")).where(F.col("grade").isNotNull() & F.col("doc_id").isNotNull() & ~common.held_out(F.col("doc_id")))
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(max_rows)
    return docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id").select("text", "grade")
