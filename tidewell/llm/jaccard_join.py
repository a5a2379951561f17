"""Similarity join of documents by the Jaccard index of their word shingles.

Documents with equal shingle sets are one class. Classes that may be similar
enough are found by signatures of prefixes, and every candidate is verified on
whole sets, so the links are exact.

Prefixes. Shingles are ordered by how many documents have them, rarest first.
If two sets are similar enough, at most e = n - ceil(t * n) shingles of a set
of n are missing in the other. Shingles fall into classes by their counts:
those of the first class are indexed alone, those of the second in pairs, those
of the third in threes (Wang et al., 2016). The more frequent classes are dealt
by hash into parts, and combinations are made inside a part. A part of x
shingles that are combined by k bears x - k + 1 of the missing ones, so the
prefix is extended until its parts bear e + 1. The sets then share a
combination of whichever prefix ends first. The bounds between classes follow
the corpus: the shingles above them hold the shares FREQUENT of all postings.

Levels. Sets of 2**j to 2**(j+1) - 1 shingles are level j, with a number of
parts that fits their size. A set also signs for the level below if a similar
set can lie there, so every two similar sets share the level of the smaller.

Counts. Shingle counts come from one table of hashed counters over all
documents. Counters may collide: that changes classes and order, not results.

Filter. A set is also summed up by a bitmap of about one bit a shingle, each
bit the parity of the shingles hashed to it. The bits in which two bitmaps
differ are no more than the shingles in which the sets differ (Sandes et al.,
2020), so a pair that fails on bitmaps fails, at a sixty-fourth of the bytes.

Verification. No list of sets with one signature is expanded into pairs. Every
list has two pivots, and its other members are held against them. Links join
sets into components; a list whose members are then in one component is done.
Of the rest, lists of more than HOT members are split by longer combinations:
their members are signed again with every class combined by one shingle more.
What is left is compared by bitmaps, list by list, and gives one row for each
member with a partner in another component. Such rows join components into
groups, and inside a group every member's whole set is there once and pairs
across components that pass on bitmaps are verified. A group gives the links
that join its components, fewer than its members. Long lists and large groups
are dealt into blocks, and each pair of blocks is one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm import common
from tidewell.llm.components import components
from tidewell.llm.wordhash import WordHasher, chunks, mix

COUNTER_BITS = 21
SLICES = 16
#: Shares of all postings that the shingles above the bounds hold: beyond the first, pairs; beyond the second, threes.
FREQUENT = (1 / 8, 1 / 64)
#: Lists of more members are split by longer combinations, LONGER times at most.
HOT = 8192
LONGER = 2
BLOCK = 1024
BLOCK_BYTES = 64 << 20
GROUP_ROWS = 2000
LEAST_BITS = 1024


def set_ids(found: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set; equal sets have equal sums."""
    ends = np.concatenate(([0], np.cumsum(sizes)))
    sums = []
    for salt in (0x1B873593, 0xCC9E2D51):
        running = np.concatenate(([np.uint64(0)], np.cumsum(mix(found ^ np.uint64(salt)))))
        sums.append(mix(running[ends[1:]] - running[ends[:-1]] + sizes.astype(np.uint64)).view(np.int64))
    return sums[0], sums[1]


def errors(n: int, num: int, den: int) -> int:
    """Shingles of a set of n that a similar set may lack."""
    return n - -(-num * n // den)


def counter_of(found: np.ndarray) -> np.ndarray:
    """The counter of each shingle hash."""
    return (found >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def bounds(counters: np.ndarray) -> tuple[int, ...]:
    """For each share of FREQUENT the least count above which shingles hold no more than that share of all postings."""
    counts, times = np.unique(counters[counters > 0], return_counts=True)
    above = (counts * times)[::-1].cumsum()[::-1] - counts * times
    return tuple(int(counts[np.argmax(above <= share * (counts * times).sum())]) if len(counts) else 0 for share in FREQUENT)


@cache
def orders(level: int, num: int, den: int, longer: int) -> list[tuple[int, int]]:
    """(shingles combined, parts) of each class at a level.

    Parts are half of the shingles that may be missing. A whole set must bear
    those too, so parts, and then orders, are lowered until it does.
    """
    n = 1 << level
    spare, parts = -(-num * n // den) - 1, max(1, (errors(n, num, den) + 1) // 2)
    found = [[k, 1 if k == 1 else parts] for k in range(1 + longer, 2 + longer + len(FREQUENT))]
    while (taken := sum((k - 1) * p for k, p in found)) > spare:
        if max(p for _, p in found) > 1:
            share = spare / taken
            found = [[k, min(p - 1, int(p * share)) or 1 if p > 1 else 1] for k, p in found]
        else:
            top = max(k for k, _ in found)
            found = [[min(k, top - 1), p] for k, p in found]
    return [tuple(x) for x in found]


def combinations(part: np.ndarray, order: np.ndarray, k: int) -> list[np.ndarray]:
    """Places of all combinations of ``k`` rows of equal ``part``, place by place; rows are taken as ``order`` sorts them."""
    part = part[order]
    made = [np.arange(len(part))]
    for _ in range(k - 1):
        longer, step = [], 1
        while True:
            last = made[-1] + step
            fits = np.flatnonzero(last < len(part))
            fits = fits[part[last[fits]] == part[made[-1][fits]]]
            if not len(fits):
                break
            longer.append([m[fits] for m in made] + [last[fits]])
            step += 1
        made = [np.concatenate(x) for x in zip(*longer, strict=True)] if longer else [np.zeros(0, np.int64)] * (len(made) + 1)
    return [order[m] for m in made]


def signatures(own: np.ndarray, counts: np.ndarray, frequent: tuple[int, ...], num: int, den: int, longer: int = 0) -> tuple[np.ndarray, int]:
    """The signatures of one set of shingle hashes with these counts, and how many are of two shingles or more."""
    n = len(own)
    if n < 2:
        return own[:0], 0
    level, need = n.bit_length() - 1, errors(n, num, den) + 1
    order = np.lexsort((own, counts))
    own, rank = own[order], np.searchsorted(frequent, counts[order], "left")
    out, combined = [], 0
    for at in (level, level - 1) if -(-num * n // den) < 1 << level else (level,):
        plan = orders(at, num, den, longer)
        k = np.array([x for x, _ in plan])[rank]
        # Classes that the level combines alike are told apart still, so that a part is of one class.
        part = (rank << 32) | ((own >> np.uint64(40)) % np.array([p for _, p in plan], np.uint64)[rank]).astype(np.int64)
        by = np.argsort(part, kind="stable")
        first = np.flatnonzero(np.diff(part[by], prepend=-1))
        before = np.zeros(n, np.int64)
        before[by] = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
        m = int(np.searchsorted(np.cumsum(before >= k - 1), need)) + 1
        salt = np.uint64((at + 1) * 8 + longer)
        for c in range(len(plan)):
            here = np.flatnonzero(rank[:m] == c)
            if not len(here):
                continue
            places = combinations(part[here], np.lexsort((own[here], part[here])), plan[c][0])
            total = np.full(len(places[0]), mix(np.array([salt]))[0])
            for p in places:
                total = mix(total * np.uint64(3) + own[here][p])
            out.append(total)
            combined += len(total) if plan[c][0] > 1 else 0
    return np.concatenate(out), combined


def similar(inter: np.ndarray, a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
    return den * inter >= num * (a + b - inter)


def linked(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    """Whether two sorted sets are similar."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return bool(similar(int((y[at] == x).sum()), len(x), len(y), num, den))


def bitmap(own: np.ndarray) -> bytes:
    """Parities of a set's hashes over a power of two of bits, LEAST_BITS or the next from its size on."""
    bits = max(LEAST_BITS, 1 << int(len(own) - 1).bit_length()) if len(own) else LEAST_BITS
    return np.packbits(np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1, bitorder="little").tobytes()


def fold(bits: np.ndarray, width: int) -> np.ndarray:
    """A bitmap over fewer bits: parities add up."""
    return np.bitwise_xor.reduce(bits.reshape(-1, width), axis=0)


def may_link(differing: np.ndarray, a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether sets of these sizes that differ in at least so many shingles can be similar."""
    twice = a + b - differing
    return den * twice >= num * (2 * (a + b) - twice)


def _sets_of(docs: DataFrame, k: int, of: Callable[[np.ndarray, np.ndarray], list], schema: str) -> DataFrame:
    """``of`` (hashes of a run of texts, number of each) for all texts of ``docs``, as rows of ``schema``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for b in batches:
            for _, part in chunks(b.column(0)):
                yield pa.RecordBatch.from_arrays(of(*hasher.shingles(part, k)), [c.split()[0] for c in schema.split(", ")])

    return docs.select(F.col("text").cast("string").cast("binary")).mapInArrow(work, schema)


def shingle_sets(docs: DataFrame, k: int) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, n, sid, check, bits) of every row, and the table of shingle counters over all rows, from one scan."""
    kind = docs.schema["doc_id"].dataType

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, table, ids = WordHasher(), np.zeros(1 << COUNTER_BITS, np.uint32), None
        names = ["doc_id", "n", "sid", "check", "bits", "slice", "counts"]
        for b in batches:
            ids = b.column(0)
            for start, part in chunks(b.column(1)):
                found, sizes = hasher.shingles(part, k)
                at, times = np.unique(counter_of(found), return_counts=True)
                table[at] += times.astype(np.uint32)
                sid, check = set_ids(found, sizes)
                blank = [pa.nulls(len(part), pa.int32()), pa.nulls(len(part), pa.binary())]
                bits = pa.array([bitmap(own) for own in np.split(found, np.cumsum(sizes)[:-1])], pa.binary())
                yield pa.RecordBatch.from_arrays([ids.slice(start, len(part)), pa.array(sizes, pa.int64()), pa.array(sid), pa.array(check), bits, *blank], names)
        if ids is not None:
            parts = [zlib.compress(x.tobytes(), 1) for x in np.split(table, SLICES)]
            empty = [pa.nulls(SLICES, t) for t in (ids.type, pa.int64(), pa.int64(), pa.int64(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*empty, pa.array(range(SLICES), pa.int32()), pa.array(parts)], names)

    rows = docs.select("doc_id", F.col("text").cast("string").cast("binary")).mapInArrow(work, f"doc_id {kind.simpleString()}, n long, sid long, check long, bits binary, slice int, counts binary")
    rows = common.materialise(rows, "shingle-sets")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for s, counts in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                sums[s] = sums.get(s, 0) + np.frombuffer(zlib.decompress(counts), np.uint32)
        if sums:
            yield pa.RecordBatch.from_pydict({"slice": pa.array(list(sums), pa.int32()), "counts": [zlib.compress(x.astype(np.uint32).tobytes(), 1) for x in sums.values()]})

    tables = rows.where("slice IS NOT NULL").select("slice", "counts")
    tables = tables.repartition(SLICES, "slice").mapInArrow(add, "slice int, counts binary")
    whole = np.zeros((SLICES, (1 << COUNTER_BITS) // SLICES), np.uint32)
    for r in tables.collect():
        whole[r["slice"]] = np.frombuffer(zlib.decompress(r["counts"]), np.uint32)
    return rows.where("slice IS NULL").select("doc_id", "n", "sid", "check", "bits"), whole.ravel()


def postings(docs: DataFrame, counters, k: int, num: int, den: int, longer: int = 0) -> DataFrame:
    """(sig, sid) of every row of ``docs``; ``counters`` is broadcast already."""

    def sign(found: np.ndarray, sizes: np.ndarray) -> list:
        table, frequent = counters.value
        counts, (sid, _), ends = table[counter_of(found)], set_ids(found, sizes), np.cumsum(sizes)
        made = [signatures(found[e - n : e], counts[e - n : e], frequent, num, den, longer)[0] for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
        return [pa.array(np.concatenate(made).view(np.int64)), pa.array(np.repeat(sid, [len(x) for x in made]))]

    return _sets_of(docs, k, sign, "sig long, sid long")


def representatives(docs: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts of one document of each class in ``wanted`` (sid), and few others.

    A table of bits over the ids of these documents, 16 for each but no more
    than 2**26, is broadcast and keeps other texts out of the step that follows.
    """
    chosen = common.materialise(classes.join(wanted, "sid", "left_semi").select("least"), "chosen")
    size = 1 << min(26, max(16, (16 * chosen.count()).bit_length()))
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(size))
    words = chosen.select(bit("least").alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, int(bit & 63))")).alias("mask"))
    near = docs.select("doc_id", "text").withColumn("bit", bit("doc_id")).withColumn("word", F.shiftright("bit", 6))
    return near.join(F.broadcast(words), "word").where("shiftright(mask, int(bit & 63)) & 1 = 1").select("text")


def payloads(docs: DataFrame, wanted: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """(sid, hashes) of the classes in ``wanted`` (sid), made again from the texts of one document each."""

    def whole(found: np.ndarray, sizes: np.ndarray) -> list:
        return [pa.array(set_ids(found, sizes)[0]), pa.array([x.tobytes() for x in np.split(found, np.cumsum(sizes)[:-1])], pa.binary())]

    made = _sets_of(representatives(docs, classes, wanted), k, whole, "sid long, hashes binary")
    return common.materialise(made.join(wanted, "sid", "left_semi").dropDuplicates(["sid"]), "payloads")


def verify(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar."""
    left = sets.select(F.col("sid").alias("a"), F.col("hashes").alias("x"))
    right = sets.select(F.col("sid").alias("b"), F.col("hashes").alias("y"))
    within = F.least(F.length("x"), F.length("y")) * den >= F.greatest(F.length("x"), F.length("y")) * num

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), num, den) for x, y in zip(b.column(2), b.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").where(within).select("a", "b", "x", "y").mapInArrow(work, "a long, b long")


def filtered(pairs: DataFrame, marks: DataFrame, num: int, den: int) -> DataFrame:
    """The distinct pairs (a, b) that pass on bitmaps; ``marks`` has sid, n and bits."""
    left = marks.select(F.col("sid").alias("a"), F.col("n").alias("na"), F.col("bits").alias("x"))
    right = marks.select(F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("y"))
    within = F.least("na", "nb") * den >= F.greatest("na", "nb") * num

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            differing = []
            for x, y in zip(b.column(4), b.column(5), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint8), np.frombuffer(y.as_buffer(), np.uint8)
                width = min(len(x), len(y))
                differing.append(int(np.bitwise_count(fold(x, width) ^ fold(y, width)).sum()))
            keep = may_link(np.array(differing, np.int64), np.asarray(b.column(2)), np.asarray(b.column(3)), num, den)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(left, "a").join(right, "b").where(within)
    return joined.select("a", "b", "na", "nb", "x", "y").mapInArrow(work, "a long, b long")


def passing(bits: np.ndarray, sizes: np.ndarray, rows: np.ndarray, columns: np.ndarray, num: int, den: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each of ``rows`` (indices of sets) with those of ``columns`` that it passes on bitmaps with."""
    lengths = [np.array([len(bits[i]) for i in x], np.int64) for x in (rows, columns)]
    for width in sorted(set(lengths[0].tolist())):
        some = rows[lengths[0] == width]
        # Sizes of similar sets differ by less than a factor of two, and so do their bitmaps.
        for other in (width // 2, width, width * 2):
            near = columns[lengths[1] == other]
            if not len(near):
                continue
            w = min(width, other)
            y = np.stack([fold(np.frombuffer(bits[i], np.uint8), w) for i in near]).view(np.uint64)
            for i in some:
                own = fold(np.frombuffer(bits[i], np.uint8), w).view(np.uint64)
                passes = may_link(np.bitwise_count(own ^ y).sum(1, dtype=np.int64), sizes[i], sizes[near], num, den)
                if passes.any():
                    yield int(i), near[passes]


def dealt(members: DataFrame, by: str, blocks: Column) -> DataFrame:
    """``members`` with the group (g, i, j) of each pair of blocks of its ``by`` that it takes part in, and its ``own`` block.

    Few members go to a task together, GROUP_ROWS rows or so at a time.
    """
    own = F.pmod(F.xxhash64("sid"), blocks).cast("int")
    rows = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    gathered = F.lit(max(1, members.count() // GROUP_ROWS))
    group = F.when(blocks > 1, F.col(by)).otherwise(F.pmod(F.xxhash64(by), gathered))
    return rows.withColumns({"g": group, "i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("other")


def _runs_of(rows: pd.DataFrame, by: str) -> Iterator[np.ndarray]:
    """Places of the rows of each value of ``by``, by which ``rows`` are sorted."""
    return np.split(np.arange(len(rows)), np.flatnonzero(np.diff(rows[by].to_numpy())) + 1)


def promising(lists: DataFrame, marks: DataFrame, num: int, den: int) -> DataFrame:
    """(sid, label, near) of members with a partner in another component in one of ``lists`` (sig, sid, label, size).

    ``near`` is a label that such partners lead to, the same one for all that
    lead to each other, so a list gives a row for each member at most.
    """
    # Short lists go to a task's group together; a long one has a group for each pair of its blocks.
    rows = dealt(lists, "sig", F.ceil(F.col("size") / BLOCK).cast("int")).select("g", "i", "j", "sig", "sid", "label", "own")

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        i, j = rows["i"].iloc[0], rows["j"].iloc[0]
        rows = rows.sort_values("sig", kind="stable").reset_index(drop=True)
        own, sizes, labels, bits = (rows[c].to_numpy() for c in ("own", "n", "label", "bits"))
        out = []
        for at in _runs_of(rows, "sig"):
            roots, hit = labels[at].copy(), np.zeros(len(at), bool)
            first = at[0]
            for x, partners in passing(bits, sizes, at[own[at] == i], at[own[at] == j], num, den):
                partners = partners[labels[partners] != labels[x]]
                if len(partners):
                    hit[partners - first] = hit[x - first] = True
                    together = np.unique(roots[np.append(partners, x) - first])
                    if len(together) > 1:
                        roots[np.isin(roots, together)] = together[0]
            out.append(pd.DataFrame({"sid": rows["sid"].to_numpy()[at][hit], "label": labels[at][hit], "near": roots[hit]}))
        return pd.concat(out).drop_duplicates()

    return rows.join(marks, "sid").groupBy("g", "i", "j").applyInPandas(work, "sid long, label long, near long").distinct()


def joining(groups: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) that join the components of ``groups`` (near, sid, label, n, bits, hashes, blocks), fewer than a group has rows."""
    rows = dealt(groups, "near", F.col("blocks"))

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        i, j = rows["i"].iloc[0], rows["j"].iloc[0]
        rows = rows.sort_values("near", kind="stable").reset_index(drop=True)
        own, ids, sizes, bits, sets = (rows[c].to_numpy() for c in ("own", "sid", "n", "bits", "hashes"))
        roots, ends = rows["label"].to_numpy().copy(), []
        for at in _runs_of(rows, "near"):
            for x, partners in passing(bits, sizes, at[own[at] == i], at[own[at] == j], num, den):
                for y in partners:
                    if roots[x] != roots[y] and linked(np.frombuffer(sets[x], np.uint64), np.frombuffer(sets[y], np.uint64), num, den):
                        ends.append((ids[x], ids[y]))
                        roots[at] = np.where(roots[at] == roots[y], roots[x], roots[at])
        both = np.array(ends, np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": both.min(1), "b": both.max(1)}, dtype="int64")

    return rows.groupBy("g", "i", "j").applyInPandas(work, "a long, b long")


def lists_of(index: DataFrame) -> DataFrame:
    """(sig, sid, size, p1, p2) of the lists of two sets or more in ``index`` (sig, sid), lists of the same members once; p1 and p2 are its pivots."""
    lists = index.groupBy("sig").agg(F.min("sid").alias("p1"), F.max("sid").alias("p2")).where("p1 != p2")
    found = common.materialise(index.join(lists, "sig").distinct(), "members")
    prints = found.groupBy("sig", "p1", "p2").agg(F.count("*").alias("size"), F.bit_xor(F.xxhash64("sid")).alias("f1"), F.bit_xor(F.xxhash64("sid", F.lit(1))).alias("f2"))
    kept = common.materialise(prints.groupBy("size", "f1", "f2", "p1", "p2").agg(F.min("sig").alias("sig")).select("sig", "size"), "lists")
    members = common.materialise(found.join(kept, "sig"), "members")
    common.discard(found, kept)
    return members


def join(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of each row of ``docs`` (doc_id, text).

    Two documents link when den * |A and B| >= num * |A or B| over their sets
    of distinct ``k``-word shingles; words are lower-cased in A-Z. A text of
    fewer words has its whole sequence as one shingle. A null text or one
    without words has no shingles and links with nothing. The component id is
    the smallest doc_id reachable by links; null doc_ids take part but are no
    component id unless all of a component are null. Repeated rows are of one
    class. Other columns are ignored, whatever their names. An empty table
    gives no rows. A text of any length is hashed in pieces; its set is held
    whole. The threshold must exceed one half.
    """
    if not den < 2 * num <= 2 * den:
        raise ValueError("the threshold must be over 1/2 and at most 1")
    docs = docs.select("doc_id", "text")
    sets, table = shingle_sets(docs, k)
    classes = common.materialise(sets.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("least"), F.min("check").alias("c1"), F.max("check").alias("c2")), "classes")
    if not classes.where("c1 != c2").isEmpty():
        raise RuntimeError("two different shingle sets share a 64-bit id; change the hash seed")
    counters = docs.sparkSession.sparkContext.broadcast((table, bounds(table)))
    links = mixed = marks = None
    rest, signed = [], docs
    for longer in range(LONGER + 1):
        index = common.materialise(postings(signed, counters, k, num, den, longer), "postings")
        members = lists_of(index)
        common.discard(index)
        if longer == 0:
            # One document of each class; its id is part of the key, so a class of very many copies is no hot key.
            one = classes.join(members.select("sid").distinct(), "sid", "left_semi").select(F.col("sid").alias("_s"), "least")
            marks = sets.join(one, (F.col("sid") == F.col("_s")) & F.col("doc_id").eqNullSafe(F.col("least"))).select("sid", "n", "bits")
            marks = common.materialise(marks.dropDuplicates(["sid"]), "marks")
        pivots = members.select("sid", F.explode(F.array("p1", "p2")).alias("p")).where("sid != p")
        pairs = common.materialise(filtered(pivots.select(F.least("sid", "p").alias("a"), F.greatest("sid", "p").alias("b")).distinct(), marks, num, den), "candidates")
        whole = payloads(docs, pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct(), classes, k)
        found = common.materialise(verify(pairs, whole, num, den), "links")
        common.discard(pairs, whole)
        links = links.unionAll(found) if links else found
        roots = common.materialise(components(links), "roots")
        labelled = common.materialise(members.where("size > 2").join(roots.withColumnRenamed("node", "sid"), "sid", "left").select("sig", "sid", "size", F.coalesce("root", "sid").alias("label")), "labelled")
        common.discard(members)
        mixed = labelled.groupBy("sig").agg(F.min("label").alias("l1"), F.max("label").alias("l2")).where("l1 != l2").select("sig")
        mixed = common.materialise(labelled.join(mixed, "sig"), "mixed-lists")
        common.discard(labelled)
        hot = mixed.where(F.col("size") > HOT) if longer < LONGER else mixed.limit(0)
        rest.append(mixed.where(F.col("size") <= HOT) if longer < LONGER else mixed)
        if hot.isEmpty():
            break
        again = common.materialise(hot.select("sid").distinct(), "hot-sets")
        signed = representatives(docs, classes, again)

    waiting = rest[0].select("sig", "sid", "size")
    for r in rest[1:]:
        waiting = waiting.unionAll(r.select("sig", "sid", "size"))
    waiting = waiting.join(roots.withColumnRenamed("node", "sid"), "sid", "left").select("sig", "sid", "size", F.coalesce("root", "sid").alias("label"))
    waiting = common.materialise(waiting, "waiting")
    near = common.materialise(promising(waiting, marks, num, den), "promising")
    if not near.isEmpty():
        leads = common.materialise(components(near.select(F.col("label").alias("a"), F.col("near").alias("b")).distinct()), "leads")
        groups = near.select("sid", "label").distinct().join(leads, F.col("label") == F.col("node"))
        whole = payloads(docs, near.select("sid").distinct(), classes, k)
        groups = common.materialise(groups.select("sid", "label", F.col("root").alias("near")).join(marks, "sid").join(whole, "sid"), "groups")
        large = groups.groupBy("near").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum(F.length("hashes")) / BLOCK_BYTES)).cast("int").alias("blocks")).where("blocks > 1")
        groups = groups.join(common.small_or_shuffled(common.materialise(large, "large")), "near", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        links = links.unionAll(common.materialise(joining(groups, num, den), "links"))
        roots = common.materialise(components(links), "roots")
    named = classes.join(roots.withColumnRenamed("node", "sid"), "sid", "left").select("sid", "least", F.coalesce("root", "sid").alias("root"))
    smallest = named.groupBy("root").agg(F.min("least").alias("component"))
    named = common.materialise(named.join(smallest, "root").select("sid", "component"), "components")
    common.discard(marks, waiting, near, classes)
    counters.unpersist()
    own = sets.join(named, "sid", "left")
    return own.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))
