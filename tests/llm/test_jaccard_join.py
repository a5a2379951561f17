import itertools
import random
import re
import subprocess
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewell.llm import jaccard_join as jj
from tidewell.llm.components import components
from tidewell.llm.wordhash import WordHasher

ROOT = Path(__file__).resolve().parents[2]

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, k, num, den):
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(s), least.get(find(i), d)) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


def noisy(rng, base, changes):
    words = base.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("k, num", [(3, 90), (5, 80)])
def test_equals_brute_force(spark, monkeypatch, k, num):
    """Large groups of near copies around the threshold: longer combinations, several blocks, groups beside each other."""
    rng = random.Random(k)
    bases = [" ".join(f"b{j}x{i % (37 + j)}y{i}" for i in range(n)) for j, n in enumerate((12, 60, 330))]
    texts = [noisy(rng, b, rng.randrange(0, max(2, len(b.split()) // 12))) for b in bases for _ in range(90)]
    texts += ["a B c", "A b C", "one", "ONE", "", None, "x y", "x  y", " \t"]
    rows = [(1000 - i, t) for i, t in enumerate(texts)] + [(5, "x y"), (5, "x y"), (None, "x y"), (None, "lonely words of no id")]
    monkeypatch.setattr(jj, "BLOCK", 16)
    monkeypatch.setattr(jj, "HOT", 24)
    orders = []
    real = jj.postings

    def seen(docs, *rest):
        orders.append(rest[-1])
        return real(docs, *rest)

    monkeypatch.setattr(jj, "postings", seen)
    found = jj.join(spark.createDataFrame(rows, "doc_id long, text string"), k, num, 100).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, found), key=key) == sorted(brute(rows, k, num, 100), key=key)
    assert orders[:2] == [0, 1]


def test_documents_are_joined_through_combinations(spark):
    """The documents of sf0.01 at shipped constants: combinations are indexed, and the result equals that of all sets that share a shingle."""
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    k, num, den = 3, 90, 100
    sets = [shingles(t, k) for _, t in docs]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    common = Counter(pair for own in holders.values() for pair in itertools.combinations(own, 2))
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (i, j), c in common.items():
        if den * c >= num * (len(sets[i]) + len(sets[j]) - c):
            root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[find(i)] = min(d, least.get(find(i), d))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = sorted(map(tuple, jj.join(frame, k, num, den).collect()))
    assert found == sorted((d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(docs, sets, strict=True)))

    _, table = jj.shingle_sets(frame, k)
    hashed, sizes = WordHasher().shingles([(t or "").encode() for _, t in docs], k)
    made = [jj.signatures(own, table[jj.counter_of(own)], jj.bounds(table), num, den) for own in np.split(hashed, np.cumsum(sizes)[:-1])]
    assert sum(combined > 0 for _, combined in made) > 10
    small = [len(own) for own, (_, combined) in zip(sets, made, strict=True) if combined]
    assert min(small) < 256


@settings(max_examples=150, deadline=None)
@given(st.integers(2, 700), st.integers(0, 2**32), st.integers(0, 2), st.integers(0, 2), st.sampled_from([(90, 100), (80, 100), (2, 3), (51, 100)]))
def test_similar_sets_share_a_signature(n, seed, common, longer, threshold):
    num, den = threshold
    rng = np.random.default_rng(seed)
    own = rng.integers(0, 2**63, n, dtype=np.uint64)
    most = int((den - num) * n / (den + num)) + 1
    lost, gained = rng.integers(0, most + 1), rng.integers(0, most + 1)
    other = np.unique(np.concatenate((own[lost:], rng.integers(0, 2**63, gained, dtype=np.uint64))))
    own = np.unique(own)
    inter = len(np.intersect1d(own, other))
    if den * inter < num * (len(own) + len(other) - inter):
        return
    counts = lambda h: (h % np.uint64(900) + np.uint64(450 * common)).astype(np.int64)
    a, b = (jj.signatures(x, counts(x), (450, 800), num, den, longer)[0] for x in (own, other))
    assert len(np.intersect1d(a, b))


def test_long_text_is_hashed_in_pieces(monkeypatch):
    """Words and shingles of pieces are those of the whole, and memory follows the set, not the text."""
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("ab \nC") for _ in range(rng.randrange(60))).encode()
        whole = WordHasher().words([text])[0]
        assert all(np.array_equal(whole, np.concatenate([whole[:0], *WordHasher().stream(text, size)])) for size in (1, 2, 3, 7))
    code = """
import resource, sys
from tidewell.llm.wordhash import WordHasher
block = b"abc defg hij kl " * 64 + b"x" * 1024
text, few = block * (100 << 10), WordHasher().shingles([block * 3 + b"x"], 5)[0]
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
found, sizes = WordHasher().shingles([text], 5)
print(len(text), len(set(found) ^ set(few)), (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) >> 10)
"""
    size, other, grown = map(int, subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=ROOT).stdout.split())
    assert size >= 200 << 20 and other <= 2 * 5 and grown < 300


def test_edges(spark, edges, nothing):
    rows = jj.join(edges.withColumn("sid", F.lit(1)).withColumn("component_id", F.lit(1))).collect()
    assert len(rows) == 9
    assert {r["component_id"] for r in rows if r["doc_id"] in (1, 2)} == {1}
    assert {r["n_shingles"] for r in rows if r["doc_id"] in (3, 4, 5)} == {0}
    assert jj.join(nothing).count() == 0
    with pytest.raises(ValueError):
        jj.join(nothing, num=50)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 199)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)} | {200: 199, 199: 199}
