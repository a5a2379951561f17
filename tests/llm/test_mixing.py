from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tidewell.llm import common, mixing


def levels(sizes, weights=(5, 2, 1), cap=3):
    """Shares by weight; what exceeds a cap is shared again until nothing does."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full = set()
    while True:
        rest = sum(sizes.values()) - sum(cap * sizes[s] for s in full)
        total = sum(weight[s] for s in names if s not in full) or 1
        target = {s: cap * sizes[s] if s in full else rest * weight[s] / total for s in names}
        new = {s for s in names if target[s] > cap * sizes[s] + 1e-9}
        if not new - full:
            return target
        full |= new


def test_targets(spark):
    for sizes in ({"a": 10, "b": 1000, "c": 5, None: 300}, {"é": 0, "z": 7}, {"a": 1}, {"b": 0}, {str(i): i * i for i in range(30)}):
        rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        found = {r["source"]: r["target"] for r in mixing.targets(rows, (5, 2, 1), 3).collect()}
        want = levels(sizes)
        assert all(abs(found[s] - want[s]) < 1e-6 for s in sizes)


def check(rows):
    by = defaultdict(list)
    for r in rows:
        by[r["target"], r["source_size"]].append(r)
        assert r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
    return by


def drawn(rows, weights=(5, 2, 1), cap=3):
    """The draw by the definition, for rows of (doc_id, source, size, random part, key): copies by doc_id."""
    sizes = Counter()
    for _, source, size, *_ in rows:
        sizes[source] += size
    target, out = levels(sizes, weights, cap), {}
    for source, total in sizes.items():
        own = [r for r in rows if r[1] == source]
        whole = min(cap, int(target[source] / total + 1e-9)) if total else 0
        rest = target[source] - whole * total if total and whole < cap else 0
        out |= {r[0]: whole if r[2] else 0 for r in own}
        if rest <= 0:
            continue
        low, high = 0.0, 1.0
        for _ in range(200):
            factor = (low + high) / 2
            low, high = (factor, high) if sum(r[2] * min(1, factor * r[2]) for r in own) < rest else (low, factor)
        p = lambda r, factor=low: min(1.0, factor * r[2])
        rank = lambda r: 0.0 if p(r) > 1 - 1e-9 else (r[3] / (1 - r[3])) / (p(r) / (1 - p(r)))
        order = sorted((r for r in own if r[2]), key=lambda r: (rank(r), r[4]))
        words = at = 0
        while at < len(order) and words + order[at][2] <= rest:
            words += order[at][2]
            out[order[at][0]] += 1
            at += 1
        gap, first = rest - words, {}
        for r in sorted(order[at:], key=lambda r: r[4]):
            first.setdefault(r[2], r)
        for _ in range(mixing.FILL):
            fits = [r for s, r in first.items() if abs(gap - s) < gap]
            if fits:
                best = min(fits, key=lambda r: (abs(gap - r[2]), r[2]))
                out[best[0]] += 1
                gap -= best[2]
                del first[best[2]]
    return out


def test_draw_equals_its_definition_however_rows_are_split(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    seen = docs.select("doc_id", "source", common.n_words(F.col("text")), mixing.random_part(9), F.xxhash64(F.lit(10), "doc_id", "text"))
    want = drawn([tuple(r) for r in seen.collect()])
    for parts in (1, 7, 32):
        rows = mixing.mix(docs.repartition(parts)).collect()
        assert {r["doc_id"]: r["copies"] for r in rows} == want
    for (target, _), own in check(rows).items():
        assert abs(sum(r["taken"] for r in own) - target) <= max(50, 0.01 * target)


def test_larger_documents_are_likelier(spark):
    """Inclusion odds rise with size: of equal shares of words, long documents fill more."""
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), F.when(F.col("id") % 2 == 0, 4).otherwise(40)).alias("text"), F.when(F.col("id") < 2000, "a").otherwise("b").alias("source"))
    rows = mixing.mix(docs, weights=(1, 1)).where("source_size > 0").collect()
    assert all(r["copies"] == 1 for r in rows)
    rows = mixing.mix(docs, weights=(3, 1)).collect()
    less = [r for r in rows if r["target"] < r["source_size"]]
    share = lambda size: sum(r["copies"] > 0 for r in less if r["size"] == size) / sum(r["size"] == size for r in less)
    assert share(40) > 1.3 * share(4)
    assert abs(sum(r["taken"] for r in less) - less[0]["target"]) < 41


def test_edges(spark, edges, nothing):
    wide = edges.withColumn("size", F.lit("x")).withColumn("target", F.lit(0))
    rows = mixing.mix(wide, keep=True).collect()
    assert len(rows) == 9 and {"text", "lang", "copies"} <= set(rows[0].asDict())
    check(rows)
    assert all(r["copies"] == 0 for r in rows if not (r["text"] or "").split())
    assert mixing.mix(nothing).count() == 0
