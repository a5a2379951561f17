"""Mixing sources to target weights by Pareto order sampling.

Targets are found by water-filling: each source gets its share of all words by
weight, no more than ``cap`` times its own words, and what is cut off is shared
again among the others. A source's target is met in two parts. Every document
is taken as many whole times as the target holds the source; these copies are
certain. The rest is a sample without repetition. A document's inclusion
probability is proportional to its words, at most 1, and the factor is such
that the expected words of the sample are the rest. Documents are ranked by
their random odds divided by their inclusion odds (Rosen's Pareto order
sampling), and the sample is the longest run of lowest ranks whose words do not
exceed the rest: its size is fixed in words. The last document that does not
fit leaves a gap, so at the end FILL documents a source at most are added, each
the one that brings the source nearest to its target, if any does.

A source may hold a third of all rows, so ranks are never gathered by source.
Factors come from counts of (source, size). Two rounds of histograms over
(source, rank interval), each aggregated where the rows are, narrow the cut to
one rank interval in 4096**2, and only that interval's rows are put in order.
Ties are broken by a hash of doc_id and text, so the draw does not depend on
how the rows are split; only rows equal in both are interchangeable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm import common

BINS = 4096
#: Documents that may be added to a source's sample to close its gap.
FILL = 2


def targets(sizes: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """``target`` for each row of ``sizes`` (source, source_size). One row a source; all sources are seen at once."""
    by_name, by_ratio = Window.orderBy(F.col("source").asc_nulls_last()), Window.orderBy("_ratio", "_rank")
    everything = Window.partitionBy()
    ranked = sizes.withColumn("_rank", F.row_number().over(by_name))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight.cast("double")).withColumn("_cap", F.col("source_size") * F.lit(float(cap)))
    ranked = ranked.withColumn("_ratio", F.col("_cap") / F.col("weight"))
    # Were all sources of smaller ratio full, this would be the level of the others.
    full = F.coalesce(F.sum("_cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    ranked = ranked.withColumn("_level", (F.sum("source_size").over(everything) - full) / left)
    ranked = ranked.withColumn("_place", F.row_number().over(by_ratio))
    first = F.min(F.when(F.col("_ratio") > F.col("_level"), F.struct("_place", "_level"))).over(everything)
    ranked = ranked.withColumn("_first", first)
    open_ = F.col("_place") >= F.col("_first._place")
    return ranked.withColumn("target", F.when(open_, F.col("weight") * F.col("_first._level")).otherwise(F.col("_cap"))).select("source", "source_size", "target")


def _join(rows: DataFrame, lookup: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``lookup`` for their source; null is a source too."""
    lookup = common.small_or_shuffled(lookup.withColumnRenamed("source", "_source"))
    return rows.join(lookup, rows["source"].eqNullSafe(lookup["_source"])).drop("_source")


def random_part(seed: int) -> Column:
    """A number between 0 and 1, drawn from doc_id and text."""
    return (F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")), F.lit(1 << 52)) + 0.5) / F.lit(float(1 << 52))


def factors(counts: DataFrame) -> DataFrame:
    """``factor`` of each source, from (source, size, n, rest): the sum of n * size * min(1, factor * size) is the rest.

    Sizes from some bound on are certain. Below it the factor follows from the
    rest that the certain ones leave; the bound is the largest one for which no
    smaller size exceeds 1. One row a source and size is put in order.
    """
    up = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    larger = Window.partitionBy("source").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    squares = F.sum(F.col("n") * F.col("size").cast("double") * F.col("size")).over(up)
    certain = F.coalesce(F.sum(F.col("n") * F.col("size")).over(larger), F.lit(0))
    found = counts.withColumn("factor", F.greatest(F.lit(0.0), F.col("rest") - certain) / squares)
    return found.where(F.col("factor") * F.col("size") <= 1 + 1e-12).groupBy("source").agg(F.max_by("factor", "size").alias("factor"))


def position(factor: Column, size: Column, u: Column) -> Column:
    """Rank of a document, from 0 to 1: q / (1 + q), where q is random odds divided by inclusion odds; 0 for certain ones, null for impossible ones."""
    p = F.least(factor * size, F.lit(1.0))
    q = u / (1 - u) / (p / (1 - p))
    return F.when(p >= 1, F.lit(0.0)).when(p > 0, q / (1 + q))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, seed: int = 9, keep: bool = False) -> DataFrame:
    """Per document: ``doc_id``, ``size`` in words, ``source_size``, ``target``, ``copies`` and ``taken`` words.

    With ``keep`` the columns of ``docs`` come too, but for columns of the names
    made here and those that begin with ``_mix_``, which are replaced or
    dropped. A document is taken ``copies`` whole times, at most ``cap``. Null
    text has no words and is never taken; a null source is one source, last in
    order; null doc_ids are documents like others. Repeated rows are drawn one
    by one. An empty table gives no rows. The draw depends on ``seed``, doc_id
    and text alone.
    """
    kept = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies", "taken") and not c.startswith("_mix_")]
    own = {"size": common.n_words(F.col("text")), "_mix_u": random_part(seed), "_mix_key": F.xxhash64(F.lit(seed + 1), F.col("doc_id"), F.col("text")), "_mix_row": F.monotonically_increasing_id()}
    rows = docs.select(*kept).withColumns(own)
    # Written once: later passes read a few narrow columns, and a row keeps its number.
    rows = common.materialise(rows if keep else rows.select("doc_id", "source", *own), "mix")
    counts = common.materialise(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-counts")
    plan = targets(counts.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), weights, cap)
    whole = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size") + 1e-9), F.lit(cap))).otherwise(0)
    plan = plan.withColumn("_mix_whole", whole)
    rest = F.when((F.col("source_size") > 0) & (F.col("_mix_whole") < cap), F.greatest(F.lit(0.0), F.col("target") - F.col("_mix_whole") * F.col("source_size"))).otherwise(0.0)
    plan = common.materialise(plan.withColumn("_mix_rest", rest), "mix-plan")
    found = factors(_join(counts.where("size > 0"), plan.select("source", F.col("_mix_rest").alias("rest"))))
    found = found.withColumnRenamed("source", "_mix_s")
    plan = plan.join(found, F.col("source").eqNullSafe(F.col("_mix_s")), "left").drop("_mix_s").withColumn("_mix_factor", F.coalesce("factor", F.lit(0.0))).drop("factor")
    plan = common.materialise(plan, "mix-plan")

    x = position(F.col("_mix_factor"), F.col("size"), F.col("_mix_u"))
    ranked = _join(rows.select("source", "size", "_mix_u", "_mix_key", "_mix_row"), plan.select("source", "_mix_rest", "_mix_factor"))
    ranked = ranked.select("source", "size", "_mix_key", "_mix_row", "_mix_rest", x.alias("_mix_x")).where("_mix_x IS NOT NULL AND _mix_rest > 0")
    bin1 = F.least(F.floor(F.col("_mix_x") * BINS), F.lit(BINS - 1))
    bin2 = F.floor((F.col("_mix_x") * BINS - bin1) * BINS)
    before, cut = F.lit(0), ranked
    for level, interval in enumerate((bin1, bin2)):
        cells = cut.groupBy("source", interval.alias("_bin")).agg(F.sum("size").alias("_words"), F.first("_mix_rest").alias("_rest"), F.first(before).alias("_before"))
        order = Window.partitionBy("source").orderBy("_bin")
        cells = cells.withColumn("_sum", F.sum("_words").over(order) + F.col("_before"))
        cells = cells.where(F.col("_sum") > F.col("_rest")).withColumn("_first", F.row_number().over(order)).where("_first = 1")
        cells = cells.select("source", F.col("_bin").alias(f"_cut{level}"), (F.col("_sum") - F.col("_words")).alias(f"_before{level}"))
        cut = _join(cut, common.materialise(cells, "mix-cut")).where(interval == F.col(f"_cut{level}"))
        before = F.col(f"_before{level}")
    place = F.struct("_mix_x", "_mix_key", "_mix_row")
    order = Window.partitionBy("source").orderBy("_mix_x", "_mix_key", "_mix_row")
    cut = cut.withColumn("_sum", F.sum("size").over(order) + F.col("_before1"))
    # The first document that does not fit; without one all documents do.
    beyond = cut.where(F.col("_sum") > F.col("_mix_rest")).groupBy("source").agg(F.min_by(F.struct(place.alias("_mix_end"), (F.col("_mix_rest") - F.col("_sum") + F.col("size")).alias("_mix_gap")), place).alias("_mix_at"))
    beyond = common.materialise(beyond.select("source", "_mix_at.*"), "mix-beyond")

    # What is left of each source, by size: enough to choose the documents that close its gap.
    left = _join(ranked, beyond).where(place >= F.col("_mix_end"))
    left = left.groupBy("source", "size").agg(F.min(F.struct("_mix_key", "_mix_row")).alias("_mix_first"), F.first("_mix_gap").alias("_mix_gap"))
    left = common.materialise(left, "mix-left")
    gaps = left.groupBy("source").agg(F.first("_mix_gap").alias("_mix_gap"), F.array().cast("array<bigint>").alias("_mix_added"))
    for _ in range(FILL):
        # A size is used once, so that one candidate a size is enough.
        near = _join(left.drop("_mix_gap"), common.materialise(gaps, "mix-gaps")).where((F.abs(F.col("_mix_gap") - F.col("size")) < F.col("_mix_gap")) & ~F.array_contains("_mix_added", F.col("_mix_first._mix_row")))
        best = near.groupBy(F.col("source").alias("_mix_s")).agg(F.min(F.struct(F.abs(F.col("_mix_gap") - F.col("size")).alias("off"), F.col("size").alias("size"), F.col("_mix_first._mix_row").alias("row"))).alias("_mix_best"))
        gaps = gaps.join(best, F.col("source").eqNullSafe(F.col("_mix_s")), "left").select(
            "source",
            (F.col("_mix_gap") - F.coalesce("_mix_best.size", F.lit(0))).alias("_mix_gap"),
            F.when(F.col("_mix_best").isNull(), F.col("_mix_added")).otherwise(F.concat("_mix_added", F.array("_mix_best.row"))).alias("_mix_added"),
        )
    gaps = common.materialise(gaps.select(F.col("source").alias("_mix_s"), "_mix_added"), "mix-gaps")
    ends = beyond.select(F.col("source").alias("_mix_t"), "_mix_end")
    plan = plan.join(ends, F.col("source").eqNullSafe(F.col("_mix_t")), "left").join(gaps, F.col("source").eqNullSafe(F.col("_mix_s")), "left").drop("_mix_s", "_mix_t")
    plan = common.materialise(plan, "mix-plan")

    done = _join(rows, plan).withColumn("_mix_x", x)
    sampled = F.col("_mix_x").isNotNull() & (F.col("_mix_rest") > 0) & (F.col("_mix_end").isNull() | (place < F.col("_mix_end")) | F.array_contains("_mix_added", F.col("_mix_row")))
    taken = F.when(F.col("size") > 0, F.col("_mix_whole") + F.coalesce(sampled, F.lit(False)).cast("int")).otherwise(0)
    done = done.withColumn("copies", taken.cast("int")).withColumn("taken", F.col("copies") * F.col("size"))
    return done.select(*(kept if keep else ["doc_id"]), "size", "source_size", "target", "copies", "taken")
