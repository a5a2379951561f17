"""Quality rules whose thresholds adapt to each language and source.

Counts are DataFrame expressions. Fixed cutoffs reject texts that are bad
anywhere; beyond those, each rule compares a ratio with a fence drawn from the
quartiles of its (language, source) group. Quartiles come from histograms with
fixed bins, a quantile sketch that merges by adding counts: each is built where
the rows are, so a group that holds a third of all rows costs its occupied bins
a task. A quartile is exact up to one bin, at every size and however the rows
are split, and verdicts compare whole bins, so no rounding decides. The table
of fences, one row a group, is then joined to the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm import common
from tidewell.llm.common import let, words

WINDOW = 8
SYMBOLS = "#*$%&|<>"
#: A fence stands so many quartile distances outside the quartiles.
REACH = 6
#: (rule, numerator, denominator, bins for 1, least quartile distance in bins, whether low values fail too).
RULES = [
    ("symbols", "n_symbols", "n_words", 1000, 50, False),
    ("dup_lines", "n_dup_lines", "n_lines", 1000, 100, False),
    ("repeats", "n_repeat_words", "n_words", 1000, 50, False),
    ("word_length", "word_chars", "n_words", 100, 50, True),
]


def repeat_words(tokens: Column) -> Column:
    """Words inside windows of WINDOW words that occur twice or more, the first one included.

    Windows are 64-bit hashes in an array. Only a text whose array has equal
    hashes, found with a hash set, goes on to sort (hash, place) pairs.
    """

    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(p: Column) -> Column:
            n = F.size(p)
            same = lambda x, i: ((i > 0) & (F.get(p, i - 1)["h"] == x["h"])) | ((i < n - 1) & (F.get(p, i + 1)["h"] == x["h"]))
            return F.sort_array(F.transform(F.filter(p, same), lambda x: x["i"]))

        def length(at: Column) -> Column:
            steps = F.transform(at, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - x, F.lit(WINDOW))))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

        return let(let(pairs, places), length)

    def of(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(1), F.size(w) - WINDOW + 1), lambda i: F.xxhash64(F.slice(w, i, F.lit(WINDOW))))
        twice = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0).cast("long")))
        return F.when(F.size(w) > WINDOW, twice).otherwise(F.lit(0).cast("long"))

    return let(tokens, of)


def counts(docs: DataFrame) -> DataFrame:
    """``docs`` without their text but with the counts that the rules use. A null text is empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\x0b\x0c\r")) != "")
    made = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
    kept = [c for c in docs.columns if c not in (*made, "text")]
    both = let(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeat_words(w).alias("r")))
    rows = docs.select(
        *kept,
        both.alias("_w"),
        F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("d"))).alias("_l"),
    )
    return rows.select(*kept, F.col("_w.n").alias("n_words"), "word_chars", "n_symbols", F.col("_l.n").alias("n_lines"), F.col("_l.d").alias("n_dup_lines"), F.col("_w.r").alias("n_repeat_words"))


def bin_of(rule: str) -> Column:
    """The bin of a row's ratio under ``rule``; null without words."""
    _, over, under, bins, *_ = next(r for r in RULES if r[0] == rule)
    return F.when(F.col("n_words") > 0, F.expr(f"({over} * {bins}) div {under}"))


def fences(rows: DataFrame, reach: int = REACH) -> DataFrame:
    """One row a (lang, source) with ``low_<rule>`` and ``high_<rule>`` in bins, from the rows that have words."""
    each = F.explode(F.array(*[F.struct(F.lit(r[0]).alias("rule"), bin_of(r[0]).alias("bin")) for r in RULES]))
    counts = rows.where("n_words > 0").select("lang", "source", each.alias("_b")).groupBy("lang", "source", "_b.rule", "_b.bin").count()
    group = Window.partitionBy("lang", "source", "rule")
    up = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumns({"_upto": F.sum("count").over(up), "_all": F.sum("count").over(group)})
    quartile = lambda rule, q: F.min(F.when((F.col("rule") == rule) & (4 * F.col("_upto") >= q * F.col("_all")), F.col("bin")))
    quartiles = counts.groupBy("lang", "source").agg(*[quartile(r[0], q).alias(f"{r[0]}_{q}") for r in RULES for q in (1, 3)])
    found = []
    for rule, _, _, _, least, _ in RULES:
        low, high = F.col(f"{rule}_1"), F.col(f"{rule}_3")
        distance = F.greatest(high - low, F.lit(least)) * reach
        found += [(low - distance).alias(f"low_{rule}"), (high + distance).alias(f"high_{rule}")]
    return quartiles.select("lang", "source", *found)


def rate(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """Counts, ``base_failed``, ``failed_rules`` and ``kept`` for each row of ``docs``.

    Null languages and sources form groups of their own. A null or empty text
    has no words and fails. Repeated rows get equal results; an empty table
    gives no rows. All columns but the text and those made here stay.
    """
    # Written once: the texts are read a single time for the histograms and the verdicts.
    rows = common.materialise(counts(docs.drop("base_failed", "failed_rules", "kept", "_lang", "_source")), "quality-counts")
    bounds = common.materialise(fences(rows, reach).withColumnsRenamed({"lang": "_lang", "source": "_source"}), "quality-fences")
    joined = rows.join(common.small_or_shuffled(bounds), rows["lang"].eqNullSafe(F.col("_lang")) & rows["source"].eqNullSafe(F.col("_source")), "left")
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    failed = []
    for rule, *_, both in RULES:
        outside = (bin_of(rule) > F.col(f"high_{rule}")) | (F.lit(both) & (bin_of(rule) < F.col(f"low_{rule}")))
        failed.append(F.when(outside, F.lit(rule)))
    joined = joined.withColumn("base_failed", base).withColumn("failed_rules", F.array_compact(F.array(*failed)))
    return joined.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).select(*rows.columns, "base_failed", "failed_rules", "kept")
