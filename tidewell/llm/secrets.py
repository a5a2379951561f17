"""Incremental scan for secrets over a ledger of content-addressed blobs.

Every historical version of a file is a blob named by the SHA-256 of its
content. The ledger remembers which (blob, rule, version of the rule) have been
scanned and what was found. A scan hashes all versions and looks the hashes up
in the ledger; only texts of blobs with a rule not yet seen there move, one
copy of each, and only those rules run. The ledger is appended to, and findings
are joined back to all paths that carry the blob. All of it is DataFrame
expressions.

Places of matches come from splitting the text at the same pattern: a match
starts where the pieces and matches before it end. Both Java functions scan
alike, leftmost first and without overlap, and lengths count code points.
Arrays are summed up in blocks of the root of their length, so a text of n
findings costs n ** 1.5 short steps.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import common
from tidewell.llm.common import let

SPAN = "struct<kind:string,start:int,end:int>"
LEDGER = f"blob_id string, rules array<string>, spans array<{SPAN}>"


@dataclass(frozen=True)
class Rule:
    """A pattern whose matches are findings; with ``group``, only those where that group has ``least`` characters."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: The kinds in the order in which spans that start alike are listed.
RULES = [
    Rule("assign", 1, r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
]
BASE = ("assign", "access", "hex")


def blocked(values: Column, body) -> Column:
    """``body`` of (block, number of the block) for the runs of about the root of the number of ``values``, in order; empty for none."""
    width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(values))).cast("int"))
    places = F.when(F.size(values) > 0, F.sequence(F.lit(0), ((F.size(values) - 1) / width).cast("int"))).otherwise(F.array().cast("array<int>"))
    return let(F.struct(values.alias("v"), width.alias("w")), lambda x: F.transform(places, lambda b: body(F.slice(x["v"], b * x["w"] + 1, x["w"]), b)))


def running(values: Column, add) -> Column:
    """The sums, by ``add``, of the first 1, 2, ... of an array of integers of 0 or more."""
    total = lambda part: F.aggregate(part, F.lit(0), lambda a, x: add(a, x))
    first = lambda part, n: F.slice(part, F.lit(1), n)

    def inside(totals: Column) -> Column:
        return F.flatten(blocked(values, lambda part, b: let(total(first(totals, b)), lambda at: F.transform(part, lambda _, i: add(at, total(first(part, i + 1)))))))

    return let(blocked(values, lambda part, _: total(part)), inside)


def matches(text: Column, rule: Rule) -> Column:
    """The rule's findings in ``text``, in order, as an array of spans; code points, end exclusive."""
    pattern = F.lit(rule.pattern)
    found = F.struct(
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("m"),
        F.split(text, rule.pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("g"),
    )
    Span = lambda start, end: F.struct(F.lit(rule.kind).alias("kind"), start.cast("int").alias("start"), end.cast("int").alias("end"))

    def place(x: Column) -> Column:
        # Where each match ends: the lengths of the pieces and matches up to it.
        steps = F.transform(x["m"], lambda m, i: F.length(F.get(x["gaps"], i)) + F.length(m))
        made = let(running(steps, lambda a, b: a + b), lambda ends: F.transform(ends, lambda end, i: F.struct(Span(end - F.length(F.get(x["m"], i)), end).alias("span"), F.length(F.get(x["g"], i)).alias("size"))))
        return F.transform(F.filter(made, lambda f: f["size"] >= rule.least), lambda f: f["span"])

    return F.when(F.regexp_like(text, pattern), let(found, place)).otherwise(F.array().cast(f"array<{SPAN}>"))


def open_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``, empty if there is none yet."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    if target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        return spark.read.schema(LEDGER).parquet(path)
    return spark.createDataFrame([], LEDGER)


def update(versions: DataFrame, ledger: str, rules: list[Rule] = RULES) -> int | None:
    """Scan the blobs of ``versions`` (blob_id, text) for the rules that the ledger lacks, and append to it.

    A rerun, or a run that was cut short and repeated, scans nothing twice. Of
    the blobs that the ledger knows only hashes move; the texts of others are
    told by a table of bits over the hashes of the blobs to be scanned, 16 for
    each but no more than 2**26, which is broadcast. A copy of a blob is kept
    before the exchange and one after it, so copies cost no more than their
    hash. Returns the number of blobs scanned, None for a ledger's first scan.
    """
    spark = versions.sparkSession
    known = open_ledger(spark, ledger)
    wanted = F.array(*[F.lit(r.key) for r in rules])
    none = F.array().cast(f"array<{SPAN}>")
    texts, n, pending = versions.select("blob_id", "text"), None, None
    # An empty ledger needs no join.
    if fresh := known.isEmpty():
        blobs = texts.dropDuplicates(["blob_id"]).withColumn("rules", wanted)
    else:
        seen = known.groupBy("blob_id").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
        pending = versions.select("blob_id").distinct().join(seen, "blob_id", "left")
        pending = pending.select("blob_id", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))).alias("rules")).where(F.size("rules") > 0)
        pending = common.materialise(pending, "pending-blobs")
        n = pending.count()
        if not n:
            return 0
        bit = F.pmod(F.xxhash64("blob_id"), F.lit(1 << min(26, max(16, (16 * n).bit_length()))))
        bits = pending.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, int(bit & 63))")).alias("mask"))
        near = texts.withColumn("bit", bit).withColumn("word", F.shiftright("bit", 6))
        near = near.join(F.broadcast(bits), "word").where("shiftright(mask, int(bit & 63)) & 1 = 1")
        blobs = near.select("blob_id", "text").dropDuplicates(["blob_id"]).join(pending, "blob_id")
    spans = F.concat(*[F.when(F.lit(fresh) | F.array_contains("rules", r.key), matches(F.col("text"), r)).otherwise(none) for r in rules])
    blobs.select("blob_id", "rules", spans.alias("spans")).write.mode("append").parquet(ledger)
    if pending is not None:
        common.discard(pending)
    return n


def findings(spark: SparkSession, ledger: str, rules: list[Rule] = RULES) -> DataFrame:
    """(blob_id, spans) of the blobs with findings under the rules' present versions, spans by start, then kind as listed."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    current = F.array(*[F.lit(r.key) for r in rules])
    rows = open_ledger(spark, ledger).where(F.size("spans") > 0)
    # A ledger row holds one scan: spans of the rule versions it lists.
    valid = F.filter("spans", lambda s: F.exists(F.array_intersect(F.col("rules"), current), lambda r: F.startswith(r, F.concat(s["kind"], F.lit("@")))))
    rows = rows.select("blob_id", valid.alias("spans")).groupBy("blob_id").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    keyed = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.array_position(kinds, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    ordered = F.transform(F.sort_array(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return rows.select("blob_id", ordered.alias("spans")).where(F.size("spans") > 0)


def with_blob(docs: DataFrame) -> DataFrame:
    """``docs`` with ``blob_id``, the SHA-256 of the text; a null text is the empty blob."""
    return docs.withColumn("blob_id", F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))


def scan(docs: DataFrame, ledger: str, rules: list[Rule] = RULES) -> DataFrame:
    """``docs`` with ``blob_id`` and ``secret_spans``, scanned through the ledger at ``ledger``.

    Each row of ``docs`` is one version of one path; rows are never merged, and
    repeated rows or copies share one blob. Columns of those two names are
    replaced. A null or empty text has no findings; an empty table gives none.
    """
    docs = docs.drop("blob_id", "secret_spans")
    versions = with_blob(docs)
    update(versions.where("text IS NOT NULL"), ledger, rules)
    # Written, so that the join has a plain exchange on both sides and a blob of very many paths can be split.
    found = common.materialise(findings(docs.sparkSession, ledger, rules).withColumnRenamed("spans", "secret_spans"), "findings")
    joined = versions.join(found, "blob_id", "left")
    return joined.select(*docs.columns, "blob_id", F.coalesce("secret_spans", F.array().cast(f"array<{SPAN}>")).alias("secret_spans"))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its kind in brackets; overlapping spans become one."""
    reached = running(F.transform(spans, lambda s: s["end"]), F.greatest)

    def whole(ends: Column) -> Column:
        # A span's piece: from where the spans before it end, to its own start; none for one that begins inside them.
        pieces = F.transform(spans, lambda s, i: F.struct(F.when(i > 0, F.get(ends, i - 1)).otherwise(0).alias("at"), s["start"].alias("start"), s["kind"].alias("kind")))

        def block(part: Column, b: Column) -> Column:
            first, last = F.get(part, F.lit(0))["at"], F.element_at(part, F.lit(-1))
            own = F.substring(text, first + 1, F.greatest(last["start"], last["at"]) - first)
            shown = lambda near: F.transform(part, lambda p: F.when(p["start"] >= p["at"], F.concat(F.substring(near, p["at"] - first + 1, p["start"] - p["at"]), F.lit("["), p["kind"], F.lit("]"))).otherwise(""))
            return F.array_join(let(own, shown), "")

        done = F.array_join(let(pieces, lambda p: blocked(p, block)), "")
        return F.concat(done, F.substring(text, F.element_at(ends, -1) + 1, F.length(text)))

    return F.when(F.size(spans) > 0, let(reached, whole)).otherwise(text)
