import re
from collections import Counter

import duckdb
import pytest
from compare import spark_rows, sql_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewell.llm import queries, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered))


def counted(spark, texts):
    rows = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id int, text string, lang string, source string")
    found = {r["doc_id"]: tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) for r in quality_rules.counts(rows).collect()}
    return [found[i] for i in range(len(texts))]


def test_counts(spark):
    texts = ["", None, " \n\t", "a b c d e f g h", "a b c d e f g h i a b c d e f g h", "x " * 9, "x " * 8, "l\nl\n l\n\n\nl", "# * $ % & | < > 😀ä\x0bq", "a b c d e f g h " * 50 + "tail", "w" * 100_000]
    assert counted(spark, texts) == [expected(t) for t in texts]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab \n"), max_size=80).map("".join), min_size=20, max_size=20))
def test_counts_of_any_text(spark, texts):
    assert counted(spark, texts) == [expected(t) for t in texts]


@pytest.fixture
def corpus(spark):
    clean = [(i, " ".join(f"word{(i * 7 + j * 13) % 1000}" for j in range(40 + i % 9)), "en", "a") for i in range(200)]
    junk = [(900, " ".join(f"x{j}##%%&&" for j in range(40)), "en", "a"), (901, "too short", "en", "a"), (902, "a b c d e f g h " * 9, "en", "a"), (903, " ".join(chr(97 + j % 26) for j in range(60)), "en", "a")]
    return spark.createDataFrame(clean + junk, "doc_id int, text string, lang string, source string")


def test_verdicts(corpus):
    rows = {r["doc_id"]: r for r in quality_rules.rate(corpus).collect()}
    assert all(rows[i]["kept"] for i in range(200)) and not any(rows[i]["kept"] for i in (900, 901, 902, 903))
    assert rows[901]["base_failed"] and rows[902]["base_failed"]
    assert "symbols" in rows[900]["failed_rules"] and not rows[900]["base_failed"] and "word_length" in rows[903]["failed_rules"]


def test_fences_follow_their_group(spark):
    """What is normal in one source is not in another."""
    rows = [(i, " ".join(f"c{j} |" for j in range(30)), "en", "tables") for i in range(50)] + [(100 + i, " ".join(f"word{j}" for j in range(60)), "en", "prose") for i in range(50)]
    rows.append((999, rows[0][1], "en", "prose"))
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.rate(spark.createDataFrame(rows, "doc_id int, text string, lang string, source string")).collect()}
    assert kept[0] and kept[100] and not kept[999]


def test_edges(edges, nothing):
    rows = quality_rules.rate(edges.withColumn("kept", edges["text"]).withColumn("n_words", edges["lang"])).collect()
    assert len(rows) == 9 and not any(r["kept"] for r in rows if not (r["n_words"]))
    assert quality_rules.rate(nothing).count() == 0


def test_a_large_group_has_the_same_verdicts_in_every_split(spark, tmp_path):
    """One group of 12,000 rows: equal to the SQL, whatever the partitions."""
    noise = F.concat(F.repeat(F.lit("| "), (F.xxhash64("id") % 40 + 40).cast("int") % 11), F.repeat(F.lit("a line of words that is told again\n"), (F.xxhash64("id", F.lit(1)) % 7 + 7).cast("int") % 7))
    text = F.concat(F.array_join(F.transform(F.sequence(F.lit(1), F.lit(40) + (F.col("id") % 30).cast("int")), lambda i: F.concat(F.lit("w"), F.xxhash64("id", i).cast("string"))), " "), F.lit("\n"), noise)
    spark.range(12_000).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"), F.lit("hot").alias("source")).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    shown = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    first = spark_rows(quality_rules.rate(docs).select(*shown))
    assert first == spark_rows(quality_rules.rate(docs.repartition(13)).select(*shown))
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    found = db.sql(queries.SQL["op10_quality_rules"])
    names = sorted(found.columns)
    assert first == (names, sorted((tuple(r[found.columns.index(n)] for n in names) for r in found.fetchall()), key=repr))
    assert 0 < sum(r[names.index("kept")] for r in first[1]) < 12_000


def test_query_equals_its_sql(spark, sf_dir):
    assert spark_rows(queries.op10_quality_rules(spark, sf_dir)) == sql_rows(queries.SQL["op10_quality_rules"], sf_dir)
