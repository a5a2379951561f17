"""Helpers that several corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.store import discard, materialise, remove, scratch, shared_dir, small_or_shuffled

__all__ = ["LABELLED_ROWS", "SPACE", "discard", "held_out", "let", "materialise", "n_words", "remove", "scratch", "shared_dir", "small_or_shuffled", "table", "text_or_empty", "words"]

#: Characters that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]"


#: Labelled rows that a classifier is fitted on at most.
LABELLED_ROWS = 8000


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether crc32 of the id as text is divisible by ``folds``; a null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body`` of a lambda variable bound to ``value``, which is then computed once a row."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text as an array: longest runs of characters other than SPACE."""
    bare = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE + "+"))


def n_words(text: Column) -> Column:
    return F.size(words(F.coalesce(text, F.lit("")))).cast("long")
