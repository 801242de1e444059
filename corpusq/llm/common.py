"""What several of these operators share: let-bindings, words, hold-out folds, table readers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: a word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WORD_GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once a row.

    The optimiser may copy an expression to each place that mentions it, also into
    lambdas that run per element; a lambda variable cannot be copied.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """The words of a text in order; null and empty texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id written as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds
